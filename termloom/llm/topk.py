"""Exact top-k search by inner product on a bit-sliced index.

Components are whole numbers. For a block of rows the index holds, for every
attribute, one bitmap a binary digit (slice). A query multiplies each attribute
by its own component and adds the products with bitmap arithmetic only: every
set digit of the query's component adds the attribute's slices, shifted, to a
bit-sliced sum. The top rows are selected from the most significant slice of
the sum downward. The lowest slices of the attributes are left out of the sum;
what they can add is bounded, so rows within that bound of the k-th best are
resolved by their exact products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.llm.common import column, shared_table

K = 10
SCALE = 1024
QUERY_STEP = 100
BLOCK_ROWS = 32_768
QUERY_ROWS = 256
#: Slices of each attribute that the sum leaves to the exact step.
LOW_SLICES = 4
_LEAST_LONG, _GREATEST_LONG = -(2**63), 2**63 - 1


class SlicedBlock:
    """Rows of whole numbers with their slices."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, low: int = LOW_SLICES) -> None:
        self.ids, self.values, self.low = ids, values.astype(np.int64), low
        self.n = len(ids)
        self.words = -(-self.n // 64)
        # What a row has above the least one, which always fits 64 bits without a sign.
        raised = self.values.view(np.uint64) - self.values.min(axis=0).view(np.uint64)
        self.largest = max(abs(int(self.values.min())), abs(int(self.values.max())))
        self.digits = [int(x).bit_length() for x in raised.max(axis=0)]
        self.all = self._bitmap(np.ones(self.n, bool))
        #: For each attribute the bitmaps of its digits from ``low`` upward.
        self.slices = [
            [self._bitmap(((raised[:, d] >> np.uint64(j)) & np.uint64(1)).astype(bool)) for j in range(low, digits)]
            for d, digits in enumerate(self.digits)
        ]
        self.inverse = [[~bitmap & self.all for bitmap in own] for own in self.slices]

    def _bitmap(self, rows: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.words * 64, bool)
        padded[: self.n] = rows
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def coarse_sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Bit-sliced sums of |q| * (high digits of the attribute, or of its
        complement where q is negative), least significant slice first."""
        columns: list[list[np.ndarray]] = []
        for d, q in enumerate(query.tolist()):
            own = self.slices[d] if q >= 0 else self.inverse[d]
            q, shift = abs(q), 0
            while q:
                if q & 1:
                    for j, bitmap in enumerate(own):
                        while len(columns) <= shift + j:
                            columns.append([])
                        columns[shift + j].append(bitmap)
                q >>= 1
                shift += 1
        sums, place = [], 0
        while place < len(columns):
            pile = columns[place]
            while len(pile) > 1:
                # Full adder: three bitmaps of a place make one there and one above.
                a, b = pile.pop(), pile.pop()
                half = a ^ b
                carry = a & b
                if pile:
                    c = pile.pop()
                    carry |= half & c
                    half ^= c
                pile.insert(0, half)
                if place + 1 == len(columns):
                    columns.append([])
                columns[place + 1].append(carry)
            sums.append(pile[0] if pile else np.zeros(self.words, np.uint64))
            place += 1
        return sums

    def candidates(self, query: np.ndarray, k: int, among: np.ndarray | None = None) -> np.ndarray:
        """Row numbers among which the ``k`` best are, ties included, of the rows ``among``
        (all)."""
        rows = np.arange(self.n) if among is None else np.flatnonzero(among)
        if len(rows) <= k:
            return rows
        every = self.all if among is None else self._bitmap(among)
        sums = self.coarse_sums(query)
        # From the top slice down: the value of the k-th best coarse sum.
        tied, above, kth = every, 0, 0
        for place in range(len(sums) - 1, -1, -1):
            with_digit = tied & sums[place]
            n = int(np.bitwise_count(with_digit).sum())
            if above + n >= k:
                tied, kth = with_digit, kth | (1 << place)
            else:
                above += n
                tied = tied & ~sums[place]
        # The digits left out add at most (2^low - 1) * sum |q|.
        size = sum(map(abs, query.tolist()))
        least = max(0, kth - -(-((1 << self.low) - 1) * size // (1 << self.low)))
        return self._at_least(sums, least, every)

    def _at_least(self, sums: list[np.ndarray], least: int, every: np.ndarray) -> np.ndarray:
        above, tied = np.zeros(self.words, np.uint64), every
        for place in range(max(len(sums), least.bit_length()) - 1, -1, -1):
            digit = sums[place] if place < len(sums) else np.zeros(self.words, np.uint64)
            if least >> place & 1:
                tied = tied & digit
            else:
                above = above | (tied & digit)
                tied = tied & ~digit
        rows = np.unpackbits((above | tied).view(np.uint8), bitorder="little")
        return np.flatnonzero(rows[: self.n])

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the ``k`` best rows with another id than the query's."""
        others = self.ids != query_id
        rows = self.candidates(query, k, None if others.all() else others)
        ids, scores = self.ids[rows], self._products(rows, query)
        if scores.dtype == object:
            best = np.array(sorted(range(len(rows)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
        else:
            best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]

    def _products(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Longs, or whole numbers of any size where a long may not do."""
        if self.largest * sum(map(abs, query.tolist())) <= _GREATEST_LONG:
            return self.values[rows] @ query
        return self.values[rows].astype(object) @ query.astype(object)


def top_k(
    vectors: DataFrame,
    id_column: str,
    vector_column: str,
    k: int = K,
    query_step: int = QUERY_STEP,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best rows of each query.

    A component x counts as ``floor(scale * x)``. Queries are the rows whose id
    is divisible by ``query_step``. All rows are indexed, in blocks of about
    ``block_rows`` dealt by the hash of id and vector; every block meets every query.

    Rows with a null id, a null or empty vector, or a component that is null or
    not finite take no part. Vectors are compared with those of their own length.

    Rows may share an id: each is a candidate, and where it is a query, the best
    ``k`` are those of all pairs of a row with that id and a row with another. Of
    equal rows, which are counted first, ``k`` copies are enough to fill any answer. A
    component that is beyond a long after scaling counts as the nearest long. Rows are
    ranked by their exact scores; one that is beyond a long is shown as the nearest long.
    """
    x = F.col("v")
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("v")
    )
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & (F.size(x) > 0) & finite)
    rows = rows.select("id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c)).alias("v"))
    rows = rows.groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).alias("copies"))
    rows = rows.select("id", "v", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    n_blocks = max(1, -(-vectors.count() // block_rows))
    block = F.pmod(F.xxhash64("id", "v"), F.lit(n_blocks)).cast("int")
    dealt = rows.select(block.alias("block"), "id", "v").repartitionById(n_blocks, F.col("block"))
    dealt = dealt.sortWithinPartitions("block", F.size("v"), "id", "v")
    packed = dealt.mapInArrow(
        _packer(query_step), "block int, kind int, dim int, ids binary, vals binary"
    )
    # One written copy serves as index and as queries.
    packed = shared_table(packed, "sliced")
    blocks = packed.where("kind = 0")
    asked = packed.where("kind = 1").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    met = blocks.unionByName(asked).repartitionById(n_blocks, F.col("block")).sortWithinPartitions("block", "dim", "kind")
    found = met.mapInArrow(_searcher(k), "query_id bigint, vec_id bigint, score bigint, beyond binary")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    ranked = found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def _packer(query_step: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[list, list]] = {}
        last: tuple[int, int] | None = None

        def rows() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate(held[last][0])
            values = np.concatenate(held[last][1])
            yield _packed_row(last, 0, ids, values)
            asked = ids % query_step == 0
            ids, values = ids[asked], values[asked]
            for start in range(0, len(ids), QUERY_ROWS):
                yield _packed_row(last, 1, ids[start : start + QUERY_ROWS], values[start : start + QUERY_ROWS])

        for batch in batches:
            block = column(batch, "block").to_numpy()
            ids = column(batch, "id").to_numpy()
            vectors = column(batch, "v")
            size = pa.compute.list_value_length(vectors).to_numpy()
            flat = vectors.flatten().to_numpy()
            offsets = np.concatenate([[0], np.cumsum(size)])
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(size) != 0)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                if start == end:
                    continue
                key = int(block[start]), int(size[start])
                if last is not None and key != last:
                    yield from rows()
                    held.clear()
                last = key
                own = held.setdefault(key, ([], []))
                own[0].append(ids[start:end].copy())
                own[1].append(_narrow(flat[offsets[start] : offsets[end]].reshape(-1, key[1])))
        if last is not None:
            yield from rows()

    return pack


def _narrow(values: np.ndarray) -> np.ndarray:
    """A copy with 32 bits a number if all fit."""
    fits = not values.size or (values.min() >= -(2**31) and values.max() < 2**31)
    return values.astype(np.int32 if fits else np.int64)


def _packed_row(key: tuple[int, int], kind: int, ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array([key[0]], pa.int32()),
            pa.array([kind], pa.int32()),
            pa.array([key[1]], pa.int32()),
            pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
            pa.array([values.tobytes()], pa.binary()),
        ],
        names=["block", "kind", "dim", "ids", "vals"],
    )


def _searcher(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, index = None, None
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                width = len(row["vals"]) // (len(ids) * row["dim"])
                values = np.frombuffer(row["vals"], f"<i{width}").reshape(-1, row["dim"])
                if row["kind"] == 0:
                    key, index = (row["block"], row["dim"]), SlicedBlock(ids, values)
                elif key == (row["block"], row["dim"]):
                    found = [(query, *index.top(query, q, k)) for query, q in zip(ids.tolist(), values.astype(np.int64))]
                    shown, beyond = _as_longs(np.concatenate([scores for _, _, scores in found]))
                    yield pa.record_batch(
                        [
                            pa.array(np.concatenate([np.full(len(near), query) for query, near, _ in found])),
                            pa.array(np.concatenate([near for _, near, _ in found])),
                            shown,
                            beyond,
                        ],
                        names=["query_id", "vec_id", "score", "beyond"],
                    )

    return search


def _as_longs(scores: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Scores as longs and, for those at or beyond the ends of the range, bytes that order them."""
    if scores.dtype != object:
        return pa.array(scores), pa.nulls(len(scores), pa.binary())
    every = scores.tolist()
    shown = [min(max(score, _LEAST_LONG), _GREATEST_LONG) for score in every]
    beyond = [
        (score + 2**191).to_bytes(24, "big") if long in (_LEAST_LONG, _GREATEST_LONG) else None
        for score, long in zip(every, shown)
    ]
    return pa.array(shown, pa.int64()), pa.array(beyond, pa.binary())


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best rows of ``embeddings`` for every hundredth row."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")


OP8_SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM rows q JOIN rows c ON c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
