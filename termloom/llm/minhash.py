"""Near duplicates by circulant MinHash, banding and exact verification.

Two permutations give all coordinates of a signature: the first scatters the
shingles over a circle of places, the second gives each place a value; for
coordinate ``k`` it is shifted by ``k`` places, and the coordinate is the
smallest value at the places of a text's shingles.

Texts with the same set of shingles form a class, and only classes go on.
Classes that agree in a band are linked to the smallest of them and compared by
their full sets; that joins most copies. What is still apart within a cluster of
bands is compared in tiles of bounded size: signature by signature, and pairs
that may reach the threshold by their full sets. So every pair that shares
a band and may be a link is decided exactly, no pairs are listed within a group
of copies, and no group is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import column, documents, forget, ids_and_texts, shared_table, slices, utf8
from termloom.llm.graph import components
from termloom.llm.words import mixed, shingle_sets

#: Similarity in percent, and words in a shingle.
THRESHOLD, SHINGLE = 75, 5
#: A pair at the threshold shares no band of four coordinates with probability 1e-8.
BANDS, ROWS = 48, 4
COORDINATES = 256
#: Of 256 coordinates, pairs at the threshold agree in fewer with probability 1e-8.
LEAST_AGREEING = 152
PLACES_BITS = 20
#: Classes compared with one centre in a task, and classes in a tile.
STAR_SIZE, TILE_SIZE = 64, 96
#: Text taken at a time; the arrays made of it are some fifty times as large.
SLICE_BYTES = 1 << 20
SEED = 3


@lru_cache(maxsize=1)
def _circle() -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and for each place its ``COORDINATES`` shifted values."""
    rng = np.random.default_rng(SEED)
    scatter = rng.permutation(1 << PLACES_BITS)
    values = rng.permutation(1 << PLACES_BITS).astype(np.uint32)
    around = np.concatenate([values, values[: COORDINATES - 1]])
    return scatter, np.lib.stride_tricks.sliding_window_view(around, COORDINATES)


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of a set that is not empty."""
    scatter, shifted = _circle()
    places = scatter[(shingles >> np.uint64(64 - PLACES_BITS)).astype(np.int64)]
    least = np.full(COORDINATES, 1 << PLACES_BITS, np.uint32)
    for start in range(0, len(places), 2048):
        np.minimum(least, shifted[places[start : start + 2048]].min(axis=0), out=least)
    return least


def bands(coordinates: np.ndarray) -> np.ndarray:
    """A number for each band, different for different bands."""
    rows = coordinates[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    number = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        number = mixed(number * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return number.astype(np.int64)


def set_number(shingles: np.ndarray) -> int:
    """Equal sets have equal numbers; others differ but for one pair in 2^64."""
    total = np.add.reduce(mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
    return int(mixed(np.array([total], np.uint64) + np.uint64(len(shingles))).view(np.int64)[0])


def _described(docs: DataFrame, *more: str) -> DataFrame:
    """``(doc_id, n, class, bands, marks)`` of every row; ``marks`` is a byte a
    coordinate. Columns named in ``more`` (longs) come along."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", SLICE_BYTES):
            sets = shingle_sets(utf8(batch, "text"), SHINGLE)
            signatures = [signature(s) if len(s) else None for s in sets]
            yield pa.record_batch(
                [
                    column(batch, "doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_number(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([None if c is None else bands(c) for c in signatures], pa.list_(pa.int64())),
                    pa.array([None if c is None else _marks(c) for c in signatures], pa.binary()),
                    *(column(batch, name) for name in more),
                ],
                names=["doc_id", "n", "class", "bands", "marks", *more],
            )

    schema = "doc_id bigint, n bigint, class bigint, bands array<bigint>, marks binary"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)
    return rows.mapInArrow(describe, ", ".join([schema, *(f"{name} bigint" for name in more)]))


def _marks(coordinates: np.ndarray) -> bytes:
    return (mixed(coordinates.astype(np.uint64)) & np.uint64(255)).astype(np.uint8).tobytes()


def _class_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(class, text)``: one text of each class of ``wanted(class)``."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", SLICE_BYTES):
            sets = shingle_sets(utf8(batch, "text"), SHINGLE)
            numbers = pa.array([set_number(s) if len(s) else None for s in sets], pa.int64())
            yield pa.record_batch([numbers, column(batch, "text")], names=["class", "text"])

    texts = ids_and_texts(docs).mapInArrow(number, "class bigint, text string").where(F.col("class").isNotNull())
    return texts.join(wanted.hint("merge"), "class").groupBy("class").agg(F.min("text").alias("text"))


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets reach the threshold.

    Pairs are grouped by ``a`` into groups of about ``STAR_SIZE``; the text of
    ``a`` goes to each of its groups.
    """
    n_groups = F.ceil(F.count("*") / F.lit(STAR_SIZE)).cast("bigint")
    sizes = pairs.groupBy("a").agg(n_groups.alias("n_groups"))
    dealt = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("n_groups")).alias("group"))
    members = dealt.join(texts.withColumnRenamed("class", "b"), "b").select("a", "group", "b", "text")
    centres = dealt.select("a", "group").distinct().join(texts.withColumnRenamed("class", "a"), "a")
    rows = members.unionByName(centres.select("a", "group", F.lit(None).cast("bigint").alias("b"), "text"))
    # The centre has no b and comes first in its group.
    dealt_rows = rows.repartition("a", "group").sortWithinPartitions("a", "group", F.asc_nulls_first("b"))
    return dealt_rows.select("a", "b", "text").mapInArrow(_compare, "a bigint, b bigint")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    centre = np.empty(0, np.uint64)
    for batch in slices(batches, "text", SLICE_BYTES):
        links = []
        sets = shingle_sets(utf8(batch, "text"), SHINGLE)
        for a, b, own in zip(column(batch, "a").to_pylist(), column(batch, "b").to_pylist(), sets):
            if b is None:
                centre = own
            elif _reach(own, centre):
                links.append((a, b))
        yield pa.record_batch(
            [pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"]
        )


def _links_apart(classes: DataFrame, texts: DataFrame, star: DataFrame, links: DataFrame) -> DataFrame:
    """``(a, b)``: further links, between classes of one cluster of bands that
    ``links`` leave apart.

    In a cluster, classes outside its largest component are compared with all
    others, tile by tile. Small clusters are one tile.
    """
    cluster = components(star).select(F.col("node").alias("class"), F.col("root").alias("cluster"))
    joined = components(links).select(F.col("node").alias("class"), F.col("root").alias("part"))
    placed = cluster.join(joined, "class", "left").select("class", "cluster", F.coalesce("part", "class").alias("part"))
    parts = placed.groupBy("cluster", "part").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("cluster").agg(
        F.max(F.struct("n", "part")).alias("largest"), F.sum("n").alias("n"), F.count("*").alias("n_parts")
    )
    # The pair of a cluster of two was compared already.
    open_ones = sizes.where((F.col("n_parts") > 1) & (F.col("n") > 2)).select(
        "cluster",
        F.col("largest.part").alias("largest"),
        F.ceil(F.col("n") / F.lit(TILE_SIZE)).cast("bigint").alias("n_tiles"),
        F.ceil((F.col("n") - F.col("largest.n")) / F.lit(TILE_SIZE)).cast("bigint").alias("n_rest"),
    )
    marks = classes.select("class", "marks", F.col("n").alias("size"))
    rows = placed.join(open_ones, "cluster").join(marks, "class").join(texts, "class")
    is_rest = F.col("part") != F.col("largest")
    mixed_class = F.xxhash64("class")
    item = F.struct("class", "part", "size", is_rest.alias("rest"), "marks", "text").alias("item")
    every = rows.select(
        "cluster",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_rest") - 1)).alias("left"),
        F.pmod(mixed_class, F.col("n_tiles")).alias("right"),
        F.lit(1).alias("side"),
        item,
    )
    rest = rows.where(is_rest).select(
        "cluster",
        F.pmod(mixed_class, F.col("n_rest")).alias("left"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_tiles") - 1)).alias("right"),
        F.lit(0).alias("side"),
        item,
    )
    tiles = every.unionByName(rest).select("cluster", "left", "right", "side", "item.*")
    tiles = tiles.repartition("cluster", "left", "right").sortWithinPartitions("cluster", "left", "right", "side")
    return tiles.mapInArrow(_tile_links, "a bigint, b bigint")


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a tile between different parts: those whose signatures agree
    enough are compared by their sets."""
    key: tuple | None = None
    rest: list[pa.RecordBatch] = []
    table: _Tile | None = None
    for batch in slices(batches, "text", SLICE_BYTES):
        keys = np.stack([column(batch, c).to_numpy() for c in ("cluster", "left", "right", "side")], axis=1)
        cuts = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            own, side = tuple(keys[start, :3].tolist()), keys[start, 3]
            if own != key:
                key, rest, table = own, [], None
            if side == 0:
                rest.append(batch.slice(start, end - start))
                continue
            if not rest:
                continue
            table = table or _Tile(pa.Table.from_batches(rest))
            yield table.links(_Tile(pa.Table.from_batches([batch.slice(start, end - start)])))


class _Tile:
    """Classes of one side of a tile."""

    def __init__(self, rows: pa.Table) -> None:
        self.number, self.part, self.size, self.rest = (rows[c].to_numpy() for c in ("class", "part", "size", "rest"))
        marks = np.frombuffer(b"".join(rows["marks"].to_pylist()), np.uint8)
        self.marks = marks.reshape(rows.num_rows, COORDINATES)
        self.texts = rows["text"]
        self.sets: list[np.ndarray] | None = None

    def set_of(self, i: int) -> np.ndarray:
        if self.sets is None:
            self.sets = shingle_sets(self.texts.cast(pa.binary()).to_pylist(), SHINGLE)
        return self.sets[i]

    def links(self, other: _Tile) -> pa.RecordBatch:
        may = self.part[:, None] != other.part
        # A pair outside the largest part meets twice.
        may &= ~other.rest | (self.number[:, None] < other.number)
        small, large = np.minimum(self.size[:, None], other.size), np.maximum(self.size[:, None], other.size)
        may &= 100 * small >= THRESHOLD * large
        found = []
        for i in np.flatnonzero(may.any(axis=1)).tolist():
            near = np.flatnonzero(may[i])
            near = near[(self.marks[i] == other.marks[near]).sum(axis=1) >= LEAST_AGREEING]
            found += [(self.number[i], other.number[j]) for j in near.tolist() if _reach(self.set_of(i), other.set_of(j))]
        return pa.record_batch([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _reach(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets reach the threshold."""
    if 100 * min(len(a), len(b)) < THRESHOLD * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= THRESHOLD * (len(a) + len(b) - common)


def _roots(docs: DataFrame, described: DataFrame) -> DataFrame:
    """``(class, root)`` of the classes that are linked to others."""
    classes = described.where(F.col("class").isNotNull())
    keyed = classes.select("class", "bands").dropDuplicates(["class"])
    keyed = keyed.select(F.explode("bands").alias("band"), "class")
    centres = keyed.groupBy("band").agg(F.min("class").alias("centre"), F.max("class").alias("last"))
    centres = centres.where(F.col("centre") != F.col("last")).select("band", "centre")
    star = keyed.join(centres, "band").where(F.col("class") != F.col("centre"))
    star = shared_table(star.select(F.col("centre").alias("a"), F.col("class").alias("b")).distinct(), "star")

    wanted = star.select(F.col("a").alias("class")).union(star.select("b")).distinct()
    texts = shared_table(_class_texts(docs, wanted), "class-texts")
    links = shared_table(_linked(star, texts), "star-links")
    one_each = classes.select("class", "marks", "n").dropDuplicates(["class"])
    links = links.unionByName(_links_apart(one_each, texts, star, links))
    return components(links).select(F.col("node").alias("class"), "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row.

    Linked are rows whose sets of five-word shingles have a Jaccard similarity
    of ``THRESHOLD`` percent or more. ``component_id`` is the smallest id that
    links reach. Null and empty texts, and texts of white space, have no shingle
    and are their own component. Rows without an id take part like others but
    give no id: ``component_id`` is null if no row of the component has one, and
    ``kept`` is null. Repeated rows are linked as equal texts.
    """
    described = shared_table(_described(docs), "described")
    rows = described.select("doc_id", "n", "class").join(_roots(docs, described), "class", "left")
    rows = rows.select("doc_id", "n", F.coalesce("root", "class").alias("root"))
    with_set = rows.where(F.col("root").isNotNull())
    least = with_set.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = with_set.join(least, "root").select("doc_id", "n", "component_id")
    alone = rows.where(F.col("root").isNull()).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return named.unionByName(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        (F.col("doc_id") == F.col("component_id")).alias("kept"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with the columns of ``docs``.

    The row with the smallest id stays, of several with that id the one that
    comes first in its table; a group without ids keeps its first row. Texts
    without a word are in no group and all stay. ``docs`` is read twice and has
    to give its rows in the same order, as a table does.
    """
    place = F.monotonically_increasing_id().alias("place")
    rows = docs.select(F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("record"), place)
    placed = rows.select(F.col("record.doc_id").alias("doc_id"), F.col("record.text").alias("text"), "place")
    described = shared_table(_described(placed, "place"), "described")
    found = described.select("doc_id", "place", "class").join(_roots(docs, described), "class", "left")
    root = F.coalesce("root", "class")
    by_id = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")
    first = found.where(root.isNotNull()).groupBy(root.alias("root")).agg(F.min(by_id).alias("first"))
    kept = first.select("first.place").unionByName(found.where(root.isNull()).select("place"))
    return rows.join(kept, "place").select("record.*")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near duplicates among all documents."""
    return near_duplicates(documents(spark, sf_dir))
