"""Packing documents into training sequences by a grouping genetic algorithm.

A document becomes token ids plus one end id and is cut only if it is longer
than a sequence. The pieces are dealt to blocks of bounded size, by length. On each
block several islands evolve a population of packings: crossover injects whole
well-filled sequences of one packing into another, drops the sequences that
hold duplicates, and puts the displaced pieces back best fit, longest first.
After every epoch the elite of an island moves to the next one. Pieces of
sequences that are still not full (of the least filled ones, if those are many)
are packed again across blocks, level by level, until one block holds them all.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.llm.common import (
    column,
    documents,
    ids_and_texts,
    one_thread,
    remembered,
    shared_table,
    slices,
    tokenizer_path,
    utf8,
    words_of,
)

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a Python worker remembers, from one task to the next; the
#: others are encoded when they come.
REMEMBERED_WORDS = 500_000
#: Signs that are cut off the end of a word; an apostrophe may belong to a contraction.
SIGNS = b".,!?;:*#&%$+=/_~^@()[]{}-"

BLOCK_PIECES = 4096
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3, 3, 12, 6
#: Sequences with more free places than this go to the next level.
FREE_PLACES = 2
SEED = 7

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# --- tokens -----------------------------------------------------------------


class WordEncoder:
    """Ids of texts as little-endian bytes, from the ids of their words.

    The tokenizer cuts at white space before anything else and treats each word
    by itself, so a text's ids are those of its words (cut at ASCII white space)
    one after the other, and each word is encoded once.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        one_thread()
        self.tokenizer = Tokenizer.from_file(path)
        n = self.tokenizer.get_vocab_size()
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(n)])
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        # Case does not matter to this vocabulary, except in its special tokens.
        numbers, words, sizes = words_of([(t if b"<|" in t else t.lower()) if t else b"" for t in texts])
        missing = [word for word in words if word not in self.known]
        extra = self._encode_words(missing) if missing else {}
        get = self.known.get
        own = [extra[word] if ids is None else ids for word, ids in zip(words, map(get, words))]
        self.known.update(islice(extra.items(), max(0, REMEMBERED_WORDS - len(self.known))))
        starts = np.zeros(len(own) + 1, np.int32)
        np.cumsum([len(ids) // 4 for ids in own], out=starts[1:])
        lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.frombuffer(b"".join(own), "<u4")))
        picked = lists.take(pa.array(numbers))
        every, ends = picked.flatten().to_numpy(), picked.offsets.to_numpy()[np.cumsum(sizes)].tolist()
        return [every[start:end].tobytes() for start, end in zip([0, *ends], ends)]

    def _encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        # "word." is the ids of "word" and of "."
        parts = {}
        for word in words:
            stem = word.rstrip(SIGNS)
            parts[word] = (stem, word[len(stem) :]) if stem and stem != word and _is_letters(stem) else (word,)
        single = {part for own in parts.values() for part in own}
        letters = [part for part in single if _is_letters(part)]
        ids: dict[bytes, bytes] = {}
        for start in range(0, len(letters), 20_000):
            ids |= self._encode_letters(letters[start : start + 20_000])
        rest = [part for part in single if part not in ids]
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)
        ids |= {word: _packed(e.ids) for word, e in zip(rest, encoded)}
        return {word: b"".join(map(ids.__getitem__, own)) for word, own in parts.items()}

    def _encode_letters(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Words of letters only, each of which ends with its only word end, in one text."""
        (encoded,) = self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)
        ids = np.array(encoded.ids, "<u4")
        ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
        if len(ends) != len(words):
            return {}
        packed = ids.tobytes()
        return {word: packed[4 * start : 4 * end] for word, start, end in zip(words, [0, *ends], ends)}


def word_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker, which Spark uses again. Operators
    that take as much memory have the worker forget it."""
    return remembered(("word encoder", path), lambda: WordEncoder(path))


def _is_letters(word: bytes) -> bool:
    """Whether lower-casing and composing leave one run of letters."""
    if word.isalpha():
        return True
    text = word.decode().lower()
    return text.isalpha() and unicodedata.is_normalized("NFC", text)


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each document; a null text is an empty one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        end, width = _packed([END_ID]), 4 * capacity
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, ids in zip(column(batch, "doc_id").to_pylist(), encoder.encode(utf8(batch, "text"))):
                ids += end
                for start in range(0, len(ids), width):
                    part = ids[start : start + width]
                    rows.append((doc_id, start // width, start // 4, len(part) // 4, zlib.crc32(part)))
            yield _piece_batch(*(np.array(c) if i else c for i, c in enumerate(zip(*rows))))

    return ids_and_texts(docs).mapInArrow(cut, PIECE_SCHEMA)


def _piece_batch(doc_id, piece, start, length, crc) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.record_batch(
        [pa.array(c, kind) for c, kind in zip((doc_id, piece, start, length, crc), kinds)],
        names=["doc_id", "piece", "start", "length", "ids_crc32"],
    )


# --- one block --------------------------------------------------------------


def best_fit(lengths: list[int], order: list[int], free: list[int], capacity: int) -> list[int]:
    """Put items, in ``order``, into the fullest sequence that has room.

    ``free`` holds the free places of the open sequences and is extended by new
    ones. Returns the sequence of each item of ``order``.
    """
    by_free: dict[int, list[int]] = {}
    mask = 0
    for number, places in enumerate(free):
        if places:
            by_free.setdefault(places, []).append(number)
            mask |= 1 << places
    chosen = []
    for item in order:
        length = lengths[item]
        rest = mask >> length
        if rest:
            places = length + (rest & -rest).bit_length() - 1
            same = by_free[places]
            number = same.pop()
            if not same:
                mask &= ~(1 << places)
                del by_free[places]
        else:
            places, number = capacity, len(free)
            free.append(capacity)
        places -= length
        free[number] = places
        if places:
            by_free.setdefault(places, []).append(number)
            mask |= 1 << places
        chosen.append(number)
    return chosen


@dataclass
class Block:
    """Lengths of the pieces of a block, longest first, and how to improve packings.

    A packing gives the sequence number of each piece.
    """

    lengths: np.ndarray
    capacity: int

    def __post_init__(self) -> None:
        self.list = self.lengths.tolist()
        self.least = -(-int(self.lengths.sum()) // self.capacity)

    def fills(self, packing: np.ndarray) -> np.ndarray:
        return np.bincount(packing, self.lengths)

    def fitness(self, packing: np.ndarray) -> tuple[int, float]:
        """Fewer sequences first, then fuller ones (mean of squares)."""
        fills = self.fills(packing)
        return -len(fills), float(np.square(fills / self.capacity).mean())

    def is_least(self, packing: np.ndarray) -> bool:
        return int(packing.max()) + 1 <= self.least

    def first(self, rng: np.random.Generator, noise: float) -> np.ndarray:
        """Best fit, longest first up to noise."""
        order = np.argsort(-(self.lengths * (1 + noise * rng.random(len(self.lengths)))), kind="stable")
        packing = np.empty(len(self.lengths), np.int32)
        packing[order] = best_fit(self.list, order.tolist(), [], self.capacity)
        return packing

    def crossed(self, into: np.ndarray, other: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Inject well-filled sequences of ``other`` into ``into``."""
        fills = self.fills(other)
        well = np.flatnonzero(fills >= np.median(fills))
        taken = rng.choice(well, max(1, int(len(well) * rng.uniform(0.1, 0.5))), replace=False)
        injected = np.isin(other, taken)
        broken = np.zeros(int(into.max()) + 1, bool)
        broken[into[injected]] = True
        return self._rebuilt(into, broken, injected, other)

    def mutated(self, packing: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Empty the worst sequences and some others, and put their pieces back."""
        fills = self.fills(packing)
        broken = rng.random(len(fills)) < 0.03
        broken[np.argsort(fills)[:3]] = True
        return self._rebuilt(packing, broken, np.zeros(len(packing), bool), packing)

    def _rebuilt(self, packing: np.ndarray, broken: np.ndarray, injected: np.ndarray, other: np.ndarray) -> np.ndarray:
        kept = ~injected & ~broken[packing]
        result = np.empty(len(packing), np.int32)
        old, numbers = np.unique(packing[kept], return_inverse=True)
        result[kept] = numbers
        new, numbers = np.unique(other[injected], return_inverse=True)
        result[injected] = numbers + len(old)
        displaced = np.flatnonzero(~kept & ~injected)
        placed = np.flatnonzero(kept | injected)
        used = np.bincount(result[placed], self.lengths[placed], minlength=len(old) + len(new))
        free = (self.capacity - used).astype(np.int64).tolist()
        # Pieces are sorted, so the displaced ones come longest first.
        result[displaced] = best_fit(self.list, displaced.tolist(), free, self.capacity)
        return result

    def evolve(self, population: list[np.ndarray], rng: np.random.Generator, generations: int, size: int) -> list[np.ndarray]:
        """The population after some generations, best first; it stops at a
        packing of as few sequences as the sum of lengths allows."""
        ranked = sorted(population, key=self.fitness, reverse=True)
        for _ in range(generations):
            if self.is_least(ranked[0]):
                break
            a, b = rng.integers(0, len(ranked), 2)
            better, worse = ranked[min(a, b)], ranked[max(a, b)]
            children = [
                self.crossed(better, worse, rng),
                self.crossed(worse, better, rng),
                self.mutated(ranked[0], rng),
            ]
            ranked = sorted(ranked + children, key=self.fitness, reverse=True)[:size]
        return ranked


# --- all blocks -------------------------------------------------------------


_STATE = "block bigint, island int, kind int, payload binary, lengths binary"
_BLOCK = "block bigint, n int, lengths binary, members binary"


def _numbered(items: DataFrame, level: int) -> DataFrame:
    """``items`` with ``rank``, the place in an order by length, equal ones at random.

    The places of each sorted partition are counted from the sum of the counts of
    those before; that table has a row for each partition.
    """
    mixed = items.withColumn("mixed", F.xxhash64("doc_id", "piece", F.monotonically_increasing_id(), F.lit(level)))
    ordered = mixed.repartitionByRange("length", "mixed").sortWithinPartitions("length", "mixed").drop("mixed")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    table = shared_table(ordered.select("*", F.spark_partition_id().alias("part"), at.alias("at")), "pack-order")
    counts = table.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return table.join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + F.col("at")).drop("part", "at", "before")


def _blocks(items: DataFrame, n_blocks: int, level: int) -> DataFrame:
    """One row a block: its pieces, longest first, as packed columns.

    Pieces are dealt in the order of their lengths, so that short and long ones
    have the same shares in every block and blocks differ by one piece at most.
    """
    numbered = items.withColumn("rank", F.lit(0)) if n_blocks == 1 else _numbered(items, level)
    block = (F.col("rank") % n_blocks).cast("bigint")
    dealt = numbered.withColumn("block", block).drop("rank").repartitionById(n_blocks, F.col("block").cast("int"))
    dealt = dealt.sortWithinPartitions("block", F.desc("length"), "doc_id", "piece", "start")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            numbers = column(batch, "block").to_numpy()
            # A null id is marked in a column of its own.
            doc_id = column(batch, "doc_id")
            table = np.stack(
                [
                    doc_id.fill_null(0).to_numpy(),
                    doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
                    column(batch, "piece").to_numpy().astype(np.int64),
                    column(batch, "start").to_numpy(),
                    column(batch, "length").to_numpy(),
                    column(batch, "ids_crc32").to_numpy(),
                ],
                axis=1,
            )
            for number in np.unique(numbers).tolist():
                parts.setdefault(number, []).append(table[numbers == number])
        for number, own in parts.items():
            members = np.concatenate(own)
            yield pa.record_batch(
                [
                    pa.array([number], pa.int64()),
                    pa.array([len(members)], pa.int32()),
                    pa.array([members[:, 4].astype(np.int32).tobytes()], pa.binary()),
                    pa.array([members.tobytes()], pa.binary()),
                ],
                names=["block", "n", "lengths", "members"],
            )

    return dealt.mapInArrow(gather, _BLOCK)


def _evolver(capacity: int, islands: int, epoch: int, level: int, seed: int, generations: int, size: int):
    """An epoch of every island: its population and the elite that came in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (number, island), rows in _groups(batches):
            lengths = np.frombuffer(rows[0]["lengths"], np.int32)
            block = Block(lengths, capacity)
            rng = np.random.default_rng([seed, level, number, island, epoch])
            population = [p for row in rows for p in _unpacked(row["payload"], len(lengths))]
            if not population:
                population = [block.first(rng, 0.0 if i == 0 and island == 0 else 0.4 * rng.random()) for i in range(size)]
            population = block.evolve(population, rng, generations, size)
            yield _state_row(number, island, 0, population, rows[0]["lengths"])
            if islands > 1:
                yield _state_row(number, (island + 1) % islands, 1, population[:1], rows[0]["lengths"])

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[dict]]]:
    """Rows of one block and island, which lie next to each other."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = row["block"], row["island"]
            if held and own != key:
                yield key, held
                held = []
            key = own
            held.append(row)
    if held:
        yield key, held


def _unpacked(payload: bytes | None, n: int) -> list[np.ndarray]:
    return list(np.frombuffer(payload, np.int32).reshape(-1, n)) if payload else []


def _state_row(block: int, island: int, kind: int, population: list[np.ndarray], lengths: bytes) -> pa.RecordBatch:
    payload = np.concatenate(population).astype(np.int32).tobytes()
    return pa.record_batch(
        [
            pa.array([block], pa.int64()),
            pa.array([island], pa.int32()),
            pa.array([kind], pa.int32()),
            pa.array([payload], pa.binary()),
            pa.array([lengths], pa.binary()),
        ],
        names=["block", "island", "kind", "payload", "lengths"],
    )


def _placer(capacity: int, level: int):
    """The best packing of each block as rows: sequence, offset and free places."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (number, _), rows in _groups(batches):
            lengths = np.frombuffer(rows[0]["lengths"], np.int32)
            members = np.frombuffer(rows[0]["payload"], np.int64).reshape(len(lengths), 6)
            block = Block(lengths, capacity)
            found = [p for row in rows[1:] for p in _unpacked(row["payload"], len(lengths))]
            packing = max(found, key=block.fitness)
            order = np.argsort(packing, kind="stable")
            numbers, sizes = packing[order], lengths[order].astype(np.int64)
            before = np.cumsum(sizes) - sizes
            first = np.searchsorted(numbers, numbers, side="left")
            fills = block.fills(packing).astype(np.int64)
            own = members[order]
            doc_id = pa.array(own[:, 0], mask=own[:, 1] > 0)
            rest = _piece_batch(doc_id, own[:, 2], own[:, 3], own[:, 4], own[:, 5])
            sequence = (np.int64(level) << 58) | (np.int64(number) << 16) | numbers.astype(np.int64)
            columns = [
                *rest.columns,
                pa.array(sequence),
                pa.array(before - before[first]),
                pa.array(capacity - fills[numbers]),
            ]
            yield pa.record_batch(columns, names=[*rest.schema.names, "sequence_id", "offset", "free"])

    return place


_PLACED = f"{PIECE_SCHEMA}, sequence_id bigint, offset bigint, free bigint"


def _pack_level(items: DataFrame, n_blocks: int, level: int, capacity: int, seed: int, islands: int, epochs: int) -> DataFrame:
    blocks = shared_table(_blocks(items, n_blocks, level), "pack-blocks")
    state = blocks.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.lit(0).alias("kind"),
        F.lit(None).cast("binary").alias("payload"),
        "lengths",
    )
    for epoch in range(epochs):
        dealt = state.repartition("block", "island").sortWithinPartitions("block", "island", "kind")
        state = dealt.mapInArrow(_evolver(capacity, islands, epoch, level, seed, GENERATIONS, POPULATION), _STATE)
    members = blocks.select("block", F.lit(0).alias("island"), F.lit(-1).alias("kind"), F.col("members").alias("payload"), "lengths")
    final = members.unionByName(state.where("kind = 0").withColumn("island", F.lit(0)))
    final = final.repartition("block").sortWithinPartitions("block", "kind")
    return shared_table(final.mapInArrow(_placer(capacity, level), _PLACED), "packed")


def pack(
    items: DataFrame,
    capacity: int = CAPACITY,
    block_pieces: int = BLOCK_PIECES,
    seed: int = SEED,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """``items(doc_id, piece, start, length, ids_crc32)`` with ``sequence_id`` and ``offset``.

    ``items`` is read several times and should be a table. A full piece is a
    sequence by itself. Every piece is placed, repeated rows too; sequences never
    hold more than ``capacity``. An empty table gives an empty result.

    Each level takes at most half of the pieces of the one before, so there are
    about as many levels as the number of blocks has binary digits.
    """
    full = items.where(F.col("length") >= capacity)
    done = full.select(
        "*",
        (-F.monotonically_increasing_id() - 1).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    rest, level = items.where(F.col("length") < capacity), 1
    n = rest.count()
    while n:
        n_blocks = -(-n // block_pieces)
        placed = _pack_level(rest, n_blocks, level, capacity, seed, islands, epochs)
        free, left = (capacity, 0) if n_blocks == 1 else _to_settle(placed, n // 2)
        done = done.unionByName(placed.where(F.col("free") <= free).drop("free"))
        rest, n, level = placed.where(F.col("free") > free).drop("sequence_id", "offset", "free"), left, level + 1
    return done


def _to_settle(placed: DataFrame, most: int) -> tuple[int, int]:
    """How many free places a settled sequence may have, and how many pieces lie in others.

    ``FREE_PLACES``, unless more than ``most`` pieces would go on: then only those
    of the least filled sequences do, as many as ``most`` allows. The driver gets
    one row for each number of free places.
    """
    counts = placed.groupBy("free").count().orderBy(F.desc("free")).collect()
    left = 0
    for row in counts:
        if row["free"] <= FREE_PLACES or left + row["count"] > most:
            return max(FREE_PLACES, row["free"]), left
        left += row["count"]
    return FREE_PLACES, left


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return pack_documents(documents(spark, sf_dir))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    items = shared_table(pieces(docs, tokenizer or tokenizer_path(TOKENIZER), capacity), "pieces")
    return pack(items, capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
