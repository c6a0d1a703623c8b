"""Counts of frequent grams, level by level, without moving the places of grams.

Texts are cut into slices. Terms are counted first, and those that are frequent are
numbered, the most frequent ones first. A text is then the numbers of its terms, with one 0
for whatever is seldom and at its end; this is written once and read by each level. An
n-gram is looked for where a frequent (n-1)-gram follows on another one, and is counted
within its slice before it is moved: a slice gives one row for each bucket into which grams
fall by their hashes, with the numbers of its terms and its counts, packed. What is seldom
is known where a bucket is added up.

Which (n-1)-grams are frequent is known from a bitmap of their hashes, of ``MOST_BITS`` at
most. A seldom gram with the bit of a frequent one is counted in vain and left out in its
bucket, so results are exact.

A docid with one row for its field is counted with its row. Those with several rows are
moved with the grams and counted once for each gram.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.analyzers import Analyzer
from termloom.operators.build import _repeats
from termloom.operators.retrieve import MAX_BROADCAST_ROWS
from termloom.scratch import written
from termloom.sources.corpus import Corpus

#: Terms of a slice (one text at least).
SLICE_TERMS = 1 << 21
#: Buckets of terms, and terms of the corpus for each bucket of grams.
TERM_BUCKETS, TERMS_PER_BUCKET = 128, 1 << 20
#: Bits for each frequent gram, and the powers of two between which their number lies.
BITS_EACH, LEAST_BITS, MOST_BITS = 8, 15, 28

_TERMS = "field string, bucket int, counts binary, terms binary"
_ARROW_TERMS = pa.schema([("field", pa.string()), ("bucket", pa.int32()), ("counts", pa.binary()), ("terms", pa.binary())])
_TERM_COUNTS = "field string, term string, cf bigint"
_SLICES = "field string, numbers binary, docids array<string>"
_ARROW_SLICES = pa.schema([("field", pa.string()), ("numbers", pa.binary()), ("docids", pa.list_(pa.string()))])
_COUNTS = "field string, bucket int, counts binary, docids array<string>"
_ARROW_COUNTS = pa.schema(
    [("field", pa.string()), ("bucket", pa.int32()), ("counts", pa.binary()), ("docids", pa.list_(pa.string()))]
)
_GRAMS = "n int, field string, term string, df bigint, cf bigint, hash bigint"


def count_grams(corpus: Corpus, longest: int, least: int, analyzer: Analyzer) -> DataFrame:
    """``(n, field, term, df, cf)`` of the grams of up to ``longest`` terms that occur
    ``least`` times or more in a field of the corpus."""
    texts = _analyzed(corpus, analyzer)
    spark = texts.sparkSession
    terms = _frequent_terms(texts, least)
    if not terms.num_rows:
        return spark.createDataFrame([], _GRAMS).drop("hash")
    buckets = 1 + pc.sum(terms["cf"]).as_py() // TERMS_PER_BUCKET
    by_field = {field: terms["term"].filter(pc.equal(terms["field"], field)).combine_chunks() for field in _distinct(terms["field"])}
    known = spark.sparkContext.broadcast(by_field)
    slices = written(texts.mapInArrow(_numbered(known, SLICE_TERMS), _SLICES), "slices")
    filters: dict[int, Broadcast] = {}
    levels: list[DataFrame] = []
    for n in range(1, longest + 1):
        counts = slices.mapInArrow(_counted(n, filters, buckets), _COUNTS)
        level = written(counts.groupBy("field", "bucket").applyInArrow(_added(n, least, known), _GRAMS), "grams")
        levels.append(level)
        if n < longest and n > 1:
            n_frequent = level.count()
            if not n_frequent:
                break
            filters[n] = spark.sparkContext.broadcast(_bitmap(level, n_frequent))
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found.drop("hash")


def _analyzed(corpus: Corpus, analyzer: Analyzer) -> DataFrame:
    """``(field, docid, terms)``, where docids with one row for their field are null."""
    texts, again = corpus.texts, F.lit(True)
    if not corpus.many_rows:
        repeats = written(_repeats(corpus.keys).distinct().select(F.col("docid").alias("other")), "repeats")
        n_repeats = repeats.count()
        if not n_repeats:
            again = F.lit(False)
        elif n_repeats <= MAX_BROADCAST_ROWS:
            marked = F.broadcast(repeats.withColumn("again", F.lit(True)))
            texts = texts.join(marked, F.col("docid").eqNullSafe(F.col("other")), "left")
            again = F.coalesce("again", F.lit(False))
    # A null docid is one, too.
    docid = F.coalesce(F.concat(F.lit("+"), F.col("docid").cast("string")), F.lit("-"))
    return texts.select("field", F.when(again, docid).alias("docid"), analyzer.terms(F.col("text")).alias("terms"))


# --- terms ----------------------------------------------------------------------------


def _frequent_terms(texts: DataFrame, least: int) -> pa.Table:
    """``(field, term, cf)`` of the frequent terms, the most frequent ones first."""
    size = SLICE_TERMS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for field, _, _, terms in _slices(batches, size):
            coded = terms.dictionary_encode()
            counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            written_terms = coded.dictionary.cast(pa.binary())
            bucket = np.fromiter((zlib.crc32(term) for term in written_terms.to_pylist()), np.int64, len(counts)) % TERM_BUCKETS
            rows = []
            for number, which in _parted(bucket, TERM_BUCKETS):
                some = written_terms.take(pa.array(which))
                lengths = pc.binary_length(some).to_numpy()
                joined = pc.binary_join(pa.ListArray.from_arrays([0, len(some)], some), b"")[0].as_py()
                rows.append((field, number, _packed(counts[which], lengths), _squeezed(joined)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ARROW_TERMS.types)], schema=_ARROW_TERMS)
        _release()

    def added(rows: pa.Table) -> pa.Table:
        counts, words = [], []
        for packed, joined in zip(rows["counts"].to_pylist(), rows["terms"].to_pylist()):
            some, lengths = _unpacked(packed)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            words.append(pa.StringArray.from_buffers(len(lengths), pa.py_buffer(ends), pa.py_buffer(_unsqueezed(joined))))
            counts.append(some)
        coded = pa.concat_arrays(words).dictionary_encode()
        sums = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(sums, coded.indices.to_numpy(), np.concatenate(counts))
        kept = np.flatnonzero(sums >= least)
        return pa.table(
            {"field": pa.array([rows["field"][0].as_py()] * len(kept), pa.string()), "term": coded.dictionary.take(pa.array(kept)), "cf": sums[kept]}
        )

    found = texts.mapInArrow(counted, _TERMS).groupBy("field", "bucket").applyInArrow(added, _TERM_COUNTS)
    return found.toArrow().sort_by([("cf", "descending"), ("term", "ascending")])


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, np.ndarray, pa.Array, pa.Array]]:
    """``(field, lengths, docids, terms)`` of texts of one field with about ``size`` terms."""
    pending: list[pa.RecordBatch] = []
    n_terms = 0
    for batch in batches:
        lengths = pc.list_value_length(batch.column(2)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (n_terms + np.cumsum(lengths)) // size
        starts = np.flatnonzero(np.diff(part, prepend=part[:1])).tolist()
        for start, end in zip([0, *starts], [*starts, len(lengths)]):
            if start and pending:
                yield from _by_field(pending)
                pending, n_terms = [], 0
            if end > start:
                pending.append(batch.slice(start, end - start))
                n_terms += int(lengths[start:end].sum())
        if n_terms >= size:
            yield from _by_field(pending)
            pending, n_terms = [], 0
    if pending:
        yield from _by_field(pending)


def _by_field(batches: list[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, pa.Array, pa.Array]]:
    rows = pa.Table.from_batches(batches)
    for field in _distinct(rows["field"]):
        some = rows.filter(pc.equal(rows["field"], field)).combine_chunks()
        lists = some["terms"].combine_chunks()
        lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        terms = lists.flatten()
        if len(terms):
            yield field, lengths, some["docid"].combine_chunks(), terms


def _distinct(fields: pa.ChunkedArray) -> list[str]:
    return sorted(pc.unique(fields).to_pylist())


# --- levels -----------------------------------------------------------------------------


def _numbered(known: Broadcast, size: int):
    """Texts to the numbers of their terms, from 1."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for field, lengths, docids, terms in _slices(batches, size):
            if field not in known.value:
                continue
            coded = terms.dictionary_encode()
            of_term = pc.index_in(coded.dictionary, value_set=known.value[field]).fill_null(-1).to_numpy() + 1
            ends = np.cumsum(lengths)
            # A 0 after each text; of several in a row one is kept.
            numbers = np.insert(of_term[coded.indices.to_numpy()], ends, 0)
            text = np.insert(np.repeat(np.arange(len(lengths)), lengths), ends, 0)
            frequent = numbers > 0
            sizes = np.bincount(text[frequent], minlength=len(lengths))
            numbers = numbers[frequent | np.concatenate([[True], frequent[:-1]])]
            several = docids if docids.null_count < len(docids) else None
            yield pa.RecordBatch.from_arrays(
                [pa.array([field]), pa.array([_packed(numbers, sizes)], pa.binary()), pa.array([several and several.to_pylist()], pa.list_(pa.string()))],
                schema=_ARROW_SLICES,
            )
        _release()

    return numbered


def _counted(n: int, filters: dict[int, Broadcast], buckets: int):
    """The grams of ``n`` terms of each slice, with their counts, by bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for field, packed, docids in zip(*(column.to_pylist() for column in batch.columns)):
                rows = list(_counted_slice(n, filters, buckets, field, *_unpacked(packed), docids))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ARROW_COUNTS.types)], schema=_ARROW_COUNTS)
        _release()

    return counted


def _counted_slice(
    n: int, filters: dict[int, Broadcast], buckets: int, field: str, numbers: np.ndarray, sizes: np.ndarray, docids: list | None
) -> Iterator[tuple]:
    text = np.zeros(len(numbers), np.int64)
    text[numbers > 0] = np.repeat(np.arange(len(sizes)), sizes)
    at, hashes, key = _places(n, filters, field, numbers)
    if not len(at):
        return
    order = np.argsort(key, kind="stable")
    key, texts = key[order], text[at[order]]
    starts = np.concatenate([[True], key[1:] != key[:-1]])
    first = starts | np.concatenate([[True], texts[1:] != texts[:-1]])
    several = np.array([docid is not None for docid in docids or [None] * len(sizes)])[texts]
    begin = np.flatnonzero(starts)
    cf = np.diff(begin, append=len(key))
    df = np.add.reduceat((first & ~several).astype(np.int64), begin)
    begin_at, gram_hash = at[order[begin]], hashes[order[begin]]
    pair_gram, pair_text = (np.cumsum(starts) - 1)[first & several], texts[first & several]
    for bucket, which in _parted((gram_hash % np.uint64(buckets)).astype(np.int64), buckets):
        columns = [numbers[begin_at[which] + i] for i in range(n)]
        columns[0] = np.diff(columns[0], prepend=0)
        pairs, names = [np.zeros(0, np.int64)] * 2, None
        if len(pair_gram):
            # Pairs lie by gram, and so do the grams of a bucket.
            place = np.searchsorted(which, pair_gram)
            mine = which[np.minimum(place, len(which) - 1)] == pair_gram
            some, codes = np.unique(pair_text[mine], return_inverse=True)
            pairs, names = [place[mine], codes], [docids[i] for i in some]
        yield field, bucket, _packed(*columns, cf[which], df[which], *pairs), names


def _places(n: int, filters: dict[int, Broadcast], field: str, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the grams of ``n`` terms that may be frequent begin, their hashes, and a
    number for each that equal ones, and only they, share and that grows with the terms."""
    at = np.flatnonzero(numbers)
    key = numbers[at].astype(np.int64)
    hashes = _mixed(key.astype(np.uint64) + np.uint64(zlib.crc32(field.encode()) << 32))
    for k in range(2, n + 1):
        if k > 2:
            bits, bitmap = filters[k - 1].value
            slot = hashes >> np.uint64(64 - bits)
            kept = (bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0
            at, hashes, key = at[kept], hashes[kept], key[kept]
            key = np.unique(key, return_inverse=True)[1]
        follows = np.flatnonzero(at[1:] == at[:-1] + 1)
        at = at[follows]
        last = numbers[at + k - 1].astype(np.int64)
        key = (key[follows] << 32) + last
        hashes = _mixed(hashes[follows] + last.astype(np.uint64))
    return at, hashes, key


def _added(n: int, least: int, known: Broadcast):
    """Adds up the counts of a bucket and writes out the grams that are frequent."""

    def added(rows: pa.Table) -> pa.Table:
        field = rows["field"][0].as_py()
        parts = [_unpacked(packed) for packed in rows["counts"].to_pylist()]
        lengths = [len(part[0]) for part in parts]
        columns = [np.concatenate([np.cumsum(part[0]) if i == 0 else part[i] for part in parts]) for i in range(n + 2)]
        order = np.lexsort(columns[n - 1 :: -1])
        starts = np.zeros(len(order), bool)
        starts[0] = True
        for column in columns[:n]:
            ordered = column[order]
            starts[1:] |= ordered[1:] != ordered[:-1]
        begin = np.flatnonzero(starts)
        cf, df = (np.add.reduceat(column[order], begin) for column in columns[n:])
        names = [name for some in rows["docids"].to_pylist() for name in some or []]
        if names:
            gram = np.empty(len(order), np.int64)
            gram[order] = np.cumsum(starts) - 1
            codes = pa.array(names, pa.string()).dictionary_encode().indices.to_numpy().astype(np.int64)
            n_names = [len(some or []) for some in rows["docids"].to_pylist()]
            entry = np.concatenate([part[n + 2] + offset for part, offset in zip(parts, np.cumsum([0, *lengths]))])
            docid = codes[np.concatenate([part[n + 3] + offset for part, offset in zip(parts, np.cumsum([0, *n_names]))])]
            pairs = np.unique(gram[entry] * len(names) + docid)
            df = df + np.bincount(pairs // len(names), minlength=len(df))
        kept = np.flatnonzero(cf >= least)
        numbers = [column[order[begin[kept]]] for column in columns[:n]]
        hashes = _mixed(numbers[0].astype(np.uint64) + np.uint64(zlib.crc32(field.encode()) << 32))
        for column in numbers[1:]:
            hashes = _mixed(hashes + column.astype(np.uint64))
        terms = [known.value[field].take(pa.array(column - 1)) for column in numbers]
        return pa.table(
            {
                "n": pa.array(np.full(len(kept), n, np.int32)),
                "field": pa.array([field] * len(kept), pa.string()),
                "term": pc.binary_join_element_wise(*terms, " ") if n > 1 else terms[0],
                "df": df[kept],
                "cf": cf[kept],
                "hash": hashes.view(np.int64),
            }
        )

    return added


def _bitmap(level: DataFrame, n_frequent: int) -> tuple[int, np.ndarray]:
    """How many bits of a hash count, and which of these numbers frequent grams have."""
    bits = min(max((BITS_EACH * n_frequent).bit_length(), LEAST_BITS), MOST_BITS)
    # Spark counts both from 1 for numbers from 1.
    slot = F.shiftrightunsigned("hash", 64 - bits) + 1
    pieces = level.groupBy(F.bitmap_bucket_number(slot).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("set")
    )
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for piece in pieces.toArrow().to_pylist():
        some = np.frombuffer(piece["set"], np.uint8)
        begin = (piece["piece"] - 1) * len(some)
        bitmap[begin : begin + len(some)] = some
    return bits, bitmap


# --- numbers ----------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit number to another one (the end of splitmix64), all bits mixed."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _parted(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that is not empty with its places, in order."""
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    for number, (begin, end) in enumerate(zip([0, *ends], ends)):
        if end > begin:
            yield number, order[begin:end]


def _packed(*columns: np.ndarray) -> bytes:
    """Numbers of 32 bits, byte by byte, so that high bytes lie side by side."""
    head = np.array([len(columns), *map(len, columns)], "<i4").tobytes()
    planes = [np.ascontiguousarray(column.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes() for column in columns]
    return _squeezed(b"".join([head, *planes]))


def _unpacked(packed: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(_unsqueezed(packed), np.uint8)
    n_columns = int(raw[:4].view("<i4")[0])
    lengths = raw[4 : 4 + 4 * n_columns].view("<i4")
    ends = 4 + 4 * n_columns + 4 * np.cumsum([0, *lengths])
    planes = [raw[begin:end].reshape(4, -1).T for begin, end in zip(ends, ends[1:])]
    return [np.ascontiguousarray(some).view("<i4").reshape(-1).astype(np.int64) for some in planes]


def _squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unsqueezed(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def _release() -> None:
    """A Python worker outlives its task: give free memory back."""
    pa.default_memory_pool().release_unused()
