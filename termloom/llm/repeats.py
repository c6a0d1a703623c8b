"""Removal of repeated passages by bucket-pointer refinement.

A bucket holds the places at which the same bytes begin, and its identifier
stands for them. The bucket of a place for ``2 L`` bytes follows from the
identifiers at the place and ``L`` bytes later, so identifiers are refined by
those of later offsets and used again for the next refinement: 1, 2, 4, ... 128
and last 200 bytes. That part needs no other text and is done where a text is
read; an identifier is a hash, so it means the same everywhere.

Comparing the identifiers of every place of every text would shuffle a row for
each byte. Instead each place is put under one initial q-gram bucket, the
smallest of those inside its 200 bytes. Neighbouring places under the same
q-gram are one segment, and a segment is refined as a whole:

* its q-gram occurs nowhere else: none of its places is repeated;
* its whole content occurs elsewhere: all of its places are;
* otherwise its places are split into ranges, and ranges are put into buckets by
  the bytes that all their places share and refined in the same way, down to
  single places.

All comparisons are counts and joins by bucket identifier. Counts are combined
before they are shuffled, and no bucket is gathered in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import column, documents, forget, ids_and_texts, shared_table, slices, utf8, with_record, with_text
from termloom.llm.words import mixed

LENGTH = 200
GRAM = 32
#: q-grams inside the bytes of a place.
WINDOW = LENGTH - GRAM + 1
#: Places of a text looked at together.
STRETCH = 1 << 22
#: Lengths of the ranges into which open segments are split.
WIDTHS = (16, 4, 1)
_THREE, _FIVE = np.uint64(3), np.uint64(5)
_PLACE_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)


def buckets(raw: np.ndarray, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Bucket identifiers of every place for each of ``lengths``, by refinement."""
    found: dict[int, np.ndarray] = {}
    length, own = 1, mixed(raw.astype(np.uint64) + np.uint64(1))
    for wanted in sorted(lengths):
        while 2 * length <= wanted:
            own = _refined(own, length)
            length *= 2
        found[wanted] = own if length == wanted else _refined(own, wanted - length)
    return found


def _refined(own: np.ndarray, offset: int) -> np.ndarray:
    """Buckets of pairs: the identifier at a place and at a later offset."""
    if len(own) <= offset:
        return own[:0]
    return mixed(own[:-offset] * _THREE + own[offset:])


def _least_within(values: np.ndarray, window: int) -> np.ndarray:
    """The smallest value of every ``window`` neighbours."""
    width, least = 1, values
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = window - width
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def segments(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """The segments of a text: q-gram, content, first place, places, and how far
    the q-gram lies behind the first place."""
    parts = []
    for base in range(0, max(0, len(raw) - LENGTH + 1), STRETCH):
        own = raw[base : base + STRETCH + LENGTH - 1]
        found = buckets(own, (GRAM, LENGTH))
        gram, whole = found[GRAM], found[LENGTH]
        # Of equal q-grams the first one; the place decides the last bits.
        ranked = ((gram >> _PLACE_BITS) << _PLACE_BITS) | np.arange(len(gram), dtype=np.uint64)
        anchor = (_least_within(ranked, WINDOW) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        n = np.diff(np.append(first, len(anchor)))
        at = anchor[first]
        content = mixed(whole[first] * _FIVE + whole[first + n - 1])
        content = mixed(content + (n * 512 + at - first).astype(np.uint64))
        parts.append((gram[at], content, base + first, n, at - first))
    if not parts:
        return tuple(np.empty(0, kind) for kind in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(column) for column in zip(*parts))


def ranges(
    raw: np.ndarray, base: np.ndarray, n: np.ndarray, behind: np.ndarray, number: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of segments, the bucket of the bytes that all their places share,
    and the bucket of their whole content.

    ``raw`` holds the bytes of the segments one after the other; the other columns
    have a row for each range: where its segment begins, the segment's places, how
    far its q-gram lies behind the first, and the number of the range. Ranges are
    counted from the q-gram backward, so they are the same in every segment of
    that q-gram; the ends of a segment may cut them.
    """
    whole = buckets(raw, (128, LENGTH))
    shared = LENGTH - width + 1
    common = _refined(whole[128], shared - 128) if shared > 128 else whole[128]
    last = behind - number * width
    first = last - width + 1
    low, high = np.maximum(first, 0), np.minimum(last, n - 1)
    content = mixed(whole[LENGTH][base + low] * _FIVE + whole[LENGTH][base + high])
    content = mixed(content + ((low - first) * 512 + (last - high)).astype(np.uint64))
    # The shared bytes go from the last place to the end of the first.
    return common[base + last], content


# --- rows -------------------------------------------------------------------


def _text_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, ref)``; equal texts have the same ``ref``. Null is empty."""
    texts = ids_and_texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.select("doc_id", "text", F.xxhash64("text").alias("ref"))


def _all_segments(texts: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", 2 << 20):
            refs = column(batch, "ref").to_pylist()
            found = [segments(np.frombuffer(text, np.uint8)) for text in utf8(batch, "text")]
            if not found:
                continue
            gram, content, first, n, behind = (np.concatenate(c) for c in zip(*found))
            ref = np.repeat(np.array(refs, np.int64), [len(own[0]) for own in found])
            yield pa.record_batch(
                [
                    pa.array(gram.view(np.int64)),
                    pa.array(content.view(np.int64)),
                    pa.array(ref),
                    pa.array(first),
                    pa.array((n * 512 + behind).astype(np.int32)),
                ],
                names=["gram", "content", "ref", "first", "shape"],
            )

    schema = "gram bigint, content bigint, ref bigint, first bigint, shape int"
    return texts.select("text", "ref").mapInArrow(cut, schema)


def _packed(text: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(text)


def _unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _packed_texts(texts: DataFrame, with_id: bool) -> DataFrame:
    """Texts compressed for the shuffle: ``(ref, packed[, doc_id])``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            packed = pa.array([_packed(text) for text in utf8(batch, "text")], pa.binary())
            ids = [column(batch, "doc_id")] if with_id else []
            yield pa.record_batch([column(batch, "ref"), packed, *ids], names=["ref", "packed", "doc_id"][: 2 + with_id])

    return texts.mapInArrow(pack, "ref bigint, packed binary" + (", doc_id bigint" if with_id else ""))


def _contents(texts: DataFrame, open_segments: DataFrame) -> DataFrame:
    """``open_segments(segment, weight, ref, first, shape)`` with their ``bytes``."""
    wanted = open_segments.groupBy("ref").agg(
        F.collect_list(F.struct("segment", "weight", "first", "shape")).alias("wanted")
    )
    joined = _packed_texts(texts.where(F.octet_length("text") >= LENGTH), False).join(wanted, "ref")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed", 2 << 20):
            rows = []
            lists = column(batch, "wanted").to_pylist()
            for ref, packed, own in zip(column(batch, "ref").to_pylist(), column(batch, "packed").to_pylist(), lists):
                text = _unpacked(packed)
                for s in own:
                    n = s["shape"] // 512
                    part = text[s["first"] : s["first"] + n - 1 + LENGTH]
                    rows.append((s["segment"], s["weight"], ref, s["first"], s["shape"], part))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            columns = zip(*rows) if rows else [()] * 6
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=_CONTENT_NAMES)

    found = joined.mapInArrow(cut, "segment bigint, weight int, ref bigint, first bigint, shape int, bytes binary")
    # Copies of a text have given the same segment several times.
    return shared_table(found.dropDuplicates(["segment"]), "segment-bytes")


_CONTENT_NAMES = ["segment", "weight", "ref", "first", "shape", "bytes"]


def _range_rows(contents: DataFrame, width: int) -> DataFrame:
    """``(segment, number, weight, common, content)`` of the chosen ranges of
    ``contents(segment, weight, shape, bytes, chosen)``; null: all ranges."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", 1 << 19):
            texts = column(batch, "bytes").to_pylist()
            size = np.array([len(text) for text in texts], np.int64)
            n, behind = np.divmod(column(batch, "shape").to_numpy().astype(np.int64), 512)
            chosen = column(batch, "chosen")
            if chosen.null_count:
                lowest = (behind - n + 1) // width
                counts = behind // width - lowest + 1
                number = np.arange(counts.sum()) + np.repeat(lowest - (np.cumsum(counts) - counts), counts)
                weight = np.repeat(column(batch, "weight").to_numpy(), counts)
            else:
                counts = pa.compute.list_value_length(chosen).to_numpy().astype(np.int64)
                each = chosen.flatten()
                number, weight = each.field("number").to_numpy().astype(np.int64), each.field("weight").to_numpy()
            own = np.repeat(np.arange(len(texts)), counts)
            base = np.cumsum(size) - size
            raw = np.frombuffer(b"".join(texts), np.uint8)
            common, content = ranges(raw, base[own], n[own], behind[own], number, width)
            yield pa.record_batch(
                [
                    pa.array(column(batch, "segment").to_numpy()[own]),
                    pa.array(number.astype(np.int32)),
                    pa.array(weight.astype(np.int32)),
                    pa.array(common.view(np.int64)),
                    pa.array(content.view(np.int64)),
                ],
                names=["segment", "number", "weight", "common", "content"],
            )

    schema = "segment bigint, number int, weight int, common bigint, content bigint"
    return contents.select("segment", "weight", "shape", "bytes", "chosen").mapInArrow(split, schema)


def _refine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranges that are repeated as a whole, and those to split further.

    ``weight`` is 2 where a range is known to be repeated; such a range goes on
    as one that others may repeat in part.
    """
    same = rows.groupBy("common", "content").agg(
        F.sum("weight").alias("n"), F.min(F.struct("segment", "number")).alias("one")
    )
    same = shared_table(same, "range-buckets")
    whole = rows.where(F.col("weight") == 1).join(same.where(F.col("n") > 1), ["common", "content"])
    shared = same.groupBy("common").agg(F.count("*").alias("n_contents"), F.min("n").alias("least"))
    shared = shared.where((F.col("n_contents") > 1) & (F.col("least") == 1)).select("common")
    further = same.join(shared, "common").select(
        "one.segment", "one.number", F.least("n", F.lit(2)).cast("int").alias("weight")
    )
    return whole.select("segment", "number"), further


def repeated_places(docs: DataFrame) -> DataFrame:
    """``(ref, first, n)``: runs of places at which 200 bytes begin that begin elsewhere too."""
    texts = _text_rows(docs)
    # Written once, since the counts and the join both read all segments.
    every = shared_table(_all_segments(texts), "all-segments")
    grams = every.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("gram")
    shared = shared_table(every.join(grams, "gram"), "segments")

    same = shared.groupBy("gram", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("ref", "first", "shape")).alias("one")
    )
    same = shared_table(same, "segment-buckets")
    n = F.shiftright("shape", 9)
    whole = shared.join(same.where(F.col("n") > 1).select("gram", "content"), ["gram", "content"])
    whole = whole.select("ref", "first", n.alias("n"))

    per_gram = same.groupBy("gram").agg(F.count("*").alias("n_contents"), F.min("n").alias("least"))
    per_gram = per_gram.where((F.col("n_contents") > 1) & (F.col("least") == 1)).select("gram")
    open_segments = same.join(per_gram, "gram").select(
        F.xxhash64("gram", "content").alias("segment"), F.least("n", F.lit(2)).cast("int").alias("weight"), "one.*"
    )
    contents = _contents(texts, open_segments)
    chosen = contents.withColumn("chosen", F.lit(None).cast("array<struct<number:int,weight:int>>"))
    # Counted from the q-gram backward; a place of the segment is ``behind - distance``.
    behind = F.col("shape") % 512
    last_place = F.shiftright("shape", 9) - 1
    places = whole
    for level, width in enumerate(WIDTHS):
        rows = shared_table(_range_rows(chosen, width), "ranges")
        repeated, further = _refine(rows)
        low = F.greatest(behind - F.col("number") * width - (width - 1), F.lit(0))
        high = F.least(behind - F.col("number") * width, last_place)
        found = repeated.join(contents.drop("bytes", "weight"), "segment")
        places = places.unionByName(found.select("ref", (F.col("first") + low).alias("first"), (high - low + 1).alias("n")))
        if level + 1 < len(WIDTHS):
            # A range of this width is some ranges of the next.
            split = width // WIDTHS[level + 1]
            finer = F.explode(F.sequence(F.col("number") * split, F.col("number") * split + (split - 1)))
            fine = further.select("segment", "weight", finer.alias("number")).join(
                contents.select("segment", "shape"), "segment"
            )
            step = WIDTHS[level + 1]
            inside = (F.col("number") * step <= behind) & (F.col("number") * step + step - 1 >= behind - last_place)
            lists = fine.where(inside).groupBy("segment").agg(
                F.collect_list(F.struct("number", "weight")).alias("chosen")
            )
            chosen = contents.join(lists, "segment")
    return places


# --- removal ----------------------------------------------------------------


def kept_bytes(text: bytes, runs: list[tuple[int, int]], whole_characters: bool = False) -> tuple[bytes, int, int]:
    """What is left, how many bytes are removed, and in how many spans.

    A run ``(first, n)`` covers ``n - 1 + 200`` bytes. With ``whole_characters`` a
    span is shortened to whole characters of UTF-8.
    """
    if not runs:
        return text, 0, 0
    edge = np.zeros(len(text) + 1, np.int64)
    first, n = np.array(runs, np.int64).T
    np.add.at(edge, first, 1)
    np.add.at(edge, np.minimum(first + n - 1 + LENGTH, len(text)), -1)
    removed = np.cumsum(edge[:-1]) > 0
    raw = np.frombuffer(text, np.uint8)
    if whole_characters:
        inner = (raw & 0xC0) == 0x80
        character = np.cumsum(~inner) - 1
        removed = (np.bincount(character, ~removed) == 0)[character]
    spans = int((np.diff(removed.astype(np.int8), prepend=0) == 1).sum())
    return raw[~removed].tobytes(), int(removed.sum()), spans


def _with_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, packed, runs)`` of every row of ``docs``."""
    runs = repeated_places(docs).distinct().groupBy("ref").agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    return _packed_texts(_text_rows(docs), True).join(runs, "ref", "left").select("doc_id", "packed", "runs")


def _removed_rows(batch: pa.RecordBatch, whole_characters: bool) -> Iterator[tuple]:
    columns = (column(batch, name).to_pylist() for name in ("doc_id", "packed", "runs"))
    for doc_id, packed, runs in zip(*columns):
        text = _unpacked(packed)
        own = [(run["first"], run["n"]) for run in runs or []]
        yield doc_id, len(text), *kept_bytes(text, own, whole_characters)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row.

    Removed is each byte covered by 200 bytes that begin at another place too,
    in the same text or in any other. Null texts are empty; empty texts and
    those under 200 bytes keep all. Rows with the same text, repeated rows too,
    are different places. Rows without an id take part like others.
    """

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed", 2 << 20):
            rows = [
                (doc_id, size, removed, spans, hashlib.sha256(kept).hexdigest())
                for doc_id, size, kept, removed, spans in _removed_rows(batch, False)
            ]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_REMOVED_NAMES)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return _with_runs(docs).mapInArrow(remove, schema)


_REMOVED_NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``, in whole characters.

    Every row stays, with an empty text if nothing is left; a null text stays null.
    ``n_chars``, if there is such a column, is counted anew for changed texts.
    """
    runs = repeated_places(docs).distinct().groupBy("ref").agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    rows = with_record(docs)
    text = "text" if "text" in rows.columns else "record.text"
    rows = rows.withColumn("ref", F.xxhash64(F.coalesce(text, F.lit(""))))
    joined = rows.join(runs, "ref", "left").drop("ref")

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(with_text(batches), "text", 2 << 20):
            kept = []
            for text, own in zip(utf8(batch, "text"), column(batch, "runs").to_pylist()):
                if text and own:
                    text = kept_bytes(text, [(run["first"], run["n"]) for run in own], True)[0] or b""
                    kept.append(text)
                else:
                    kept.append(None)
            left = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.record_batch([column(batch, "record"), left], names=["record", "left"])

    # "left" is null where a text is as it was.
    found = joined.mapInArrow(shorten, joined.select("record").schema.add("left", "string"))
    changed = {"text": F.coalesce("left", "record.text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = F.when(F.col("left").isNotNull(), F.char_length("left").cast(kind))
        changed["n_chars"] = new.otherwise(F.col("record.n_chars"))
    columns = [changed.get(name, F.col(f"record.`{name}`")).alias(name) for name in docs.columns]
    return found.select(*columns)


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated passages."""
    return remove_repeats(documents(spark, sf_dir))
