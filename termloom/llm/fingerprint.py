"""Document fingerprints: a sketch scaled by a threshold.

Every shingle (sixteen bytes of UTF-8) is hashed, and every hash below a fixed
fraction of the range is kept, so a sketch grows with its text. Sketches of
texts merge by union, and the containment of a short text in a very long one
can be estimated from the sketches alone. A text with fewer than ``LEAST`` such
hashes keeps its ``LEAST`` smallest ones instead, so that only the empty text has
an empty sketch; this too can be merged.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import column, documents, ids_and_texts, slices, utf8

#: One hash in so many is kept, and the smallest ones of short texts.
SCALE, LEAST = 32, 8
#: Bytes of text in one range of ids, and ids drawn to place its ends.
RANGE_BYTES, DRAWN = 48 << 20, 16
_HALF = 8
_WIDTH = 2 * _HALF
_ALL = np.uint64(2**64 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def shingle_hashes(text: bytes) -> np.ndarray:
    """A hash for each start of a shingle; a shorter text is one shingle."""
    if not text:
        return np.empty(0, np.uint64)
    if len(text) < _WIDTH:
        text, length = text.ljust(_WIDTH, b"\0"), len(text)
    else:
        length = _WIDTH
    # Eight bytes from every start on, read as numbers at each of eight offsets.
    words = np.empty(len(text) - _HALF + 1, np.uint64)
    for offset in range(_HALF):
        n = (len(text) - offset) // _HALF
        words[offset::_HALF] = np.frombuffer(text, "<u8", n, offset)
    second = _mixed(words[_HALF:] + np.uint64(length))
    return _mixed(words[:-_HALF] + second)


def sketch(text: bytes, scale: int = SCALE) -> np.ndarray:
    """Distinct hashes in rising order: those up to 2^64 / scale, ``LEAST`` at least."""
    return _kept(shingle_hashes(text), scale)


def _kept(hashes: np.ndarray, scale: int) -> np.ndarray:
    low = np.unique(hashes[hashes <= _limit(scale)])
    return low if len(low) >= LEAST else np.unique(hashes)[:LEAST]


def _limit(scale: int) -> np.uint64:
    return np.uint64((1 << 64) // scale - 1)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of the shingles of both."""
    return _kept(np.concatenate([a, b]), scale)


def _covered(a: np.ndarray, scale: int) -> np.uint64:
    """Up to which hash the sketch tells everything about its text."""
    if len(a) < LEAST:
        return _ALL
    return max(a[-1], _limit(scale))


def containment(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> float:
    """The estimated share of a's shingles that b has; 0 where nothing can be told."""
    common = min(_covered(a, scale), _covered(b, scale))
    a, b = a[a <= common], b[b <= common]
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 0.0


def likeness(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> float:
    """Containment of the smaller sketch in the larger; equal ones are alike."""
    if np.array_equal(a, b):
        return 1.0
    return containment(a, b, scale) if len(a) <= len(b) else containment(b, a, scale)


def to_text(hashes: np.ndarray) -> str:
    """Sixteen hexadecimal digits a hash, in rising order."""
    return hashes.astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(doc_id, fingerprint)`` of every row; null and empty texts have ``''``."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [to_text(sketch(text or b"", scale)) for text in utf8(batch, "text")]
            yield pa.record_batch([column(batch, "doc_id"), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    return ids_and_texts(docs).mapInArrow(sketched, "doc_id bigint, fingerprint string")


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows in order of ``doc_id`` within partitions, each followed by its next.

    ``(part int, is_next boolean, doc_id, text)``: a partition is a range of ids
    and ends with the first row of the following range, marked ``is_next`` (the
    last range with the first row of all). Only these heads move twice. Ranges
    hold about ``range_bytes`` of text and are read as streams; the driver keeps
    ``DRAWN`` ids for each. Rows without an id come first; rows of one id are in
    the order of their texts, in one range.
    """
    rows = ids_and_texts(docs)
    text_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    total, n = rows.agg(F.sum(text_bytes + 16), F.count("doc_id")).first()
    n_ranges = max(1, -(-(total or 0) // range_bytes))
    share = min(1.0, DRAWN * n_ranges / max(1, n))
    cuts: list[float] = []
    if n_ranges > 1 and n:
        drawn = rows.select("doc_id").where(F.col("doc_id").isNotNull()).sample(share, 1).toPandas()["doc_id"]
        drawn = np.sort(drawn.to_numpy(np.float64))
        places = (np.arange(1, n_ranges) * len(drawn)) // n_ranges
        cuts = np.unique(drawn[places[places < len(drawn)]]).tolist() if len(drawn) else []
    placed = Bucketizer(
        splits=[-math.inf, *cuts, math.inf] if cuts else [-math.inf, 0.0, math.inf],
        inputCol="place",
        outputCol="bucket",
        handleInvalid="keep",
    ).transform(rows.withColumn("place", F.col("doc_id").cast("double")))
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("bucket").cast("int") + 1).cast("int")
    placed = placed.select("doc_id", "text", part.alias("part"))
    heads = placed.groupBy("part").agg(F.min("doc_id").alias("head")).orderBy("part").toPandas()
    parts = heads["part"].tolist()
    before = pd.DataFrame({"part": parts, "before": parts[-1:] + parts[:-1]}, dtype="int32")
    before["head"] = heads["head"].astype("Int64")
    # One row a range: 16 bytes for each ``range_bytes`` of text.
    known = docs.sparkSession.createDataFrame(
        [(int(p), int(b), None if pd.isna(h) else int(h)) for p, b, h in before.itertuples(index=False)],
        "head_part int, before int, head bigint",
    )
    is_head = (F.col("part") == F.col("head_part")) & F.col("doc_id").eqNullSafe(F.col("head"))
    tagged = placed.join(F.broadcast(known), is_head, "left")
    goes_to = F.array(
        F.struct(F.col("part").alias("to"), F.lit(False).alias("is_next")),
        F.struct(F.col("before").alias("to"), F.lit(True).alias("is_next")),
    )
    dealt = tagged.select("doc_id", "text", F.inline(goes_to)).where(F.col("to").isNotNull())
    dealt = dealt.select(F.col("to").alias("part"), "is_next", "doc_id", "text")
    n_parts = max(parts, default=0) + 1
    return dealt.repartitionById(n_parts, F.col("part")).sortWithinPartitions("part", "is_next", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_edits(docs: DataFrame, scale: int = SCALE, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The fingerprint of each text, of its edited text, and how alike they are."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        # The row that waits for its next: part, id, text and sketch.
        part, doc_id, text, own = None, None, None, None
        for batch in slices(batches, "text", 4 << 20):
            parts, marks = column(batch, "part").to_pylist(), column(batch, "is_next").to_pylist()
            ids, texts = column(batch, "doc_id").to_pylist(), column(batch, "text").to_pylist()
            for to, is_next, next_id, next_text in zip(parts, marks, ids, texts):
                next_text = next_text or ""
                next_own = sketch(next_text.encode(), scale)
                if to == part:
                    after = edited(text, next_text).encode()
                    changed = sketch(after, scale)
                    rows.append(
                        (
                            doc_id,
                            len(text),
                            hashlib.sha256(after).hexdigest(),
                            to_text(own),
                            to_text(changed),
                            likeness(own, changed, scale),
                            likeness(own, next_own, scale),
                        )
                    )
                # Heads are marked last; further rows of the same id add nothing.
                part, doc_id, text, own = (None if is_next else to), next_id, next_text, next_own
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, _TYPES)], names=_NAMES)
            rows = []

    return with_next(docs, range_bytes).mapInArrow(
        compare,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint_edits(documents(spark, sf_dir))
