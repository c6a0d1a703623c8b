"""Language identification by rank order.

A profile lists the most frequent letter n-grams (one to three letters, with the
blank before and after a word) in falling order of frequency. A text is compared
to the profile of every language by the out-of-place distance: for each of the
text's own most frequent n-grams, how far its place differs from the place in
the language's profile, and the largest possible distance where it is absent.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.llm.common import column, crc_remainder, documents, forget, slices, with_record, with_text

PROFILE_SIZE = 400
TEXT_PROFILE_SIZE = 400
MAX_LANGUAGES = 4096
#: Text taken at a time; the arrays made of it are some fifty times as large.
SLICE_BYTES = 1 << 20
UNDETERMINED = "und"
#: Held out: a fifth of the documents.
FOLDS, HELD_OUT = 5, 0
#: An n-gram packs three code points of 21 bits.
_BITS = np.uint64(21)


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    """For every code point, whether it is a letter (general category L)."""
    return np.fromiter(
        (unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), np.bool_, 0x110000
    )


def ngrams(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """The n-grams of each text, and the alphabet that turns them into letters.

    A gram packs up to three places in the alphabet (0: the blank), each of as
    many bits as the largest place needs. Texts without a letter have none.
    """
    encoded = [text.lower().encode("utf-32-le", "replace") if text else b"" for text in texts]
    ends = np.cumsum([len(text) // 4 for text in encoded])
    codes = np.frombuffer(b"".join(encoded), np.uint32)
    present = np.flatnonzero(np.bincount(codes, minlength=1)) if len(codes) else np.empty(0, np.int64)
    alphabet = np.concatenate([np.zeros(1, np.int64), present[_is_letter()[present]]])
    place = np.zeros(int(present[-1]) + 1 if len(present) else 1, np.uint32)
    place[alphabet[1:]] = np.arange(1, len(alphabet))
    letters = place[codes]
    bits = _bits(alphabet)
    kind = np.uint32 if 3 * bits <= 32 else np.uint64
    shift = kind(bits)
    found = []
    for start, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
        run = letters[start:end]
        # A run of other characters is one blank, also at either end.
        keep = run > 0
        keep[1:] |= keep[:-1].copy()
        run = np.concatenate([np.zeros(1, kind), run[keep].astype(kind), np.zeros(1, kind)])
        blank = run == 0
        if blank.all():
            found.append(np.empty(0, kind))
            continue
        first = 1 if blank[1] else 0
        last = len(run) - 1 if blank[-2] else len(run)
        run, blank = run[first:last], blank[first:last]
        pairs = (run[:-1] << shift) | run[1:]
        triples = (pairs[:-1] << shift) | run[2:]
        found.append(np.concatenate([run[~blank], pairs, triples[~blank[1:-1]]]))
    return found, alphabet


def _bits(alphabet: np.ndarray) -> int:
    return max(1, int(len(alphabet) - 1).bit_length())


def _in_code_points(grams: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """The same grams with 21 bits a letter, whatever the alphabet; order is kept."""
    bits, mask = np.uint64(_bits(alphabet)), np.uint64((1 << _bits(alphabet)) - 1)
    wide, letters = grams.astype(np.uint64), alphabet.astype(np.uint64)
    parts = [letters[((wide >> (bits * np.uint64(k))) & mask).astype(np.int64)] for k in range(3)]
    return parts[0] | (parts[1] << _BITS) | (parts[2] << (_BITS + _BITS))


def counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams in rising order and how often each occurs."""
    if len(grams) and int(grams.max()) < len(grams):
        counts = np.bincount(grams)
        keys = np.flatnonzero(counts)
        return keys.astype(grams.dtype), counts[keys]
    return np.unique(grams, return_counts=True)


def most_frequent(grams: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, in falling order; ties by number."""
    keys, counts = counted(grams)
    if len(keys) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        chosen = counts > least
        chosen[np.flatnonzero(counts == least)[: size - int(chosen.sum())]] = True
        keys, counts = keys[chosen], counts[chosen]
    return keys[np.argsort(-counts, kind="stable")]


def profiles(labelled: DataFrame, size: int = PROFILE_SIZE) -> DataFrame:
    """``(lang, rank, gram)`` from all of ``labelled(text, lang)``.

    Each task counts its rows for itself; only sums of n-grams are shuffled.
    Rows without a language, text or letter add nothing.
    """
    known = labelled.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    partial = known.mapInArrow(_count_ngrams, "lang string, gram bigint, n bigint")
    sums = partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = sums.select("lang", "gram", (F.row_number().over(order) - 1).alias("rank"))
    return ranked.where(F.col("rank") < size)


def _count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in slices(batches, "text", SLICE_BYTES):
        grams, alphabet = ngrams(column(batch, "text").to_pylist())
        by_language: dict[str, list[np.ndarray]] = {}
        for own, lang in zip(grams, column(batch, "lang").to_pylist()):
            by_language.setdefault(lang, []).append(own)
        for lang, found in by_language.items():
            keys, counts = counted(np.concatenate(found))
            keys = _in_code_points(keys, alphabet)
            if lang in sums:
                keys = np.concatenate([sums[lang][0], keys])
                counts = np.concatenate([sums[lang][1], counts])
                keys, place = np.unique(keys, return_inverse=True)
                counts = np.bincount(place, counts).astype(np.int64)
            sums[lang] = keys, counts
    for lang, (keys, counts) in sums.items():
        for start in range(0, len(keys), 50_000):
            part = slice(start, start + 50_000)
            n = len(keys[part])
            yield pa.record_batch(
                [pa.array([lang] * n), pa.array(keys[part].astype(np.int64)), pa.array(counts[part])],
                names=["lang", "gram", "n"],
            )


class Identifier:
    """Profiles of all languages in one table of ranks, sent to every task."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE_SIZE) -> None:
        self.languages = sorted({lang for lang, _, _ in rows})
        place = {lang: i for i, lang in enumerate(self.languages)}
        self.grams = np.unique(np.array([gram for _, _, gram in rows], np.uint64))
        self.size = size
        self.ranks = np.full((len(self.grams), len(self.languages)), -1, np.int32)
        for lang, rank, gram in rows:
            self.ranks[np.searchsorted(self.grams, np.uint64(gram)), place[lang]] = rank

    def predict(self, texts: list[str | None], text_size: int = TEXT_PROFILE_SIZE) -> list[tuple[str, float]]:
        """Language and likeness (1: same order, 0: nothing in common).

        ``und`` and 0 without text, letters or languages; of equal distances
        the first language in the alphabet.
        """
        grams, alphabet = ngrams(texts)
        return [self._nearest(own, alphabet, text_size) for own in grams]

    def _nearest(self, grams: np.ndarray, alphabet: np.ndarray, text_size: int) -> tuple[str, float]:
        if not len(grams) or not self.languages:
            return UNDETERMINED, 0.0
        own = _in_code_points(most_frequent(grams, text_size), alphabet)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        ranks = np.where((self.grams[at] == own)[:, None], self.ranks[at], -1)
        worst = max(self.size, text_size)
        place = np.arange(len(own), dtype=np.int32)[:, None]
        distance = np.where(ranks < 0, worst, np.abs(ranks - place)).sum(axis=0)
        best = int(np.argmin(distance))
        return self.languages[best], 1.0 - float(distance[best]) / (worst * len(own))


def learn_languages(labelled: DataFrame, size: int = PROFILE_SIZE) -> Identifier:
    """The driver gets ``size`` rows a language, for ``MAX_LANGUAGES`` at most."""
    rows = profiles(labelled, size).limit(size * MAX_LANGUAGES + 1).collect()
    if len(rows) > size * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return Identifier([(r["lang"], r["rank"], r["gram"]) for r in rows], size)


def identify_rows(docs: DataFrame, identifier: Identifier) -> DataFrame:
    """``(record struct, lang_pred, score)``: every row of ``docs``, whatever its columns."""
    shared = docs.sparkSession.sparkContext.broadcast(identifier)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        model = shared.value
        for batch in slices(with_text(batches), "text", SLICE_BYTES):
            found = model.predict(column(batch, "text").to_pylist())
            yield pa.record_batch(
                [
                    column(batch, "record"),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=["record", "lang_pred", "score"],
            )

    rows = with_record(docs)
    schema = rows.select("record").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(predict, schema)


def identify(docs: DataFrame, identifier: Identifier) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``docs(doc_id, text)``."""
    found = identify_rows(docs.select("doc_id", "text"), identifier)
    return found.select(F.col("record.doc_id").cast("bigint").alias("doc_id"), "lang_pred", "score")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four folds of five.

    A row whose id is null has no fold: nothing is learned from it, and
    ``held_out`` is null.
    """
    docs = documents(spark, sf_dir)
    training = docs.where(crc_remainder("doc_id", FOLDS) != HELD_OUT)
    predicted = identify(docs, learn_languages(training))
    return predicted.select(
        "doc_id", (crc_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )
