"""Toxicity by a weighted lexicon.

A text is folded (case, look-alike letters, digits that stand for letters,
invisible characters; whatever is no letter, digit or mark, in any script, is a
blank; accents stay) and searched
once for all entries of the lexicon by an Aho-Corasick automaton. An entry is
the start of a word or a whole word; of several entries that begin at one word
the heaviest counts. A hit inside an exception phrase does not count. The sum of
weights, normalised by the length of the text, is turned into a probability.

Lexicon, weights, exceptions and the probability are learned from labelled
texts: at most ``MAX_LABELLED`` of them, those with the smallest hashes.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import (
    column,
    crc_remainder,
    documents,
    forget,
    ids_and_texts,
    shared_table,
    slices,
    with_record,
    with_text,
)

#: Labelled texts to learn from, at most.
MAX_LABELLED = 60_000
#: Text taken at a time; the arrays made of it are some fifty times as large.
SLICE_BYTES = 1 << 20
#: Entries of the lexicon and exception phrases, at most.
MAX_ENTRIES, MAX_EXCEPTIONS = 5_000, 5_000
#: An entry occurs in so many toxic texts at least ...
MIN_TOXIC = 4
#: ... and its log odds, less twice their standard error, are at least this.
MIN_LOG_ODDS = 1.5
#: Lengths of word starts that may be entries.
STARTS = range(4, 9)
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
LENGTH_BINS = 200

# Digits and signs that stand for letters; i, l and 1 are one.
_DIGITS = {"0": "o", "1": "i", "l": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
# Cyrillic and Greek letters that look like Latin ones.
_LOOK_ALIKE = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i",
}
# Characters that are not seen.
_INVISIBLE = ["­", "​", "‌", "‍", "⁠", "﻿"]


class _Wide(dict):
    """For ``str.translate``: what a character outside of ASCII is read as.

    A letter in another style (wide, mathematical, circled) is the plain one. A
    letter, digit or mark stays; everything else parts words like a blank.
    """

    def __missing__(self, code: int) -> str:
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char).lower()
        if code < 128:
            plain = char
        elif not (plain.isascii() and plain.isalnum()):
            plain = char if unicodedata.category(char)[0] in "LNM" else " "
        self[code] = plain
        return plain


def _tables() -> tuple[bytes, dict[int, str | None]]:
    ascii_table = bytearray(range(256))
    for code in range(128):
        char = chr(code).lower()
        char = _DIGITS.get(char, char)
        ascii_table[code] = ord(char) if char.isalpha() or char.isdigit() else 0x20
    wide: dict[int, str | None] = _Wide({ord(a): b for a, b in _LOOK_ALIKE.items()})
    wide |= {0xFEE0 + code: chr(code) for code in range(0x21, 0x7F)}
    wide |= {ord(char): None for char in _INVISIBLE}
    return bytes(ascii_table), wide


_ASCII, _WIDE = _tables()
# Signs that may be an i or l: ! within a word, | also at its start or end.
_STROKES = re.compile(r"(?<=\w)[|!]+(?=\w)|(?<=\w)\|+|\|+(?=\w)")


def _seen(text: str) -> str:
    text = text.lower()
    return text if text.isascii() else text.translate(_WIDE)


def readings(text: str) -> list[str]:
    """The text folded; with strokes within words, also as if they parted words."""
    text = _seen(text)
    if "|" not in text and "!" not in text:
        return [_folded(text)]
    joined, parted = _folded(_STROKES.sub(lambda found: "i" * len(found[0]), text)), _folded(text)
    return [joined] if joined == parted else [joined, parted]


def fold(text: str) -> str:
    """Lower case, look-alikes and digits as letters, one blank around every word.

    The letters i and l are one, since 1, | and ! stand for both.
    """
    return readings(text)[0]


def _folded(text: str) -> str:
    words = text.encode("utf-8", "replace").translate(_ASCII).split()
    return " " + b" ".join(words).decode() + " "


def features(folded: str) -> set[str]:
    """What may become an entry: the words of a text and their starts."""
    words = set(folded.split())
    found = {f" {word} " for word in words if len(word) > 2}
    for size in STARTS:
        found.update(" " + word[:size] for word in words if len(word) > size)
    return found


@dataclass
class Lexicon:
    """Entries and exceptions begin with a blank; whole words also end with one."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    #: Of the probability: at no hit, and for each unit of log(1 + density).
    offset: float = 0.0
    slope: float = 0.0

    def __post_init__(self) -> None:
        self._automaton = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_automaton": None}

    def hits(self, folded: str) -> dict[int, float]:
        """Where a word begins that is hit, and the weight of its heaviest entry."""
        if not self.weights:
            return {}
        if self._automaton is None:
            automaton = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                automaton.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                automaton.add_word(phrase, (len(phrase), None))
            automaton.make_automaton()
            self._automaton = automaton
        found: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (size, weight) in self._automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                excused.append((start, end))
            elif weight > found.get(start, 0.0):
                found[start] = weight
        for start, end in excused:
            for at in [at for at in found if start <= at < end]:
                del found[at]
        return found

    def density(self, text: str | None) -> float:
        """The weight of all hits over the logarithm of the number of words; of
        several readings of a text the heaviest counts."""
        if not text:
            return 0.0
        return max(sum(self.hits(folded).values()) / math.log2(1 + folded.count(" ")) for folded in readings(text))

    def score(self, text: str | None) -> float:
        return 1.0 / (1.0 + math.exp(-(self.offset + self.slope * math.log1p(self.density(text)))))


def labelled_texts(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """``(text, toxic int, half int)`` of at most ``most`` labelled documents.

    Their ids and labels (12 bytes a row, so their size is bounded) are sent to
    the tasks that scan the documents. A document with several labels has the
    largest; rows without id, label or text are left out. Of equal texts with the
    same label one is kept, so that a copied text does not make entries.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    chosen = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id", F.lit("labelled")), "doc_id").limit(most)
    texts = ids_and_texts(docs).where(F.col("text").isNotNull())
    joined = texts.join(F.broadcast(chosen), "doc_id")
    half = F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2)).cast("int")
    distinct = joined.select("text", "toxic").distinct()
    return shared_table(distinct.select("text", "toxic", half.alias("half")), "labelled")


def _partial_counts(sample: DataFrame, items) -> DataFrame:
    """``(item, toxic, clean)``: in how many texts of either kind each item occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        kinds: tuple[Counter, Counter] = Counter(), Counter()
        for batch in slices(batches, "text", SLICE_BYTES):
            for text, toxic in zip(column(batch, "text").to_pylist(), column(batch, "toxic").to_pylist()):
                kinds[toxic > 0].update(set().union(*map(items, readings(text))))
            if len(kinds[0]) + len(kinds[1]) > 400_000:
                yield from _count_rows(kinds)
                kinds[0].clear(), kinds[1].clear()
        yield from _count_rows(kinds)

    partial = sample.select("text", "toxic").mapInArrow(count, "item string, toxic bigint, clean bigint")
    return partial.groupBy("item").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _count_rows(kinds: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
    clean, toxic = kinds
    found = list(clean.keys() | toxic.keys())
    for start in range(0, len(found), 50_000):
        part = found[start : start + 50_000]
        yield pa.record_batch(
            [
                pa.array(part),
                pa.array([toxic[item] for item in part], pa.int64()),
                pa.array([clean[item] for item in part], pa.int64()),
            ],
            names=["item", "toxic", "clean"],
        )


def learn_toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Lexicon:
    """Entries and exceptions from one half of the sample, the probability from the other."""
    sample = labelled_texts(docs, labels, most)
    first, second = sample.where("half = 0"), sample.where("half = 1")
    totals = {r["toxic"] > 0: r["n"] for r in first.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = totals.get(True, 0), totals.get(False, 0)

    counts = _partial_counts(first, features).where(F.col("toxic") >= MIN_TOXIC)
    odds = F.log((F.col("toxic") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(n_clean + 1.0))
    error = F.sqrt(1.0 / (F.col("toxic") + 0.5) + 1.0 / (F.col("clean") + 0.5))
    chosen = counts.select("item", "toxic", odds.alias("odds"), error.alias("error"))
    chosen = chosen.where(F.col("odds") - 2 * F.col("error") >= MIN_LOG_ODDS)
    chosen = chosen.orderBy(F.desc(F.col("odds") * F.col("toxic")), "item").limit(MAX_ENTRIES)
    lexicon = Lexicon({r["item"]: r["odds"] for r in chosen.collect()})
    if lexicon.weights:
        phrases = _partial_counts(first, lambda folded: _phrases(folded, lexicon))
        excused = phrases.where((F.col("clean") >= 3) & (F.col("clean") > 3 * F.col("toxic")))
        excused = excused.orderBy(F.desc("clean"), "item").limit(MAX_EXCEPTIONS)
        lexicon = Lexicon(lexicon.weights, [r["item"] for r in excused.collect()])
    lexicon.offset, lexicon.slope = _fit(_density_counts(second, lexicon))
    return lexicon


def _phrases(folded: str, lexicon: Lexicon) -> set[str]:
    """Every word that is hit, with the word before and with the word after."""
    found = set()
    for at in lexicon.hits(folded):
        before = folded[max(0, at - 64) : at].split()
        after = folded[at : at + 128].split()
        if before:
            found.add(f" {before[-1]} {after[0]} ")
        if len(after) > 1:
            found.add(f" {after[0]} {after[1]} ")
    return found


def _density_counts(sample: DataFrame, lexicon: Lexicon) -> list[tuple[float, int, int]]:
    """``(log(1 + density), texts, toxic texts)`` in bins of the density."""

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", SLICE_BYTES):
            x = [min(LENGTH_BINS, round(20 * math.log1p(lexicon.density(t)))) for t in column(batch, "text").to_pylist()]
            yield pa.record_batch([pa.array(x, pa.int32()), column(batch, "toxic")], names=["bin", "toxic"])

    counts = sample.select("text", "toxic").mapInArrow(bins, "bin int, toxic int").groupBy("bin")
    rows = counts.agg(F.count("*").alias("n"), F.count_if(F.col("toxic") > 0).alias("toxic")).collect()
    return sorted((r["bin"] / 20, r["n"], r["toxic"]) for r in rows)


def _fit(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Logistic regression on the bins by Newton's method, with a weak prior."""
    if not bins:
        return -2.0, 0.0
    x, n, toxic = (np.array(part, float) for part in zip(*bins))
    design = np.stack([np.ones_like(x), x], axis=1)
    prior = np.diag([0.01, 0.01])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (toxic - n * p) - prior @ beta
        step = np.linalg.solve(design.T @ (design * (n * p * (1 - p))[:, None]) + prior, gradient)
        beta += np.clip(step, -2, 2)
    return float(beta[0]), float(beta[1])


def score_rows(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``(record struct, score)``: every row of ``docs``; a null or empty text has no hit."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        model = shared.value
        for batch in slices(with_text(batches), "text", SLICE_BYTES):
            scores = [model.score(text) for text in column(batch, "text").to_pylist()]
            yield pa.record_batch([column(batch, "record"), pa.array(scores, pa.float64())], names=["record", "score"])

    rows = with_record(docs)
    return rows.mapInArrow(score, rows.select("record").schema.add("score", "double"))


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``(doc_id, score)`` of every row of ``docs(doc_id, text)``."""
    found = score_rows(docs.select("doc_id", "text"), lexicon)
    return found.select(F.col("record.doc_id").cast("bigint").alias("doc_id"), "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels of three folds of four.

    A row whose id is null has no label and no fold (``held_out`` is null).
    """
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_remainder("doc_id", FOLDS) != HELD_OUT)
    scored = score_toxicity(docs, learn_toxicity(docs, labels))
    return scored.select(
        "doc_id",
        (crc_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
