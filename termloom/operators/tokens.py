"""Texts to tokens and lengths, one row at a time and without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.analyzer import (
    chunk_count,
    has_chunk,
    terms_of_nonblank,
)
from termloom.functions.analyzers import WORDS, Analyzer


def analyze(texts: DataFrame) -> DataFrame:
    """``texts(docid, field, text)`` to ``(docid, field, terms)``.

    Texts without a chunk have no row.
    """
    return texts.where(has_chunk(F.col("text"))).select(
        "docid", "field", terms_of_nonblank(F.col("text")).alias("terms")
    )


def tokenize(texts: DataFrame, analyzer: Analyzer = WORDS) -> DataFrame:
    """``tokens(docid, field, term)``: one row per term, empty terms included."""
    if analyzer != WORDS:
        analyzed = texts.select("docid", "field", analyzer.terms(F.col("text")).alias("terms"))
        return analyzed.select("docid", "field", _each_term()).where(F.col("term").isNotNull())
    return analyze(texts).select("docid", "field", _each_term())


def count_within_rows(texts: DataFrame, analyzer: Analyzer = WORDS) -> DataFrame:
    """``(docid, field, len, term, tf)``: the terms of each text with their counts
    and, before them, one row without a term, which an empty text has as well.
    ``len`` is the length of the text. Nothing is shuffled: equal terms lie next
    to each other in the sorted list, and a count is the distance of two starts.
    """
    analyzed = texts.select("docid", "field", analyzer.terms(F.col("text")).alias("terms"))
    # Not ``array_sort``, which compares by a lambda. No term is null.
    ordered = analyzed.select("docid", "field", F.sort_array("terms").alias("terms"), F.size("terms").alias("n"))
    place = F.sequence(F.lit(1), F.col("n"))
    terms = F.col("terms")
    is_start = F.filter(place, lambda i: (i == 1) | (F.get(terms, i - 1) != F.get(terms, i - 2)))
    starts = F.when(F.col("n") > 0, is_start).otherwise(F.array().cast("array<int>"))
    started = ordered.select("docid", "field", "terms", "n", starts.alias("starts"))
    ends = F.concat(F.slice("starts", 2, F.greatest(F.size("starts"), F.lit(1))), F.array(F.col("n") + 1))
    counts = F.zip_with(
        F.col("starts"),
        F.slice(ends, F.lit(1), F.size("starts")),
        lambda low, high: F.struct(F.get(terms, low - 1).alias("term"), (high - low).cast("bigint").alias("tf")),
    )
    no_term = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("tf")))
    counted = started.select(
        "docid", "field", F.col("n").cast("bigint").alias("len"), F.concat(no_term, counts).alias("counts")
    )
    return counted.select("docid", "field", "len", F.inline_outer("counts"))


def distinct_within_rows(texts: DataFrame, analyzer: Analyzer = WORDS) -> DataFrame:
    """``(term)``: the terms of each text once. Takes half the time of counting them."""
    terms = texts.select(F.array_distinct(analyzer.terms(F.col("text"))).alias("terms"))
    return terms.select(_each_term()).where(F.col("term").isNotNull())


def _each_term() -> Column:
    """One row per term. No array is empty here, so ``explode`` would give the
    same; but for it the optimizer adds a filter on the size of the array and
    moves that down to the scan, where it analyses every text two more times."""
    return F.explode_outer("terms").alias("term")


def text_lengths(texts: DataFrame, analyzer: Analyzer = WORDS) -> DataFrame:
    """``(field, docid, len)`` for each row of ``texts``; an empty text has 0."""
    if analyzer != WORDS:
        n_terms = F.size(analyzer.terms(F.col("text"))).cast("bigint")
        return texts.select("field", "docid", n_terms.alias("len"))
    return texts.select("field", "docid", chunk_count(F.col("text")).alias("len"))
