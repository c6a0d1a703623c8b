"""The index: aggregations over tokens, and the merge of two indexes.

Postings are a long table with one row per field, term and document, so a
frequent term is many rows and never one large value. Each posting carries the
length of its field in its document, which spares every search a join with the
length table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.analyzers import WORDS, Analyzer
from termloom.operators.tokens import count_within_rows, distinct_within_rows, text_lengths, tokenize
from termloom.sources.corpus import Corpus

@dataclass(frozen=True)
class Index:
    """``postings(field, term, docid, tf, len)``, ``lengths(field, docid, len)``,
    ``field_stats(field, n_field_docs, total_len, avg_len)``,
    ``corpus_stats(n_docs)``.

    ``entries`` are the postings and, as rows without ``term`` and ``tf``, the
    lengths: what one pass over the texts gives, and what is saved.

    A loaded index has ``shards``: postings then also have the column
    ``shard``, see :func:`termloom.sources.store.shard_of`. It also knows its
    ``fields``. One that was built from texts has their ``text_bytes``, in one row,
    which tell its size without an analysis. ``analyzer`` is the label of the analyzer
    that the terms come from. ``terms`` are the terms of texts, some of them several times,
    without counting them.
    """

    postings: DataFrame
    lengths: DataFrame
    field_stats: DataFrame
    corpus_stats: DataFrame
    entries: DataFrame
    shards: int | None = None
    fields: tuple[str, ...] | None = None
    text_bytes: DataFrame | None = None
    analyzer: str = WORDS.label
    terms: DataFrame | None = None


# --- single aggregations ----------------------------------------------------


def term_frequencies(texts: DataFrame) -> DataFrame:
    """``(field, term, docid, tf)``. Counted within each input split first."""
    return tokenize(texts).groupBy("field", "term", "docid").agg(F.count("*").alias("tf"))


def field_lengths(texts: DataFrame) -> DataFrame:
    """``(field, docid, len)``; a field that is present but empty has 0."""
    return _summed_lengths(text_lengths(texts))


def field_statistics(lengths: DataFrame) -> DataFrame:
    """The mean runs over the documents that have the field."""
    return lengths.groupBy("field").agg(
        F.count("*").alias("n_field_docs"),
        F.sum("len").alias("total_len"),
        F.avg("len").alias("avg_len"),
    )


def corpus_statistics(records: DataFrame) -> DataFrame:
    """All records count, also those without any field."""
    return records.agg(F.count("*").alias("n_docs"))


def vocabulary(postings: DataFrame) -> DataFrame:
    """``(field, term, df, cf)``: documents and occurrences of each term."""
    return postings.groupBy("field", "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf")
    )


# --- build ------------------------------------------------------------------


def build_index(corpus: Corpus, duplicates: str = "merge", analyzer: Analyzer = WORDS) -> Index:
    """The index of a corpus.

    Terms are counted within each row. Where a docid has one row for a field,
    such a count is a posting and nothing is shuffled. ``duplicates="merge"`` adds
    up the counts and lengths of rows with the same docid and field; a corpus of
    rows always does, other corpora only if a job over the docids alone finds
    such rows. ``"error"`` raises if there are any.
    """
    if duplicates not in ("merge", "error"):
        raise ValueError(f"duplicates must be 'merge' or 'error', got {duplicates!r}")
    entries, lengths = count_within_rows(corpus.texts, analyzer), text_lengths(corpus.texts, analyzer)
    entries = entries.select("field", "term", "docid", "tf", "len")
    if duplicates == "error":
        _refuse(corpus.keys)
    elif corpus.many_rows or has_repeats(corpus.keys):
        entries, lengths = add_up(entries, lengths)
    return Index(
        entries.where(F.col("term").isNotNull()),
        lengths,
        field_statistics(lengths),
        corpus_statistics(corpus.records),
        entries,
        text_bytes=corpus.texts.agg(F.sum(F.octet_length("text")).alias("text_bytes")),
        analyzer=analyzer.label,
        terms=distinct_within_rows(corpus.texts, analyzer),
    )


def merge_indexes(a: Index, b: Index, duplicates: str = "merge") -> Index:
    """One index for the records of both, without reading any text again.

    Counts and lengths of a docid that both have are added up, or refused
    with ``duplicates="error"``. Parts without a docid in common pass through as
    they are. Both need the same analyzer.
    """
    if a.analyzer != b.analyzer:
        raise ValueError(f"the indexes have different analyzers, {a.analyzer} and {b.analyzer}")
    lengths = a.lengths.unionByName(b.lengths)
    postings = _plain_postings(a.postings).unionByName(_plain_postings(b.postings))
    entries = _entries(postings, lengths)
    if duplicates == "error":
        _refuse(lengths)
    elif has_repeats(lengths):
        entries, lengths = add_up(entries, lengths)
        postings = entries.where(F.col("term").isNotNull())
    n_docs = a.corpus_stats.select("n_docs").unionByName(b.corpus_stats.select("n_docs"))
    return Index(
        postings,
        lengths,
        field_statistics(lengths),
        n_docs.agg(F.sum("n_docs").alias("n_docs")),
        entries,
        analyzer=a.analyzer,
    )


def _repeats(keys: DataFrame) -> DataFrame:
    """The docids with several rows for one field, of ``keys(docid, field)``."""
    counts = keys.groupBy("field", "docid").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > 1).select("docid")


def has_repeats(keys: DataFrame) -> bool:
    return not _repeats(keys).isEmpty()


def _refuse(keys: DataFrame) -> None:
    some = [row["docid"] for row in _repeats(keys).limit(5).collect()]
    if some:
        raise ValueError(f"docids come more than once, such as {some}")


def add_up(entries: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries and lengths with one row for each docid, field and term.

    Counts are combined within each split, and then shuffled by docid and term: a
    docid with a third of all rows is spread by its terms, and no text is moved.
    """
    summed = _summed_lengths(lengths)
    counts = entries.where(F.col("term").isNotNull())
    counts = counts.groupBy("field", "term", "docid").agg(F.sum("tf").alias("tf"))
    return _entries(_with_length(counts, summed), summed), summed


def _entries(postings: DataFrame, lengths: DataFrame) -> DataFrame:
    return postings.unionByName(lengths, allowMissingColumns=True)


def _with_length(frequencies: DataFrame, lengths: DataFrame) -> DataFrame:
    return frequencies.join(lengths, ["field", "docid"]).select(
        "field", "term", "docid", "tf", "len"
    )


def _summed_lengths(rows: DataFrame) -> DataFrame:
    return rows.groupBy("field", "docid").agg(F.sum("len").alias("len"))


def _plain_postings(postings: DataFrame) -> DataFrame:
    return postings.select("field", "term", "docid", "tf", "len")
