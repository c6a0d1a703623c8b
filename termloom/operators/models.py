"""Ranking by other models than the one of :mod:`termloom.functions.bm25f`.

Both see a document as one bag, in which an occurrence in a field counts with the field's
weight ``w_f``. With ``x = sum_f w_f * tf_f`` of a term, ``d = sum_f w_f * len_f`` over **all**
searched fields of the document, ``N`` documents, ``C = sum_f w_f * total_len_f`` and, for a
term, its documents ``df`` and ``cf``, the sum of its ``x``:

- :class:`TextbookBM25F`: ``ln(1 + (N - df + 0.5) / (df + 0.5)) * x * (k1 + 1) /
  (x + k1 * (1 - b + b * d / (C / N)))``.
- :class:`DirichletLikelihood`: the log-probability of the query under the document's
  distribution smoothed with ``mu`` weighted tokens of the corpus, less what it is for an
  empty document: ``sum_t ln(1 + x * C / (mu * cf)) + |q| * ln(mu / (mu + d))``. ``|q|`` counts
  the tokens of the query that the corpus has.

Documents that match a term are ranked. As in the search by the default model, the
matches are shuffled once, by docid; the lengths of the documents meet them there.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.build import Index
from termloom.operators.retrieve import (
    QueryTerms,
    dealt_by_docid,
    matches_once,
    rounded,
    tasks_by_docid,
    top_k,
)


class Model(Protocol):
    """What a document's score is made of: a value for each term that it has, times the
    occurrences in the query, and a value for its length.

    The columns are ``tf`` (x above), ``doc_len`` (d), ``df``, ``cf``; ``n_docs`` (N),
    ``total_len`` (C); ``query_len`` (\\|q\\|).
    """

    def term_value(
        self, tf: Column, doc_len: Column, df: Column, cf: Column, n_docs: Column, total_len: Column
    ) -> Column: ...

    def document_value(self, doc_len: Column, query_len: Column) -> Column: ...


@dataclass(frozen=True)
class TextbookBM25F:
    k1: float = 1.2
    b: float = 0.75

    def __post_init__(self) -> None:
        _check_positive("k1", self.k1)
        if not 0.0 <= self.b <= 1.0:
            raise ValueError(f"b must lie between 0 and 1, got {self.b!r}")

    def term_value(self, tf, doc_len, df, cf, n_docs, total_len):
        idf = F.log1p((n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))
        relative_len = doc_len * n_docs / total_len
        norm = F.lit(self.k1) * (F.lit(1.0 - self.b) + F.lit(self.b) * relative_len)
        return idf * tf * F.lit(self.k1 + 1.0) / (tf + norm)

    def document_value(self, doc_len, query_len):
        return F.lit(0.0)


@dataclass(frozen=True)
class DirichletLikelihood:
    mu: float = 2000.0

    def __post_init__(self) -> None:
        _check_positive("mu", self.mu)

    def term_value(self, tf, doc_len, df, cf, n_docs, total_len):
        return F.log1p(tf * total_len / (F.lit(self.mu) * cf))

    def document_value(self, doc_len, query_len):
        return query_len * F.log(F.lit(self.mu) / (F.lit(self.mu) + doc_len))


def score_by_model(
    index: Index, query: QueryTerms, weights: Mapping[str, float], model: Model
) -> DataFrame:
    """``hits(query_id, docid, score)`` of every query and matching document, over the
    fields of ``weights``."""
    if not weights:
        raise ValueError("name at least one field")
    for name, weight in weights.items():
        _check_positive(f"the weight of {name}", weight)
    weight = _weight_of_field(weights)
    matches = dealt_by_docid(matches_once(index, query, weights), tasks_by_docid(index, query))
    # Both uses of the bags need all their columns, so they share one shuffle.
    bags = matches.groupBy("term", "docid").agg(
        F.sum(weight * F.col("tf")).alias("tf"), F.max("len").alias("len")
    )
    statistics = bags.groupBy("term").agg(
        F.count_if(F.col("len") > 0).alias("df"), F.sum("tf").alias("cf")
    )
    known = query.rows.join(query.per_term(statistics), "term")
    whole_query = Window.partitionBy("query_id")
    asked = known.withColumn("query_len", F.sum("qtf").over(whole_query))

    n_docs = index.corpus_stats.select(F.col("n_docs").cast("double")).scalar()
    total_len = (
        index.field_stats.where(F.col("field").isin(sorted(weights)))
        .agg(F.sum(weight * F.col("total_len")).alias("total_len"))
        .scalar()
    )
    value = model.term_value(
        F.col("tf"), F.col("doc_len"), F.col("df").cast("double"), F.col("cf"), n_docs, total_len
    )
    hits = (
        _with_document_length(bags, index, weights)
        .join(query.per_row(asked), "term")
        .groupBy("query_id", "docid")
        .agg(
            F.sum(F.col("qtf") * value).alias("terms"),
            F.first("doc_len").alias("doc_len"),
            F.first("query_len").alias("query_len"),
        )
    )
    score = F.col("terms") + model.document_value(F.col("doc_len"), F.col("query_len"))
    return hits.select("query_id", "docid", score.alias("score"))


def search_by_model(
    index: Index,
    query: QueryTerms,
    weights: Mapping[str, float],
    model: Model,
    k: int,
    decimals: int | None = None,
) -> DataFrame:
    """The best ``k`` documents of every query, ties by docid."""
    return top_k(rounded(score_by_model(index, query, weights, model), decimals), k)


def document_lengths(index: Index, weights: Mapping[str, float]) -> DataFrame:
    """``(docid, doc_len)``, weighted, over all fields of ``weights``."""
    lengths = index.lengths.where(F.col("field").isin(sorted(weights)))
    return lengths.groupBy("docid").agg(
        F.sum(_weight_of_field(weights) * F.col("len")).alias("doc_len")
    )


def _with_document_length(bags: DataFrame, index: Index, weights: Mapping[str, float]) -> DataFrame:
    if len(weights) == 1:
        # A posting knows the length of its field, here the only one.
        return bags.select("term", "docid", "tf", (_weight_of_field(weights, only=True) * F.col("len")).alias("doc_len"))
    return bags.select("term", "docid", "tf").join(document_lengths(index, weights), "docid")


def _weight_of_field(weights: Mapping[str, float], only: bool = False) -> Column:
    if only:
        return F.lit(float(next(iter(weights.values()))))
    value = F.lit(None).cast("double")
    for name, weight in sorted(weights.items()):
        value = F.when(F.col("field") == name, F.lit(float(weight))).otherwise(value)
    return value


def _check_positive(name: str, value: float) -> None:
    if not (math.isfinite(value) and value > 0):
        raise ValueError(f"{name} must be a positive number, got {value!r}")
