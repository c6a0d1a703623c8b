"""Ranked retrieval, for one query or a table of queries.

The plan of a search has one shuffle of note: the postings of the query terms,
by docid. After it, everything about a document is in one place, so the fields
of a term are put together, the terms are scored and the queries are summed up
without moving rows again, although a term multiplies with every query that
uses it. A docid has one posting per field and term, so no docid is heavy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.analyzers import WORDS, Analyzer
from termloom.functions.bm25f import (
    FieldParams,
    check_length_norm,
    inverse_document_frequency,
    saturation,
)
from termloom.operators.build import Index
from termloom.operators.tokens import tokenize
from termloom.scratch import written
from termloom.sources.store import shard_of

# A table is broadcast only if it was measured to be within both.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

#: Pairs of a query and a document that one task adds up and ranks, at most.
PAIRS_PER_TASK = 250_000
#: Matches in one file, where they are written.
ROWS_PER_FILE = 250_000


# --- queries ----------------------------------------------------------------


@dataclass(frozen=True)
class QueryTerms:
    """``rows(query_id, term, qtf)``: the bag of terms of each query.

    ``few_rows`` and ``few_terms`` say that the rows, or their distinct terms,
    were measured and may be broadcast. Otherwise they are joined by shuffles.
    ``terms`` lists the distinct terms of a query that was given as a list; they
    become a filter of the scan. Those of a table of queries are joined. ``analyzer`` is
    the label of the analyzer of query texts; tokens that were given have none.
    ``n_queries`` counts the queries.
    """

    rows: DataFrame
    few_rows: bool
    few_terms: bool
    terms: tuple[str, ...] | None = None
    analyzer: str | None = None
    n_queries: int = 1

    def per_row(self, df: DataFrame) -> DataFrame:
        """``df``, with at most one row per row of this table, ready to join."""
        return F.broadcast(df) if self.few_rows else df

    def per_term(self, df: DataFrame) -> DataFrame:
        """``df``, with at most one row per distinct term, ready to join."""
        return F.broadcast(df) if self.few_terms else df


def query_terms(queries: DataFrame, analyzer: Analyzer | None = None) -> QueryTerms:
    """The bags of ``queries(query_id, term)``, where a repeated term counts.

    A row without a term asks for nothing.

    They are measured, to choose the kind of joins.
    """
    asked = queries.where(F.col("term").isNotNull())
    rows = asked.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))
    size = (
        rows.groupBy("term")
        .agg(F.count("*").alias("n"), F.sum(F.octet_length("query_id")).alias("id_bytes"))
        .agg(
            F.count("*").alias("terms"),
            F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("term_bytes"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(
                F.sum(F.col("n") * F.octet_length("term") + F.col("id_bytes")), F.lit(0)
            ).alias("row_bytes"),
        )
        .first()
    )
    few_terms = _may_broadcast(size["terms"], size["term_bytes"])
    few_rows = _may_broadcast(size["rows"], size["row_bytes"])
    n_queries = rows.select("query_id").distinct().count()
    label = analyzer.label if analyzer else None
    return QueryTerms(rows, few_rows, few_terms, analyzer=label, n_queries=n_queries)


def query_terms_from_texts(
    queries: DataFrame, query_id: str, text: str, analyzer: Analyzer = WORDS
) -> QueryTerms:
    """The bags of query texts. The index must have the same analyzer."""
    texts = queries.select(
        F.col(query_id).alias("docid"), F.lit("").alias("field"), F.col(text).alias("text")
    )
    tokens = tokenize(texts, analyzer)
    return query_terms(tokens.select(F.col("docid").alias("query_id"), "term"), analyzer)


def query_terms_from_tokens(index: Index, tokens: Iterable[str]) -> QueryTerms:
    """One query, given as a list of tokens. They are looked up as they are."""
    bag = Counter(tokens)
    n_bytes = sum(len(token.encode()) for token in bag)
    few = _may_broadcast(len(bag), n_bytes)
    rows = index.postings.sparkSession.createDataFrame(
        [(0, term, qtf) for term, qtf in sorted(bag.items())],
        "query_id int, term string, qtf bigint",
    )
    return QueryTerms(rows, few_rows=few, few_terms=few, terms=tuple(sorted(bag)))


def _may_broadcast(rows: int, n_bytes: int) -> bool:
    return rows <= MAX_BROADCAST_ROWS and n_bytes <= MAX_BROADCAST_BYTES


# --- lookup -----------------------------------------------------------------


def lookup(index: Index, query: QueryTerms, fields: Iterable[str]) -> DataFrame:
    """``matches(field, term, docid, tf, len)``: exact matches in the fields.

    A field that an opened index does not have is an error, and so are query texts of
    another analyzer than the index has.
    """
    if query.analyzer not in (None, index.analyzer):
        raise ValueError(f"the index was built with the analyzer {index.analyzer}, not {query.analyzer}")
    unknown = sorted(set(fields) - set(index.fields)) if index.fields is not None else []
    if unknown:
        raise ValueError(f"the index has no fields {unknown}, only {sorted(index.fields)}")
    postings = index.postings.where(F.col("field").isin(sorted(fields)))
    if query.terms is not None:
        postings = postings.where(F.col("term").isin(list(query.terms)))
        if index.shards is not None:
            folders = [shard_of(F.lit(term), index.shards) for term in query.terms]
            postings = postings.where(F.col("shard").isin(folders))
    else:
        if index.shards is not None and query.few_terms:
            postings = postings.where(F.col("shard").isin(_shards_hit(query, index.shards)))
        terms = query.per_term(query.rows.select("term").distinct())
        postings = postings.join(terms, "term", "left_semi")
    return postings.select("field", "term", "docid", "tf", "len")


def _shards_hit(query: QueryTerms, shards: int) -> list[int]:
    """The folders of the query terms, at most ``shards`` numbers."""
    hit = query.rows.select(shard_of(F.col("term"), shards).alias("shard")).distinct()
    return [row["shard"] for row in hit.collect()]


def matches_once(index: Index, query: QueryTerms, fields: Iterable[str]) -> DataFrame:
    """What :func:`lookup` gives, for a search that reads it twice: of an index that is not
    saved it is written, or each use would analyse the texts again."""
    matches = lookup(index, query, fields)
    return matches if index.shards is not None else written(matches, "matches", ROWS_PER_FILE)


# --- scoring ----------------------------------------------------------------


def tasks_by_docid(index: Index, query: QueryTerms) -> int | None:
    """Into how many partitions the documents of a search are dealt.

    A posting multiplies with the queries of its term behind the shuffle, so the bytes
    shuffled do not tell what a task has to hold. The pairs of a query and a document do.
    None where few partitions do, which adaptive execution may then choose.
    """
    n_docs = index.corpus_stats.first()["n_docs"] or 0
    tasks = -(-n_docs * query.n_queries // PAIRS_PER_TASK)
    return tasks if tasks > index.postings.sparkSession.sparkContext.defaultParallelism else None


def dealt_by_docid(matches: DataFrame, tasks: int | None = None) -> DataFrame:
    return matches.repartition(tasks, "docid") if tasks else matches.repartition("docid")


def gather_fields(
    matches: DataFrame, params: Mapping[str, FieldParams], tasks: int | None = None
) -> DataFrame:
    """One row per term and document: ``(term, docid, tf0, len0, tf1, ...)``.

    The numbers follow the sorted field names. A field without a match is
    null. ``tasks`` is the number of partitions, if it must not be chosen by bytes.
    """
    by_docid = dealt_by_docid(matches, tasks)
    names = sorted(params)
    if len(names) == 1:
        return by_docid.select(
            "term", "docid", F.col("tf").alias("tf0"), F.col("len").alias("len0")
        )
    sums = []
    for i, name in enumerate(names):
        is_field = F.col("field") == name
        sums.append(F.sum(F.when(is_field, F.col("tf"))).alias(f"tf{i}"))
        sums.append(F.max(F.when(is_field, F.col("len"))).alias(f"len{i}"))
    return by_docid.groupBy("term", "docid").agg(*sums)


def with_weighted_length(gathered: DataFrame, params: Mapping[str, FieldParams]) -> DataFrame:
    """Adds ``weighted_len``, over the fields in which the term occurs."""
    total = F.lit(0.0)
    for i, name in enumerate(sorted(params)):
        total = total + F.coalesce(F.lit(params[name].weight) * F.col(f"len{i}"), F.lit(0.0))
    return gathered.withColumn("weighted_len", total)


def with_field_scores(
    gathered: DataFrame,
    field_stats: DataFrame,
    params: Mapping[str, FieldParams],
    length_norm: str = "mean",
) -> DataFrame:
    """Adds ``score0, score1, ...``, null where the field has no match."""
    check_length_norm(length_norm)
    names = sorted(params)
    # At most one row per field. A scalar subquery runs once.
    means = (
        field_stats.where(F.col("field").isin(names))
        .agg(F.map_from_entries(F.collect_list(F.struct("field", "avg_len"))).alias("means"))
        .scalar()
    )
    scored = with_weighted_length(gathered, params)
    for i, name in enumerate(names):
        tf = F.col(f"tf{i}")
        mean_len = F.try_element_at(means, F.lit(name))
        score = saturation(tf, F.col("weighted_len"), mean_len, params[name], length_norm)
        scored = scored.withColumn(f"score{i}", F.when(tf.isNotNull(), score))
    return scored


def term_saturation(
    index: Index,
    query: QueryTerms,
    params: Mapping[str, FieldParams],
    length_norm: str = "mean",
) -> DataFrame:
    """``(term, docid, saturation)``: the field scores added up."""
    gathered = gather_fields(matches_once(index, query, params), params, tasks_by_docid(index, query))
    scored = with_field_scores(gathered, index.field_stats, params, length_norm)
    total = F.lit(0.0)
    for i in range(len(params)):
        total = total + F.coalesce(F.col(f"score{i}"), F.lit(0.0))
    return scored.select("term", "docid", total.alias("saturation"))


def document_frequency(gathered: DataFrame) -> DataFrame:
    """``(term, df)`` of rows ``(term, docid, ...)``: documents, not postings."""
    return gathered.groupBy("term").agg(F.count("*").alias("df"))


def term_idf(index: Index, frequencies: DataFrame) -> DataFrame:
    """``(term, df, idf)``."""
    n_docs = index.corpus_stats.select("n_docs").scalar()
    return frequencies.select(
        "term", "df", inverse_document_frequency(n_docs, F.col("df")).alias("idf")
    )


def score_batch(
    index: Index,
    query: QueryTerms,
    params: Mapping[str, FieldParams],
    length_norm: str = "mean",
) -> DataFrame:
    """``hits(query_id, docid, score)`` of every query and matching document."""
    if not params:
        raise ValueError("name at least one field")
    check_length_norm(length_norm)
    saturations = term_saturation(index, query, params, length_norm)
    # Every match has a positive saturation. Counting by it, not just rows, has
    # this branch use the same columns as the other, so both share one shuffle.
    frequencies = saturations.groupBy("term").agg(
        F.count_if(F.col("saturation") > 0).alias("df")
    )
    idf = term_idf(index, frequencies)
    weights = query.rows.join(query.per_term(idf), "term").select(
        "query_id", "term", (F.col("qtf") * F.col("idf")).alias("term_weight")
    )
    return (
        saturations.join(query.per_row(weights), "term")
        .groupBy("query_id", "docid")
        .agg(F.sum(F.col("term_weight") * F.col("saturation")).alias("score"))
    )


# --- ranking ----------------------------------------------------------------


def rank_all(hits: DataFrame) -> DataFrame:
    """All hits, best first within each query, ties by docid.

    A distributed sort: a query with very many hits spreads over tasks.
    """
    return hits.orderBy("query_id", F.desc("score"), F.asc("docid"))


def top_k(hits: DataFrame, k: int) -> DataFrame:
    """``(query_id, docid, score, rank)`` with ``rank <= k``.

    Each task keeps its own best ``k`` of a query before rows move.
    """
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("docid"))
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search_batch(
    index: Index,
    query: QueryTerms,
    params: Mapping[str, FieldParams],
    k: int,
    length_norm: str = "mean",
    decimals: int | None = None,
) -> DataFrame:
    """The best ``k`` documents of every query.

    ``decimals`` rounds the scores before the ranking. The sum of a score
    depends on its order in the last digits, so without it equal documents may
    rank differently from run to run.
    """
    hits = rounded(score_batch(index, query, params, length_norm), decimals)
    return top_k(hits, k)


def score_term(
    index: Index, token: str, params: Mapping[str, FieldParams], length_norm: str = "mean"
) -> DataFrame:
    """``(docid, score)`` of a single token, in no order."""
    query = query_terms_from_tokens(index, [token])
    return score_batch(index, query, params, length_norm).select("docid", "score")


def search(
    index: Index,
    tokens: Iterable[str],
    params: Mapping[str, FieldParams],
    k: int | None = None,
    length_norm: str = "mean",
    decimals: int | None = None,
) -> DataFrame:
    """``(docid, score)`` of one query, best first; all of them or the best ``k``.

    Tokens are looked up exactly as given, and a repeated token counts each
    time.
    """
    query = query_terms_from_tokens(index, tokens)
    hits = rounded(score_batch(index, query, params, length_norm), decimals)
    ranked = hits.select("docid", "score").orderBy(F.desc("score"), F.asc("docid"))
    return ranked if k is None else ranked.limit(k)


def search_text(
    index: Index,
    text: str,
    params: Mapping[str, FieldParams],
    analyzer: Analyzer = WORDS,
    **options: object,
) -> DataFrame:
    """:func:`search` for a query text. The index must have the same analyzer."""
    if analyzer.label != index.analyzer:
        raise ValueError(f"the index was built with the analyzer {index.analyzer}, not {analyzer.label}")
    one_row = index.postings.sparkSession.range(1)
    tokens = one_row.select(analyzer.terms(F.lit(text)).alias("terms")).first()["terms"]
    return search(index, tokens, params, **options)


def rounded(hits: DataFrame, decimals: int | None) -> DataFrame:
    if decimals is None:
        return hits
    return hits.withColumn("score", F.round("score", decimals))
