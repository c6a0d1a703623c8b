"""The best documents of many queries without scoring every match.

Rare terms weigh most, so a few of them give every query a score that its best ``k``
documents reach at least. With it, most of the rest need not be looked at:

1. *Threshold.* Each query's rarest terms, until they have ``LEAD`` times ``k``
   documents, are scored. Scores only grow with more terms, so the k-th best sum is a
   lower bound of the k-th best score.
2. *Blocks.* For every query and block of documents the bounds of its terms are added
   up, smallest first. While the sum is below the threshold, a document with these terms
   only cannot be among the best: they are *optional* in that block. A block where all
   terms are optional is passed over.
3. *Candidates.* The other terms are scored in the blocks left. A document stays if its
   sum and the bounds of the optional terms reach the threshold, which the new sums have
   raised in the meantime.
4. *Completion.* Only for the documents that stay are optional terms looked up.

The result has the rows that scoring everything gives. All steps move postings of terms
and documents, or of terms and blocks; a frequent term is nowhere one key. What is
broadcast is counted first, as in :mod:`termloom.operators.retrieve`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from termloom.functions.bm25f import FieldParams, check_length_norm
from termloom.operators.bounds import Bounds, block_of, saturation_bounds, term_frequency_in
from termloom.operators.build import Index
from termloom.operators.retrieve import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    QueryTerms,
    gather_fields,
    lookup,
    rounded,
    term_idf,
    top_k,
    with_field_scores,
)
from termloom.scratch import scratch_path

#: The threshold comes from at least so many times ``k`` documents.
LEAD = 4
#: Sums of the same numbers differ by less than this share, whatever their order.
SUM_ERROR = 1e-9


def search_batch_bounded(
    index: Index,
    bounds: Bounds,
    query: QueryTerms,
    params: Mapping[str, FieldParams],
    k: int,
    length_norm: str = "mean",
    decimals: int | None = None,
) -> DataFrame:
    """``(query_id, docid, score, rank)``: what ``search_batch`` gives, by bounds.

    ``decimals`` rounds scores before the ranking. Scores that differ by less than that
    may tie, so thresholds are lowered by it.
    """
    if k < 1:
        raise ValueError(f"k must be positive, got {k}")
    if not params:
        raise ValueError("name at least one field")
    check_length_norm(length_norm)
    allowed = 0.0 if decimals is None else 10.0**-decimals
    weights, size = _kept(weighted_terms(index, bounds, query, params), "weights")
    few_weights = _may_broadcast(*size)
    thresholds = lead_thresholds(index, query, weights, params, k, length_norm)
    thresholds = thresholds.select("query_id", _lowered("threshold", allowed).alias("least"))

    # Rows of the steps from here on are bounded by those of the table written before.
    terms = _ready(weights.select("term").distinct(), few_weights)
    limits = saturation_bounds(bounds, index.field_stats, params, length_norm, terms)
    plan = block_plan(weights, limits, _ready(thresholds, few_weights), few_weights)
    plan, size = _kept(plan, "plan")
    few_plan = _may_broadcast(*size)
    partial = score_pairs(index, bounds, plan.where("needed"), params, length_norm, few_plan)
    rest = plan.select("query_id", "block", "least", "rest").distinct()
    partial, _ = _kept(partial.join(_ready(rest, few_plan), ["query_id", "block"]), "partial")

    # The k-th best sum so far may be above the threshold.
    reached = _kth_best(partial, k).select("query_id", _lowered("threshold", allowed).alias("reached"))
    least = F.greatest("least", F.coalesce("reached", "least"))
    candidates = partial.join(_ready(reached, few_weights), "query_id", "left").where(F.col("score") + F.col("rest") >= least)
    optional = plan.where(~F.col("needed")).select("query_id", "block", "term", "weight")
    wanted = candidates.select("query_id", "docid", "block", "score").join(
        _ready(optional, few_plan), ["query_id", "block"], "left"
    )
    wanted, size = _kept(wanted.select("query_id", "docid", "score", "term", "weight"), "wanted")
    return top_k(rounded(completed(index, wanted, params, length_norm, _may_broadcast(*size)), decimals), k)


# --- steps ----------------------------------------------------------------------


def weighted_terms(
    index: Index, bounds: Bounds, query: QueryTerms, params: Mapping[str, FieldParams]
) -> DataFrame:
    """``(query_id, term, weight, before)`` of the terms that some document has.

    ``before`` adds up the documents of the rarer terms of the query.
    """
    terms = query.per_term(query.rows.select("term").distinct())
    frequencies = term_frequency_in(bounds, params).join(terms, "term", "left_semi")
    idf = query.per_term(term_idf(index, frequencies))
    rarer = Window.partitionBy("query_id").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    return query.rows.join(idf, "term").select(
        "query_id",
        "term",
        (F.col("qtf") * F.col("idf")).alias("weight"),
        F.coalesce(F.sum("df").over(rarer), F.lit(0)).alias("before"),
    )


def lead_thresholds(
    index: Index,
    query: QueryTerms,
    weights: DataFrame,
    params: Mapping[str, FieldParams],
    k: int,
    length_norm: str,
) -> DataFrame:
    """``(query_id, threshold)``; 0 where the rarest terms have too few documents."""
    lead = weights.where(F.col("before") < LEAD * k).select("query_id", "term", "weight")
    asked = QueryTerms(lead, query.few_rows, query.few_terms)
    scored = _saturations(index, lookup(index, asked, params), params, length_norm)
    hits = scored.join(query.per_row(lead), "term").groupBy("query_id", "docid")
    hits = hits.agg(F.sum(F.col("weight") * F.col("saturation")).alias("score"))
    reached = _kth_best(hits, k)
    everyone = weights.select("query_id").distinct()
    return everyone.join(reached, "query_id", "left").select(
        "query_id", F.coalesce("threshold", F.lit(0.0)).alias("threshold")
    )


def block_plan(weights: DataFrame, limits: DataFrame, thresholds: DataFrame, few: bool) -> DataFrame:
    """``(query_id, block, term, weight, needed, rest, least)`` of the blocks not passed over.

    ``rest`` is what the optional terms of the block can add at most.
    """
    most = F.col("weight") * F.col("bound")
    rows = limits.join(_ready(weights, few), "term").select("query_id", "block", "term", "weight", most.alias("most"))
    rows = rows.join(thresholds, "query_id")
    smallest_first = Window.partitionBy("query_id", "block").orderBy("most", "term")
    so_far = F.sum("most").over(smallest_first.rowsBetween(Window.unboundedPreceding, 0))
    judged = rows.withColumn("so_far", so_far).withColumn("needed", F.col("so_far") >= F.col("least"))
    block = Window.partitionBy("query_id", "block")
    judged = judged.withColumn("rest", F.sum(F.when(~F.col("needed"), F.col("most")).otherwise(0.0)).over(block))
    judged = judged.withColumn("live", F.max("needed").over(block)).where("live")
    return judged.select("query_id", "block", "term", "weight", "needed", "rest", "least")


def score_pairs(
    index: Index,
    bounds: Bounds,
    needed: DataFrame,
    params: Mapping[str, FieldParams],
    length_norm: str,
    few: bool,
) -> DataFrame:
    """``(query_id, docid, block, score)`` over the terms needed in each block. ``few``
    says that the rows of ``needed`` may be broadcast."""
    pairs = _ready(needed.select("term", "block").distinct(), few)
    # Few of the postings have one of these terms; only their docids are hashed.
    postings = _postings(index, params).join(_ready(needed.select("term").distinct(), few), "term", "left_semi")
    postings = postings.withColumn("block", block_of(F.col("docid"), bounds.n_blocks))
    matches = postings.join(pairs, ["term", "block"], "left_semi")
    scored = _saturations(index, matches, params, length_norm)
    scored = scored.withColumn("block", block_of(F.col("docid"), bounds.n_blocks))
    asked = _ready(needed.select("query_id", "term", "block", "weight"), few)
    hits = scored.join(asked, ["term", "block"]).groupBy("query_id", "docid", "block")
    return hits.agg(F.sum(F.col("weight") * F.col("saturation")).alias("score"))


def completed(
    index: Index, wanted: DataFrame, params: Mapping[str, FieldParams], length_norm: str, few: bool
) -> DataFrame:
    """``(query_id, docid, score)`` of ``wanted(query_id, docid, score, term, weight)``: the
    score so far, and the optional terms that the document has. A document without
    optional terms has one row, without a term."""
    optional = wanted.where(F.col("term").isNotNull())
    pairs = _ready(optional.select("term", "docid").distinct(), few)
    # Few of the postings are of these documents.
    postings = _postings(index, params).join(_ready(optional.select("docid").distinct(), few), "docid", "left_semi")
    matches = postings.join(pairs, ["term", "docid"], "left_semi")
    scored = _saturations(index, matches, params, length_norm)
    more = F.coalesce(F.col("weight") * F.col("saturation"), F.lit(0.0))
    found = wanted.join(scored, ["term", "docid"], "left").groupBy("query_id", "docid")
    return found.agg((F.max("score") + F.sum(more)).alias("score"))


def matched_rows(index: Index, bounds: Bounds, needed: DataFrame, fields: Mapping[str, FieldParams]) -> DataFrame:
    """How many pairs of a query and a posting the ``needed`` rows of a plan match."""
    postings = _postings(index, fields).withColumn("block", block_of(F.col("docid"), bounds.n_blocks))
    found = postings.groupBy("term", "block").agg(F.count("*").alias("n"))
    return needed.join(found, ["term", "block"]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


# --- helpers --------------------------------------------------------------------


def _postings(index: Index, params: Mapping[str, FieldParams]) -> DataFrame:
    postings = index.postings.where(F.col("field").isin(sorted(params)))
    return postings.select("field", "term", "docid", "tf", "len")


def _saturations(
    index: Index, matches: DataFrame, params: Mapping[str, FieldParams], length_norm: str
) -> DataFrame:
    """``(term, docid, saturation)`` of the postings given, which must have all fields of
    a term in a document."""
    matches = matches.select("field", "term", "docid", "tf", "len")
    scored = with_field_scores(gather_fields(matches, params), index.field_stats, params, length_norm)
    total = F.lit(0.0)
    for i in range(len(params)):
        total = total + F.coalesce(F.col(f"score{i}"), F.lit(0.0))
    return scored.select("term", "docid", total.alias("saturation"))


def _kth_best(hits: DataFrame, k: int) -> DataFrame:
    """``(query_id, threshold)`` of the queries with ``k`` hits. Each task keeps its own
    best ``k`` before rows move."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    ranked = hits.select("query_id", "score").withColumn("place", F.row_number().over(best))
    ranked = ranked.where(F.col("place") <= k).groupBy("query_id")
    return ranked.agg(F.count("*").alias("n"), F.min("score").alias("threshold")).where(F.col("n") == k)


def _lowered(threshold: str, allowed: float) -> Column:
    """What a score must reach: sums differ a little by their order, and scores that
    differ by ``allowed`` may tie."""
    return F.col(threshold) * (1.0 - SUM_ERROR) - allowed


def _kept(df: DataFrame, label: str) -> tuple[DataFrame, tuple[int, int]]:
    """Written once for the steps that read it, with its rows and their bytes."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    texts = [F.octet_length(F.col(name)) for name, kind in df.dtypes if kind == "string"]
    n_bytes = F.coalesce(F.sum(sum(texts, F.lit(8 * len(df.columns)))), F.lit(0))
    size = Observation()
    df.observe(size, F.count("*").alias("rows"), n_bytes.alias("bytes")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), (size.get["rows"], size.get["bytes"])


def _may_broadcast(rows: int, n_bytes: int) -> bool:
    return rows <= MAX_BROADCAST_ROWS and n_bytes <= MAX_BROADCAST_BYTES


def _ready(df: DataFrame, few: bool) -> DataFrame:
    """Ready to join: broadcast if counted to be small enough."""
    return F.broadcast(df) if few else df
