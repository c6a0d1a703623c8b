"""Phrases: terms that follow each other, found by positions in the postings.

A posting with positions lists the places of a term in one *piece* of text, a row of the
corpus. A phrase is found where places, less the slot of their term in the phrase, are
common to all its slots; so repeated terms need no special care, and occurrences may
overlap. A phrase never runs across pieces, whose order is not known.

The rarest term of a phrase is its *anchor*. Only pieces with the anchor are looked at for
the other slots, and postings meet by piece, so a frequent term is never one key.

Once found, a phrase is scored like a term: its frequency is the number of places, its
document frequency that of documents with the phrase in one of the fields searched.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.functions.analyzer import analyzed_terms
from termloom.functions.bm25f import FieldParams, check_length_norm
from termloom.operators.build import Index
from termloom.operators.retrieve import gather_fields, rounded, term_idf, top_k, with_field_scores
from termloom.scratch import written as _kept
from termloom.sources.corpus import Corpus
from termloom.sources.store import shard_of

#: Asked terms that are looked for within each text, at most; of more, all are placed.
MAX_LISTED = 100

POSITIONS_SCHEMA = "term string, docid string, piece bigint, positions array<int>, field string, shard int"


@dataclass(frozen=True)
class Positions:
    """``postings(field, term, docid, piece, positions)``; a saved table has ``shards``,
    one that was built has the ``texts``, of which only the terms asked are placed."""

    postings: DataFrame
    shards: int | None = None
    texts: DataFrame | None = None


# --- build ------------------------------------------------------------------------


def positional_postings(texts: DataFrame, terms: list[str] | None = None) -> DataFrame:
    """``(field, term, docid, piece, positions)`` of ``texts(docid, field, text)``, with
    ``terms`` of these only.

    Built within each row: in the sorted list of (term, place), equal terms lie next to
    each other. Nothing is shuffled.
    """
    analyzed = texts.select(
        "docid", "field", F.monotonically_increasing_id().alias("piece"), analyzed_terms(F.col("text")).alias("term")
    )
    place = F.when(F.size("term") > 0, F.sequence(F.lit(0), F.size("term") - 1))
    placed = analyzed.select("docid", "field", "piece", "term", place.alias("place"))
    pairs = F.arrays_zip("term", "place")
    if terms is not None:
        pairs = F.filter(pairs, lambda pair: pair["term"].isin(terms))
    # Not ``array_sort``, which compares by a lambda.
    sorted_pairs = placed.select("docid", "field", "piece", F.sort_array(pairs).alias("pairs"))
    ordered = sorted_pairs.withColumn("n", F.size("pairs")).where("n > 0")
    pair = F.col("pairs")
    starts = F.filter(
        F.sequence(F.lit(1), F.col("n")),
        lambda i: (i == 1) | (F.get(pair, i - 1)["term"] != F.get(pair, i - 2)["term"]),
    )
    started = ordered.select("docid", "field", "piece", "pairs", "n", starts.alias("starts"))
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.col("n") + 1))
    found = F.zip_with(
        "starts",
        ends,
        lambda low, high: F.struct(
            F.get(pair, low - 1)["term"].alias("term"),
            F.slice(pair, low, high - low)["place"].alias("positions"),
        ),
    )
    # Not ``inline``: the optimizer would move a filter on the array to the scan.
    return started.select("docid", "field", "piece", F.inline_outer(found)).select(
        "field", "term", "docid", "piece", "positions"
    )


def build_positions(corpus: Corpus) -> Positions:
    """The positions of a corpus, for an :class:`Index` of the same corpus."""
    return Positions(positional_postings(corpus.texts), texts=corpus.texts)


def save_positions(positions: Positions, path: str, shards: int) -> None:
    """Write the positions beside a saved index, in folders by field and hash of the term
    and sorted by term. Places ascend, and Parquet's second format stores differences."""
    placed = positions.postings.withColumn("shard", shard_of(F.col("term"), shards))
    (
        placed.hint("rebalance", "field", "shard")
        .sortWithinPartitions("field", "shard", "term", "docid")
        .write.partitionBy("field", "shard")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.bloom.filter.enabled#term", "true")
        .parquet(f"{path}/positions")
    )


def load_positions(spark: SparkSession, path: str, shards: int) -> Positions:
    """``shards`` is that of the index beside which the positions lie."""
    return Positions(spark.read.schema(POSITIONS_SCHEMA).parquet(f"{path}/positions"), shards)


# --- phrases ------------------------------------------------------------------------


def phrases_from_texts(queries: DataFrame, query_id: str, text: str) -> DataFrame:
    """``phrases(query_id, slot, term)`` of texts analysed the way documents are."""
    terms = queries.select(F.col(query_id).alias("query_id"), analyzed_terms(F.col(text)).alias("terms"))
    return terms.select("query_id", F.posexplode_outer("terms").alias("slot", "term")).where("term IS NOT NULL")


def phrase_from_tokens(spark: SparkSession, tokens: Iterable[str]) -> DataFrame:
    """One phrase, its tokens looked up as they are."""
    rows = [(0, slot, term) for slot, term in enumerate(tokens)]
    return spark.createDataFrame(rows, "query_id int, slot int, term string")


def phrase_matches(positions: Positions, phrases: DataFrame, fields: Iterable[str]) -> DataFrame:
    """``(query_id, field, docid, tf)``: where each phrase occurs, and how often.

    ``phrases(query_id, slot, term)`` numbers the slots from 0 without gaps.
    """
    asked = _kept(phrases.select("query_id", "slot", "term"), "phrases")
    postings = _postings_of(positions, asked, fields)
    if positions.shards is None:
        # Else each step would analyse the texts again.
        postings = _kept(postings, "positions")

    counts = postings.groupBy("term").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("query_id").orderBy("n", "slot")
    sized = asked.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sized = sized.withColumn("order", F.row_number().over(rarest))
    sized = sized.withColumn("slots", F.count("*").over(Window.partitionBy("query_id")))
    sized = _kept(sized, "slots")
    anchors = sized.where("order = 1").select("query_id", "slot", "term", "slots")
    others = sized.where("order > 1").select("query_id", "slot", "term", "slots")

    found = _kept(postings.join(anchors, "term").select(*_PLACE, "slots", _begins().alias("begins")), "anchored")
    # The other slots of each piece with the anchor, and their postings: both by piece.
    wanted = found.select(*_PLACE, "slots").join(others.drop("slots"), "query_id")
    pieces = wanted.select("field", "docid", "piece", "term").distinct()
    there = postings.join(pieces, ["field", "docid", "piece", "term"], "left_semi")
    more = wanted.join(there, ["field", "docid", "piece", "term"]).select(*_PLACE, "slots", _begins().alias("begins"))
    together = found.unionByName(more).groupBy(*_PLACE, "slots").agg(F.collect_list("begins").alias("all"))
    # One array for each slot, so as many as the phrase is long.
    first = F.get(F.col("all"), F.lit(0))
    common = F.aggregate(F.slice("all", 2, F.size("all")), first, lambda a, b: F.array_intersect(a, b))
    complete = together.where(F.size("all") == F.col("slots")).select(*_PLACE, F.size(common).cast("bigint").alias("n"))
    return complete.where("n > 0").groupBy("query_id", "field", "docid").agg(F.sum("n").alias("tf"))


def score_phrases(
    index: Index, matches: DataFrame, params: Mapping[str, FieldParams], length_norm: str = "mean"
) -> DataFrame:
    """``(query_id, docid, score)`` of ``matches(query_id, field, docid, tf)``: the formula
    with the phrase as the term."""
    check_length_norm(length_norm)
    with_length = matches.join(index.lengths, ["field", "docid"]).withColumnRenamed("query_id", "term")
    scored = with_field_scores(gather_fields(with_length, params), index.field_stats, params, length_norm)
    total = F.lit(0.0)
    for i in range(len(params)):
        total = total + F.coalesce(F.col(f"score{i}"), F.lit(0.0))
    scored = scored.select("term", "docid", total.alias("saturation"))
    idf = term_idf(index, scored.groupBy("term").agg(F.count_if(F.col("saturation") > 0).alias("df")))
    return scored.join(idf, "term").select(
        F.col("term").alias("query_id"), "docid", (F.col("idf") * F.col("saturation")).alias("score")
    )


def search_phrases(
    index: Index,
    positions: Positions,
    phrases: DataFrame,
    params: Mapping[str, FieldParams],
    k: int,
    length_norm: str = "mean",
    decimals: int | None = None,
) -> DataFrame:
    """``(query_id, docid, score, rank)``: the best ``k`` documents of every phrase."""
    matches = _kept(phrase_matches(positions, phrases, params), "matches")
    return top_k(rounded(score_phrases(index, matches, params, length_norm), decimals), k)


def search_phrase(
    index: Index,
    positions: Positions,
    tokens: Iterable[str],
    params: Mapping[str, FieldParams],
    k: int | None = None,
    length_norm: str = "mean",
    decimals: int | None = None,
) -> DataFrame:
    """``(docid, score)`` of one phrase, best first; all of them or the best ``k``."""
    phrase = phrase_from_tokens(index.postings.sparkSession, tokens)
    matches = _kept(phrase_matches(positions, phrase, params), "matches")
    hits = rounded(score_phrases(index, matches, params, length_norm), decimals)
    ranked = hits.select("docid", "score").orderBy(F.desc("score"), F.asc("docid"))
    return ranked if k is None else ranked.limit(k)


# --- helpers ------------------------------------------------------------------------

_PLACE = ("query_id", "field", "docid", "piece")


def _begins() -> Column:
    """Where the phrase would begin, for each place of the term."""
    slot = F.col("slot")
    return F.transform("positions", lambda place: place - slot)


def _postings_of(positions: Positions, asked: DataFrame, fields: Iterable[str]) -> DataFrame:
    terms = asked.select("term").distinct()
    postings = positions.postings
    if positions.texts is not None:
        few = [row["term"] for row in terms.limit(MAX_LISTED + 1).collect()]
        if len(few) <= MAX_LISTED:
            postings = positional_postings(positions.texts, few)
    postings = postings.where(F.col("field").isin(sorted(fields)))
    if positions.shards is not None:
        hit = asked.select(shard_of(F.col("term"), positions.shards).alias("shard")).distinct()
        # At most one number for each folder.
        postings = postings.where(F.col("shard").isin([row["shard"] for row in hit.collect()]))
    postings = postings.select("field", "term", "docid", "piece", "positions")
    return postings.join(terms, "term", "left_semi")
