"""Frequent n-grams of terms, level by level, and an index of them.

An n-gram occurs at least as seldom as either of the (n-1)-grams within it. So only places
where a frequent (n-1)-gram follows on another one are looked at for level n, and whatever
is frequent is found. A gram is its terms with a space between, which no term contains.

What is frequent is counted by gram alone; only the places of frequent grams are counted by
document. Frequent grams that were measured to be few are broadcast. Single terms are then
counted within the texts, and the grams of two are read off them, so that neither is written
or moved before it is known to be frequent. From there on the places that are left at a level
are a written table. Neighbours meet in stretches of a text, so that a very long one is not
a single key, and the first place of a stretch is also sent to the stretch before. Grams
never run across rows of a corpus, whose order is not known. Where only counts are asked
for, no place is written or moved, see :mod:`termloom.operators.gram_counts`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.analyzers import WORDS, Analyzer
from termloom.operators.build import Index, corpus_statistics, field_statistics, has_repeats
from termloom.operators.gram_counts import count_grams
from termloom.operators.retrieve import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS
from termloom.operators.tokens import count_within_rows, text_lengths, tokenize
from termloom.scratch import written
from termloom.sources.corpus import Corpus

#: Places of a text that are in one group.
STRETCH = 4096


def ngram_postings(
    corpus: Corpus, longest: int, least: int, analyzer: Analyzer = WORDS
) -> DataFrame:
    """``(n, field, term, docid, tf)`` of the grams of up to ``longest`` terms that occur
    ``least`` times or more in a field of the corpus. Overlapping occurrences count."""
    _check(longest, least)
    texts = corpus.texts
    n_frequent, few, frequent = _frequent(tokenize(texts, analyzer), least)
    counts = count_within_rows(texts, analyzer).where(F.col("term").isNotNull())
    counts = counts.select("field", "term", "docid", "tf").join(frequent, ["field", "term"], "left_semi")
    if corpus.many_rows or has_repeats(corpus.keys):
        counts = counts.groupBy("field", "term", "docid").agg(F.sum("tf").alias("tf"))
    levels = [counts.withColumn("n", F.lit(1))]
    places = None
    for n in range(2, longest + 1):
        if not n_frequent:
            break
        if n == 2 and few:
            following = _pairs(texts, analyzer, frequent)
        elif n == 2:
            following = _joined_neighbours(_first_places(texts, analyzer).join(frequent, ["field", "term"], "left_semi"))
        else:
            following = _joined_neighbours(places)
        following = written(following, "places")
        n_frequent, few, frequent = _frequent(following, least)
        places = following.join(frequent, ["field", "term"], "left_semi")
        if n < longest and not few:
            # Or the shuffles of this join would come twice.
            places = written(places, "left")
        counts = places.groupBy("field", "term", "docid").agg(F.count("*").alias("tf"))
        levels.append(counts.withColumn("n", F.lit(n)))
    return reduce(DataFrame.unionByName, levels).select("n", "field", "term", "docid", "tf")


def frequent_ngrams(
    corpus: Corpus, longest: int, least: int, analyzer: Analyzer = WORDS
) -> DataFrame:
    """``(n, field, term, df, cf)``: documents and occurrences of each frequent gram."""
    _check(longest, least)
    return count_grams(corpus, longest, least, analyzer)


def build_ngram_index(
    corpus: Corpus, longest: int, least: int, analyzer: Analyzer = WORDS
) -> Index:
    """An index whose terms are the frequent grams. Lengths are those of the texts, in
    single terms, whatever their frequency. It can be saved, merged and searched like any;
    grams are given as tokens."""
    lengths = text_lengths(corpus.texts, analyzer).groupBy("field", "docid").agg(F.sum("len").alias("len"))
    counts = ngram_postings(corpus, longest, least, analyzer)
    postings = counts.join(lengths, ["field", "docid"]).select("field", "term", "docid", "tf", "len")
    return Index(
        postings,
        lengths,
        field_statistics(lengths),
        corpus_statistics(corpus.records),
        postings.unionByName(lengths, allowMissingColumns=True),
        analyzer=analyzer.label,
    )


def _check(longest: int, least: int) -> None:
    if longest < 1 or least < 1:
        raise ValueError(f"longest and least must be 1 or more, got {longest!r} and {least!r}")


def _first_places(texts: DataFrame, analyzer: Analyzer) -> DataFrame:
    """``(docid, field, piece, place, term)``; a piece is a row of the texts."""
    analyzed = texts.select(
        "docid", "field", F.monotonically_increasing_id().alias("piece"), analyzer.terms(F.col("text")).alias("terms")
    )
    each = F.posexplode_outer("terms").alias("place", "term")
    return analyzed.select("docid", "field", "piece", each).where(F.col("term").isNotNull())


def _joined_neighbours(places: DataFrame) -> DataFrame:
    """The grams one term longer, at the places where one gram follows on another."""
    stretch = F.floor(F.col("place") / STRETCH)
    begins = (F.col("place") % STRETCH == 0) & (F.col("place") > 0)
    groups = F.when(begins, F.array(stretch, stretch - 1)).otherwise(F.array(stretch))
    spread = places.withColumn("stretch", F.explode(groups))
    # A copy in the stretch before is the last there and has nothing after it.
    along = Window.partitionBy("piece", "stretch").orderBy("place")
    following = F.lead(F.struct("place", "term")).over(along)
    paired = spread.withColumn("next", following).where(F.col("next.place") == F.col("place") + 1)
    longer = F.concat("term", F.lit(" "), F.substring_index("next.term", " ", -1))
    return paired.select("docid", "field", "piece", "place", longer.alias("term"))


def _pairs(texts: DataFrame, analyzer: Analyzer, frequent: DataFrame) -> DataFrame:
    """The places of two frequent terms that follow on each other, read off each text."""
    analyzed = texts.select(
        "docid", "field", F.monotonically_increasing_id().alias("piece"), analyzer.terms(F.col("text")).alias("term")
    )
    others = F.slice("term", 2, F.greatest(F.size("term"), F.lit(1)))
    shifted = analyzed.select("docid", "field", "piece", "term", others.alias("other"))
    each = F.posexplode_outer(F.arrays_zip("term", "other")).alias("place", "pair")
    pairs = shifted.select("docid", "field", "piece", each)
    pairs = pairs.select("docid", "field", "piece", "place", "pair.term", "pair.other").where("other IS NOT NULL")
    others = frequent.withColumnRenamed("term", "other")
    pairs = pairs.join(frequent, ["field", "term"], "left_semi").join(others, ["field", "other"], "left_semi")
    return pairs.select("docid", "field", "piece", "place", F.concat("term", F.lit(" "), "other").alias("term"))


def _frequent(places: DataFrame, least: int) -> tuple[int, bool, DataFrame]:
    """How many grams occur ``least`` times or more, whether they may be broadcast, and
    ``(field, term)`` of them, ready to join. Counted within each split first."""
    counts = places.groupBy("field", "term").agg(F.count("*").alias("cf")).where(F.col("cf") >= least)
    frequent = written(counts.select("field", "term"), "frequent")
    n_bytes = F.coalesce(F.sum(F.octet_length("term") + F.octet_length("field")), F.lit(0))
    size = frequent.agg(F.count("*").alias("rows"), n_bytes.alias("bytes")).first()
    few = size["rows"] <= MAX_BROADCAST_ROWS and size["bytes"] <= MAX_BROADCAST_BYTES
    return size["rows"], few, F.broadcast(frequent) if few else frequent
