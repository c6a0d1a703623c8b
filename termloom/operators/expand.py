"""Terms of the vocabulary that are near an asked term, or that match a pattern.

Both are equi-joins of keys, never a comparison of all asked terms with all terms.

*Near*: two terms within an edit distance of ``d`` share a key among the strings that
remain when up to ``d`` of their first ``PREFIX`` characters are left out. (An alignment
with ``d`` edits leaves out at most ``d`` of either prefix to get at what they share.) The
number of keys does not depend on the length of a term; ``levenshtein`` decides.

*Pattern*: ``*`` stands for any characters and ``?`` for one. What a pattern says literally
gives grams that each match must have: three characters, two at an end of the term, or
one. The rarest of them leads to the candidates, a regular expression decides. A pattern
of wildcards only has the empty gram, which all terms have.

What is found is asked in place of the term, so it takes part in any search.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.build import Index
from termloom.operators.retrieve import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, QueryTerms, query_terms
from termloom.scratch import written

#: Characters of a term from which deletions are made.
PREFIX = 8
#: Edits that a search may allow.
MAX_DISTANCE = 2

# The ends of a term. They cannot be part of one.
BEGIN, END = "\x02", "\x03"


def vocabulary_terms(index: Index) -> DataFrame:
    """``(term)``: each term once, whatever its fields. Of an index that is not saved they
    are written once, or each step that reads them would analyse the texts again."""
    terms = index.postings.select("term") if index.terms is None else index.terms
    terms = terms.distinct()
    if index.shards is not None:
        return terms
    return written(terms, "vocabulary")


# --- near terms -----------------------------------------------------------------------


def deletion_keys(term: Column, distance: int) -> Column:
    """The strings left of the first ``PREFIX`` characters with up to ``distance`` left out."""
    # A place beyond the end of a short term leaves out nothing, which gives a key of fewer
    # deletions. Without lambdas, which are slow, over a vocabulary.
    places = range(1, PREFIX + 1)
    keys = [_without(term, left_out) for n in range(distance + 1) for left_out in combinations(places, n)]
    return F.array_distinct(F.array(*keys))


def _without(term: Column, left_out: tuple[int, ...]) -> Column:
    """The first ``PREFIX`` characters but those at the places ``left_out``."""
    stretches = zip((0, *left_out), (*left_out, PREFIX + 1))
    parts = [F.substring(term, start + 1, end - start - 1) for start, end in stretches if end - start > 1]
    return F.concat(*parts)


def deletion_table(terms: DataFrame, distance: int) -> DataFrame:
    """``(key, term)`` for each key of each of ``terms(term)``; may be written and reused."""
    return terms.select(F.explode(deletion_keys(F.col("term"), distance)).alias("key"), "term")


def near_terms(asked: DataFrame, table: DataFrame, distance: int) -> DataFrame:
    """``(asked, term, distance)`` of ``asked(asked)`` and a :func:`deletion_table` made for
    this distance or a larger one."""
    if distance not in range(MAX_DISTANCE + 1):
        raise ValueError(f"distance must lie between 0 and {MAX_DISTANCE}, got {distance!r}")
    keys = _few(asked.select("asked").where("asked IS NOT NULL").distinct())
    keys = keys.select("asked", F.explode(deletion_keys(F.col("asked"), distance)).alias("key"))
    met = table.join(keys, "key").where(F.abs(F.length("asked") - F.length("term")) <= distance)
    # Pairs share several keys; each is compared once.
    pairs = met.select("asked", "term").distinct()
    measured = pairs.withColumn("distance", F.levenshtein("asked", "term", distance))
    return measured.where(F.col("distance") >= 0)


# --- patterns -------------------------------------------------------------------------


def grams(literal: Column) -> Column:
    """What is looked up of a literal stretch, or of a term between its ends."""
    n = F.length(literal)

    def substrings(size: int) -> Column:
        places = F.when(n >= size, F.sequence(F.lit(1), n - size + 1))
        places = F.coalesce(places, F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.substring(literal, i, size))

    at_an_end = F.filter(substrings(2), lambda two: two.startswith(BEGIN) | two.endswith(END))
    single = F.filter(substrings(1), lambda one: (one != BEGIN) & (one != END))
    return F.concat(substrings(3), at_an_end, single)


def gram_table(terms: DataFrame) -> DataFrame:
    """``(gram, term)`` for each gram of each of ``terms(term)``; may be written and reused."""
    marked = F.concat(F.lit(BEGIN), F.col("term"), F.lit(END))
    found = F.array_distinct(F.concat(F.array(F.lit("")), grams(marked)))
    return terms.select(F.explode(found).alias("gram"), "term")


def matching_terms(patterns: DataFrame, table: DataFrame) -> DataFrame:
    """``(pattern, term)`` of ``patterns(pattern)`` and a :func:`gram_table`."""
    asked = patterns.select("pattern").where("pattern IS NOT NULL").distinct()
    marked = F.concat(F.lit(BEGIN), F.col("pattern"), F.lit(END))
    literals = F.split(marked, "[*?]")
    needed = F.array_distinct(F.concat(F.array(F.lit("")), F.flatten(F.transform(literals, grams))))
    needed = written(_few(asked).select("pattern", F.explode(needed).alias("gram")), "grams")

    counts = table.join(needed.select("gram").distinct(), "gram", "left_semi").groupBy("gram")
    counts = counts.agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("pattern").orderBy("n", "gram")
    sized = needed.join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    keys = sized.withColumn("place", F.row_number().over(rarest)).where("place = 1").select("pattern", "gram")
    # Or each step that reads them would make the grams of all terms again.
    keys = written(keys, "keys")
    return table.join(_few(keys), "gram").where(F.rlike("term", _regex(F.col("pattern")))).select("pattern", "term")


def _regex(pattern: Column) -> Column:
    literal = F.replace(pattern, F.lit(r"\E"), F.lit(r"\E\\E\Q"))
    literal = F.replace(F.replace(literal, F.lit("*"), F.lit(r"\E.*\Q")), F.lit("?"), F.lit(r"\E.\Q"))
    return F.concat(F.lit(r"(?s)\A\Q"), literal, F.lit(r"\E\z"))


# --- queries --------------------------------------------------------------------------


def expanded(queries: DataFrame, found: DataFrame, asked: str) -> QueryTerms:
    """The bags of ``queries(query_id, term)``, each term replaced by those found for it.

    ``found`` has the asked term or pattern in the column ``asked``. A term found for
    several asked ones counts for each of them.
    """
    replaced = queries.select("query_id", F.col("term").alias(asked)).join(found.select(asked, "term"), asked)
    # Or each step that reads the queries would look through the vocabulary again.
    return query_terms(written(replaced.select("query_id", "term"), "expanded"))


def fuzzy_terms(index: Index, queries: DataFrame, distance: int = 1, table: DataFrame | None = None) -> QueryTerms:
    """``queries(query_id, term)`` with the terms of the index within an edit distance."""
    if table is None:
        table = deletion_table(vocabulary_terms(index), distance)
    found = near_terms(queries.select(F.col("term").alias("asked")), table, distance)
    return expanded(queries, found, "asked")


def pattern_terms(index: Index, queries: DataFrame, table: DataFrame | None = None) -> QueryTerms:
    """``queries(query_id, term)``, whose terms are patterns, with the terms they match."""
    if table is None:
        table = gram_table(vocabulary_terms(index))
    found = matching_terms(queries.select(F.col("term").alias("pattern")), table)
    return expanded(queries, found, "pattern")


def _few(df: DataFrame) -> DataFrame:
    """Broadcast if counted to be small enough."""
    texts = sum((F.octet_length(name) for name in df.columns), F.lit(16))
    size = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(texts), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if size["rows"] <= MAX_BROADCAST_ROWS and size["bytes"] <= MAX_BROADCAST_BYTES else df
