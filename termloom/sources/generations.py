"""An index that grows by parts, without rewriting what it holds.

``append_index`` adds a part: ``entries/part=.../field=.../shard=...`` and the part's
``field_stats/part=...``. A row in the table ``parts`` makes it visible, so that a part
whose writing failed is never read. ``compact_index`` puts parts together to a new one
and, in one commit, adds it and takes the old ones away. Their files stay for searches
that opened the index before; nothing else reads them.

Records that share a docid, within or across parts, count as in ``merge_indexes``: counts
and lengths add up, each part's records count in ``N``. An append looks up its docids in
the lengths of the parts before it and notes if there is any in common. Only then does
reading add up; parts without such docids are read as they lie, and their statistics are
sums of a few rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.analyzers import WORDS
from termloom.operators.build import Index, add_up, field_statistics
from termloom.sources.store import (
    ENTRIES_SCHEMA,
    FIELD_STATS_SCHEMA,
    LENGTHS_SHARD,
    suggested_shards,
    write_entries,
)

PARTS_SCHEMA = "part string, n_docs bigint, shards int, shares_docids boolean, analyzer string, removed boolean"
KEPT_COLUMNS = ("part", "n_docs", "shards", "shares_docids", "analyzer")
DUPLICATES = ("merge", "error", "none")


def index_parts(spark: SparkSession, path: str) -> list[dict]:
    """The visible parts, one small row for each, by name."""
    rows = [row.asDict() for row in spark.read.schema(PARTS_SCHEMA).parquet(f"{path}/parts").collect()]
    removed = {row["part"] for row in rows if row["removed"]}
    return sorted((row for row in rows if row["part"] not in removed), key=lambda row: row["part"])


def append_index(
    index: Index, path: str, shards: int | None = None, first: bool = False, duplicates: str = "merge"
) -> str:
    """Add an index as a part, and return the part's name.

    ``first`` says that ``path`` holds no parts yet. Later parts take the number of shards
    of those before. ``duplicates="error"`` refuses docids that the index has already;
    ``"none"`` states that there are none, which spares looking them up. Several appends
    may run at a time if their docids differ.
    """
    if duplicates not in DUPLICATES:
        raise ValueError(f"duplicates must be one of {DUPLICATES}, got {duplicates!r}")
    spark = index.entries.sparkSession
    before = [] if first else index_parts(spark, path)
    if shards is None:
        shards = before[0]["shards"] if before else suggested_shards(index)
    different = {row["analyzer"] for row in before} - {index.analyzer}
    if different:
        raise ValueError(f"the index was built with the analyzer {different.pop()}, not {index.analyzer}")
    name = _write_part(index, path, shards)
    shares = False
    if before and duplicates != "none":
        new = _lengths(_entries(spark, path, [name])).select("docid")
        old = _lengths(_entries(spark, path, [row["part"] for row in before])).select("docid")
        # The docids of a small part are what may be broadcast, as Spark sees their size.
        some = [row["docid"] for row in old.join(new, "docid", "left_semi").limit(5).collect()]
        if some and duplicates == "error":
            raise ValueError(f"the index has docids of the new part already, such as {some}")
        shares = bool(some)
    n_docs = index.corpus_stats.first()["n_docs"]
    _commit(spark, path, [(name, n_docs, shards, shares, index.analyzer, False)])
    return name


def load_parts(spark: SparkSession, path: str, fields: list[str] | None = None) -> Index:
    """Open all visible parts as one index, for all fields or the given ones."""
    parts = index_parts(spark, path)
    return _opened(spark, path, parts, fields)


def compact_index(spark: SparkSession, path: str, shards: int | None = None) -> str:
    """Put the visible parts together to one, and return its name.

    Parts appended meanwhile stay as they are. Only one compaction may run at a time.
    """
    parts = index_parts(spark, path)
    index = _opened(spark, path, parts, None)
    shards = shards if shards is not None else suggested_shards(index)
    name = _write_part(index, path, shards)
    n_docs = sum(row["n_docs"] for row in parts)
    gone = [(*(row[column] for column in KEPT_COLUMNS), True) for row in parts]
    # Later parts that share docids with these bear the mark themselves.
    _commit(spark, path, [(name, n_docs, shards, False, index.analyzer, False), *gone])
    return name


# --- helpers ------------------------------------------------------------------


def _write_part(index: Index, path: str, shards: int) -> str:
    spark = index.entries.sparkSession
    name = uuid.uuid4().hex
    write_entries(index.entries, f"{path}/entries/part={name}", shards)
    stats = field_statistics(_lengths(_entries(spark, path, [name])))
    stats.coalesce(1).write.parquet(f"{path}/field_stats/part={name}")
    return name


def _commit(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """All rows in one file, which appears whole or not at all."""
    spark.createDataFrame(rows, PARTS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/parts")


def _entries(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    table = spark.read.schema(f"{ENTRIES_SCHEMA}, part string").parquet(f"{path}/entries")
    return table.where(F.col("part").isin(names)).drop("part")


def _lengths(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("shard") == LENGTHS_SHARD).select("field", "docid", "len")


def _opened(spark: SparkSession, path: str, parts: list[dict], fields: list[str] | None) -> Index:
    names = [row["part"] for row in parts]
    entries = _entries(spark, path, names)
    part_stats = spark.read.schema(f"{FIELD_STATS_SCHEMA}, part string").parquet(f"{path}/field_stats")
    part_stats = part_stats.where(F.col("part").isin(names))
    known = sorted(row["field"] for row in part_stats.select("field").distinct().collect())
    if fields is not None:
        unknown = sorted(set(fields) - set(known))
        if unknown and known:
            raise ValueError(f"the index has no fields {unknown}, only {known}")
        known = sorted(set(fields) & set(known))
        chosen = F.col("field").isin(list(fields))
        entries, part_stats = entries.where(chosen), part_stats.where(chosen)
    lengths = _lengths(entries)
    numbers = {row["shards"] for row in parts}
    shards = numbers.pop() if len(numbers) == 1 else None
    if any(row["shares_docids"] for row in parts):
        entries, lengths = add_up(entries.drop("shard"), lengths)
        postings = entries.where(F.col("term").isNotNull())
        field_stats = field_statistics(lengths)
        shards = None
    else:
        postings = entries.where(F.col("shard") != LENGTHS_SHARD)
        entries = entries.drop("shard")
        total = F.sum("total_len")
        field_stats = part_stats.groupBy("field").agg(
            F.sum("n_field_docs").alias("n_field_docs"),
            total.alias("total_len"),
            (total / F.sum("n_field_docs")).alias("avg_len"),
        )
    n_docs = sum(row["n_docs"] for row in parts)
    return Index(
        postings=postings,
        lengths=lengths,
        field_stats=field_stats,
        corpus_stats=spark.range(1).select(F.lit(n_docs).cast("bigint").alias("n_docs")),
        entries=entries,
        shards=shards,
        fields=tuple(known) or None,
        analyzer=parts[0]["analyzer"] if parts else WORDS.label,
    )
