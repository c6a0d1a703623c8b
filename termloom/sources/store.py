"""The index as Parquet tables: save, load, and where a term is stored.

Entries lie in folders ``field=.../shard=...`` and are sorted by term and
docid within each file. A search for a few terms opens the folders of its
fields and of its terms' shards, and within them the row groups whose range
and Bloom filter admit a term. The lengths have a folder of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.analyzers import WORDS
from termloom.operators.build import Index, field_statistics

ENTRIES_SCHEMA = "term string, docid string, tf bigint, len bigint, field string, shard int"
FIELD_STATS_SCHEMA = "field string, n_field_docs bigint, total_len bigint, avg_len double"
CORPUS_STATS_SCHEMA = "n_docs bigint, shards int, analyzer string"

TOKENS_PER_SHARD = 50_000_000
BYTES_PER_TOKEN = 6
LENGTHS_SHARD = -1


def shard_of(term: Column, shards: int) -> Column:
    """The folder of a term. On a literal it is folded to a literal, so a
    filter built with it prunes folders before any file is listed."""
    return F.pmod(F.xxhash64(term), F.lit(shards)).cast("int")


def save_index(index: Index, path: str, shards: int | None = None) -> None:
    """Write an index; ``path`` must not hold one yet.

    ``shards`` defaults to about one per 50 million tokens. The corpus
    statistics are written last and mark the index as complete.
    """
    spark = index.entries.sparkSession
    if shards is None:
        shards = suggested_shards(index)
    write_entries(index.entries, f"{path}/entries", shards)
    lengths = _lengths(_read_entries(spark, path))
    field_statistics(lengths).coalesce(1).write.parquet(f"{path}/field_stats")
    index.corpus_stats.select(
        "n_docs", F.lit(shards).cast("int").alias("shards"), F.lit(index.analyzer).alias("analyzer")
    ).coalesce(1).write.parquet(f"{path}/corpus_stats")


def suggested_shards(index: Index) -> int:
    """One for each 50 million tokens: by the bytes of the texts, so that they are not
    analysed for it, or else by the lengths of all fields."""
    if index.text_bytes is not None:
        n_bytes = index.text_bytes.first()[0] or 0
        return max(1, n_bytes // (BYTES_PER_TOKEN * TOKENS_PER_SHARD))
    tokens = index.field_stats.agg(F.sum("total_len")).first()[0] or 0
    return max(1, tokens // TOKENS_PER_SHARD)


def write_entries(entries: DataFrame, path: str, shards: int) -> None:
    """One shuffle to the shards. ``rebalance`` lets the adaptive planner cut a
    shard that outgrows the target partition size (a frequent term lies in
    one shard) and join small ones, which a fixed hash could not."""
    shard = F.when(F.col("term").isNull(), LENGTHS_SHARD).otherwise(
        shard_of(F.col("term"), shards)
    )
    placed = entries.select("term", "docid", "tf", "len", "field", shard.alias("shard"))
    (
        placed.hint("rebalance", "field", "shard")
        .sortWithinPartitions("field", "shard", "term", "docid")
        .write.partitionBy("field", "shard")
        .option("parquet.bloom.filter.enabled#term", "true")
        .parquet(path)
    )


def load_index(spark: SparkSession, path: str, fields: list[str] | None = None) -> Index:
    """Open a saved index, for all fields or the given ones.

    The number of documents stays that of the whole corpus. A field that the
    index does not have is an error.
    """
    corpus_stats = spark.read.schema(CORPUS_STATS_SCHEMA).parquet(f"{path}/corpus_stats")
    field_stats = spark.read.schema(FIELD_STATS_SCHEMA).parquet(f"{path}/field_stats")
    entries = _read_entries(spark, path)
    # One small row for each field.
    known = sorted(row["field"] for row in field_stats.select("field").collect())
    if fields is not None:
        unknown = sorted(set(fields) - set(known))
        # An index without any text has no fields to compare with.
        if unknown and known:
            raise ValueError(f"the index has no fields {unknown}, only {known}")
        known = sorted(set(fields) & set(known))
        chosen = F.col("field").isin(list(fields))
        entries, field_stats = entries.where(chosen), field_stats.where(chosen)
    saved = corpus_stats.first()
    return Index(
        postings=entries.where(F.col("shard") != LENGTHS_SHARD),
        lengths=_lengths(entries),
        field_stats=field_stats,
        corpus_stats=corpus_stats.select("n_docs"),
        entries=entries.drop("shard"),
        shards=saved["shards"],
        fields=tuple(known) or None,
        # Indexes from before there was a choice do not say.
        analyzer=saved["analyzer"] or WORDS.label,
    )


def _read_entries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENTRIES_SCHEMA).parquet(f"{path}/entries")


def _lengths(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("shard") == LENGTHS_SHARD).select("field", "docid", "len")
