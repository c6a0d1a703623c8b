"""Sharding by a two-pass external shuffle.

Pass one scatters the rows uniformly into buckets that fit in memory, by a
seeded hash. Pass two shuffles each bucket (Fisher-Yates, seeded by the bucket)
and deals the rows out like cards: the row at place ``p`` of the whole order
goes to shard ``p mod n`` and there to slot ``p div n``. Shards therefore differ
by one row at most, and slots have no gap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import documents

N_SHARDS = 24
BUCKET_BYTES = 24 << 20
SEED = 20_240
SPREAD = 4096


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniformly random order of ``n`` places."""
    order = list(range(n))
    swap = (rng.random(n) * np.arange(1, n + 1)).astype(np.int64).tolist()
    for i in range(n - 1, 0, -1):
        j = swap[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def shuffle_to_shards(
    df: DataFrame,
    key: str,
    size: Column,
    n_shards: int = N_SHARDS,
    bucket_bytes: int = BUCKET_BYTES,
    seed: int = SEED,
    spread: int = SPREAD,
) -> DataFrame:
    """``(record struct, shard int, slot long)``: every row once, in ``record``.

    ``size`` gives the bytes of a row; the number of buckets is the sum of the
    sizes over ``bucket_bytes``, so a task holds about that much. The hash takes
    ``key`` and the row's place in its input split (modulo ``spread``): rows that
    repeat, a third of all even, spread over the buckets like others. A table
    read from files gives the same order each time. The driver keeps one number
    for each bucket.

    A null key is a key like any other; an empty table gives an empty result.
    Columns of ``df`` may have any names, since they move inside ``record``.
    """
    if n_shards < 1 or bucket_bytes < 1 or spread < 1:
        raise ValueError("n_shards, bucket_bytes and spread must be positive")
    spark = df.sparkSession
    place = F.pmod(F.monotonically_increasing_id(), F.lit(spread))
    rows = df.select(
        F.struct(*[df[name] for name in df.columns]).alias("record"),
        size.cast("bigint").alias("bytes"),
        F.xxhash64(F.lit(seed), F.col(key), place).alias("mixed"),
        F.monotonically_increasing_id().alias("at"),
    )
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    rows = rows.withColumn("bucket", F.pmod("mixed", F.lit(n_buckets)).cast("int"))
    counts = np.zeros(n_buckets, np.int64)
    for row in rows.groupBy("bucket").count().collect():
        counts[row["bucket"]] = row["count"]
    starts = np.cumsum(counts) - counts

    scattered = rows.select("bucket", "mixed", "at", "record").repartitionById(n_buckets, F.col("bucket"))
    # The order of arrival depends on the network; sorting makes it the same each
    # time, also for rows that share a key: no two have the same place.
    ordered = scattered.sortWithinPartitions("bucket", "mixed", "at")
    schema = rows.select("record").schema.add("shard", "integer").add("slot", "long")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, table in _by_bucket(batches):
            n = table.num_rows
            if n != counts[bucket]:
                raise RuntimeError(f"bucket {bucket} has {n} rows, {counts[bucket]} were counted")
            order = fisher_yates(n, np.random.default_rng([seed, bucket]))
            place = starts[bucket] + np.arange(n, dtype=np.int64)
            shuffled = pa.table(
                {
                    "record": table["record"].take(pa.array(order)),
                    "shard": pa.array((place % n_shards).astype(np.int32)),
                    "slot": pa.array(place // n_shards),
                }
            )
            yield from shuffled.to_batches(max_chunksize=4096)

    return ordered.mapInArrow(deal, schema)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The sorted rows of each bucket, one bucket in memory at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        buckets = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if held and held[0].column(0)[0].as_py() != buckets[start]:
                yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder ``shard=...`` for each shard; the rows keep their slot."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, dealt to 24 shards; texts move with their rows."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 8
    sharded = shuffle_to_shards(docs, "doc_id", size)
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return sharded.select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
