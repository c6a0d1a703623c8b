"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_folder() -> str:
    """One folder for this process, for local sessions without a shared folder."""
    return tempfile.mkdtemp(prefix="termloom-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a table that several jobs read.

    It lies in the shared folder of ``spark.checkpoint.dir``, or of the context's
    checkpoint directory. Where neither is set, only a session within one process
    can go on, with a folder of that process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        set_by_code = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = set_by_code.get() if set_by_code.isDefined() else None
    if not root and not spark.sparkContext._jsc.sc().isLocal():
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{(root or _local_folder()).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, rows_per_file: int = 0) -> DataFrame:
    """Written once for the steps that read it. Small rows compress so well that a task
    may read very many; files of ``rows_per_file`` (0: any number) count as 4 MB more each."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
