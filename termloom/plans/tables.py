"""The driver's tables as corpora and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termloom.functions.bm25f import FieldParams, field_params
from termloom.sources.corpus import Corpus, corpus_from_columns, corpus_from_rows

# The parameters of the searches.
DOCUMENT_PARAMS = field_params({"text": 1.0}, {"text": 1.2}, {"text": 0.75})
CONVERSATION_PARAMS = field_params(
    {"user": 1.0, "assistant": 0.5, "system": 0.25},
    {"user": 1.2, "assistant": 1.2, "system": 2.0},
    {"user": 0.75, "assistant": 0.75, "system": 0.5},
)
PAGE_PARAMS = field_params(
    {"address": 2.0, "markup": 1.0}, {"address": 1.2, "markup": 1.2}, {"address": 0.3, "markup": 0.75}
)

# A session may name the number of partitions into which tables are dealt.
READ_PARTITIONS = "termloom.read.partitions"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """The given columns of a table, read where they lie.

    A file of one row group is read by one task, however many cores wait. Who
    has such files may set ``termloom.read.partitions``; rows are then dealt out
    evenly, whatever the size.
    """
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
    partitions = spark.conf.get(READ_PARTITIONS, None)
    return table.repartition(int(partitions)) if partitions else table


def documents_corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    documents = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return corpus_from_columns(documents, "doc_id", {"text": "text"})


def conversations_corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    """One record per conversation, one field per role."""
    turns = read_table(spark, sf_dir, "conversations", ["conv_id", "role", "text"])
    return corpus_from_rows(turns, "conv_id", "role", "text")


def pages_corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    return corpus_from_columns(pages, "page_id", {"url": "address", "html": "markup"})


def parts_corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    parts = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    return corpus_from_columns(parts, "p_partkey", {"p_name": "text"})


def parameters_sql(params: dict[str, FieldParams]) -> str:
    rows = ", ".join(
        f"('{name}', CAST({p.weight} AS DOUBLE), CAST({p.k1} AS DOUBLE), CAST({p.b} AS DOUBLE))"
        for name, p in params.items()
    )
    return f"params(field, w, k1, b) AS (VALUES {rows})"
