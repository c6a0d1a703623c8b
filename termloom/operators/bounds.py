"""What a term can score at most, block by block, and how often it occurs.

Documents fall into blocks by a hash of the docid. For each field, term and block the
table ``bounds`` holds the largest frequency and the least length of its postings. A
field score grows with the frequency and falls with the length, so the two give a bound
for any parameters, although they may come from different documents. ``n_docs`` counts the
postings.

``term_docs(term, fields, n_docs)`` counts the documents that have a term in exactly
these fields. The document frequency over any choice of fields is a sum of its rows,
so a search need not see the postings of a frequent term to know its weight. Of an index
with one field it is a sum over the blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.bm25f import FieldParams, check_length_norm, saturation
from termloom.operators.build import Index

#: Small blocks give nearly as many bounds as there are postings.
DOCS_PER_BLOCK = 8192

BOUNDS_SCHEMA = "field string, term string, block int, max_tf bigint, min_len bigint, n_docs bigint"
TERM_DOCS_SCHEMA = "term string, fields array<string>, n_docs bigint"
BLOCKS_SCHEMA = "n_blocks int"


@dataclass(frozen=True)
class Bounds:
    """``bounds(field, term, block, max_tf, min_len, n_docs)``, ``term_docs(term, fields,
    n_docs)`` and the number of blocks. ``only_field`` names the field of an index that is
    known to have just one."""

    bounds: DataFrame
    term_docs: DataFrame
    n_blocks: int
    only_field: str | None = None


def block_of(docid: Column, n_blocks: int) -> Column:
    """The block of a document. The seed keeps it apart from Spark's own hashing."""
    return F.pmod(F.xxhash64(F.lit("block"), docid), F.lit(n_blocks)).cast("int")


def block_bounds(index: Index, n_blocks: int) -> DataFrame:
    """``(field, term, block, max_tf, min_len, n_docs)``; counted within each split first."""
    placed = index.postings.withColumn("block", block_of(F.col("docid"), n_blocks))
    return placed.groupBy("field", "term", "block").agg(
        F.max("tf").alias("max_tf"), F.min("len").alias("min_len"), F.count("*").alias("n_docs")
    )


def documents_by_fields(index: Index) -> DataFrame:
    """``(term, fields, n_docs)``. Shuffles pairs of a term and a document, so that a
    frequent term is spread."""
    pairs = index.postings.groupBy("term", "docid").agg(F.sort_array(F.collect_set("field")).alias("fields"))
    return pairs.groupBy("term", "fields").agg(F.count("*").alias("n_docs"))


def documents_of_field(bounds: DataFrame, field: str) -> DataFrame:
    """``(term, fields, n_docs)`` of the only field: a document has one posting for a term."""
    found = bounds.groupBy("term").agg(F.sum("n_docs").alias("n_docs"))
    return found.select("term", F.array(F.lit(field)).alias("fields"), "n_docs")


def suggested_blocks(index: Index, docs_per_block: int = DOCS_PER_BLOCK) -> int:
    n_docs = index.corpus_stats.first()["n_docs"] or 0
    return max(1, -(-n_docs // docs_per_block))


def score_bounds(index: Index, docs_per_block: int = DOCS_PER_BLOCK) -> Bounds:
    """The bounds of an index, not yet computed. Of one that is saved, save them too."""
    n_blocks = suggested_blocks(index, docs_per_block)
    bounds = block_bounds(index, n_blocks)
    if index.fields is not None and len(index.fields) == 1:
        return Bounds(bounds, documents_of_field(bounds, index.fields[0]), n_blocks, index.fields[0])
    return Bounds(bounds, documents_by_fields(index), n_blocks)


def save_bounds(bounds: Bounds, path: str) -> None:
    """Write the bounds beside a saved index, sorted by term within the files.

    They are not sorted across files: a range sort would compute them twice, and a search
    joins them with its terms, which skips no file. With one field the documents of a term
    are added up from what was written.
    """
    spark = bounds.bounds.sparkSession
    bounds.bounds.sortWithinPartitions("field", "term").write.partitionBy("field").parquet(f"{path}/bounds")
    term_docs = bounds.term_docs
    if bounds.only_field is not None:
        term_docs = documents_of_field(_read_bounds(spark, path), bounds.only_field)
    term_docs.sortWithinPartitions("term").write.parquet(f"{path}/term_docs")
    one = spark.createDataFrame([(bounds.n_blocks,)], BLOCKS_SCHEMA)
    one.coalesce(1).write.parquet(f"{path}/blocks")


def load_bounds(spark: SparkSession, path: str) -> Bounds:
    return Bounds(
        _read_bounds(spark, path),
        spark.read.schema(TERM_DOCS_SCHEMA).parquet(f"{path}/term_docs"),
        spark.read.schema(BLOCKS_SCHEMA).parquet(f"{path}/blocks").first()["n_blocks"],
    )


def _read_bounds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BOUNDS_SCHEMA).parquet(f"{path}/bounds")


def term_frequency_in(bounds: Bounds, fields: Iterable[str]) -> DataFrame:
    """``(term, df)`` over the documents that have a term in any of the fields."""
    chosen = F.array(*[F.lit(name) for name in sorted(fields)])
    hit = bounds.term_docs.where(F.arrays_overlap("fields", chosen))
    return hit.groupBy("term").agg(F.sum("n_docs").alias("df"))


def saturation_bounds(
    bounds: Bounds,
    field_stats: DataFrame,
    params: Mapping[str, FieldParams],
    length_norm: str = "mean",
    terms: DataFrame | None = None,
) -> DataFrame:
    """``(term, block, bound)``: no document of the block has a larger saturation. With
    ``terms(term)``, ready to join, for these terms only.

    The length that counts for a field is that of all fields with the term, and so at
    least that of the field itself.
    """
    check_length_norm(length_norm)
    names = sorted(params)
    means = (
        field_stats.where(F.col("field").isin(names))
        .agg(F.map_from_entries(F.collect_list(F.struct("field", "avg_len"))).alias("means"))
        .scalar()
    )
    bound = F.lit(None).cast("double")
    for name in names:
        own_length = F.lit(params[name].weight) * F.col("min_len")
        mean = F.try_element_at(means, F.lit(name))
        most = saturation(F.col("max_tf"), own_length, mean, params[name], length_norm)
        bound = F.when(F.col("field") == name, most).otherwise(bound)
    rows = bounds.bounds.where(F.col("field").isin(names))
    if terms is not None:
        rows = rows.join(terms, "term", "left_semi")
    rows = rows.select("term", "block", bound.alias("bound"))
    if len(names) == 1:
        return rows
    return rows.groupBy("term", "block").agg(F.sum("bound").alias("bound"))
