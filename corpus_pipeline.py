"""A corpus made ready for training, stage by stage.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and
gives the documents that it keeps, with the columns of ``docs``. The last one
gives the packed pieces. ``run`` writes the result of each stage and reads it
again as the documents of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import crc_remainder, documents, shared_table
from termloom.llm.language import UNDETERMINED, identify_rows, learn_languages
from termloom.llm.minhash import one_of_each
from termloom.llm.packing import pack_documents
from termloom.llm.repeats import without_repeats
from termloom.llm.toxicity import FOLDS, HELD_OUT, THRESHOLD, learn_toxicity, score_rows

#: A text less like every language than this is in none of them. Texts of the
#: languages learned lie above 0.4, whatever their length.
LEAST_LIKENESS = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter (null and empty ones too) and texts that are
    like no language of the corpus. Languages are learned from all of ``docs``."""
    found = identify_rows(docs, learn_languages(docs))
    like = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_LIKENESS)
    return found.where(like).select("record.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts whose toxicity is 0.3 or more, learned from the labels of ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_remainder("doc_id", FOLDS) != HELD_OUT)
    return score_rows(docs, learn_toxicity(docs, labels)).where(F.col("score") < THRESHOLD).select("record.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of each group of near duplicates."""
    return one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 200 bytes and more that occur elsewhere too, in whole
    characters. Every document stays; ``n_chars`` is counted anew where a text has
    changed."""
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return pack_documents(docs)


STAGES = [
    ("language", language),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs


#: Rank orders, a learned lexicon and packing have no SQL.
ORACLE_SQL = None
