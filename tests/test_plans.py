"""The plans, not the results: what is read, moved and broadcast."""

import re

import pytest
from conftest import PARAMS
from pyspark.sql import functions as F

from termloom import (
    corpus_from_columns,
    build_index,
    load_index,
    lookup,
    query_terms,
    query_terms_from_tokens,
    save_index,
    search_batch,
)


@pytest.fixture(scope="module")
def saved(spark, golden, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "index")
    save_index(golden, path, shards=16)
    return load_index(spark, path)


@pytest.fixture(scope="module")
def batch(spark, saved):
    queries = spark.createDataFrame([(1, "red"), (2, "fox"), (2, "den")], "query_id int, term string")
    return search_batch(saved, query_terms(queries), PARAMS, k=2)


def plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # Unindented, or it is the initial plan of a subquery.
    return text.split("\n+- == Initial Plan ==")[0]


def test_lookup_reads_the_folders_and_columns_it_needs(saved):
    query = query_terms_from_tokens(saved, ["fox"])
    text = plan(lookup(saved, query, ["b"]).select("docid", "tf"))
    assert "EqualTo(term,fox)" in text
    assert re.search(r"PartitionFilters: \[.*field#\d+ = b.*shard#\d+ = \d+", text)
    assert "ReadSchema: struct<term:string,docid:string,tf:bigint>" in text


def test_search_shares_one_shuffle_of_the_postings(batch):
    text = plan(batch)
    by_docid = r"Exchange hashpartitioning\(docid#\d+, \d+\), REPARTITION_BY_COL"
    assert len(re.findall(r"\+- " + by_docid, text)) == 1
    assert len(re.findall(r"ReusedExchange [^\n]*" + by_docid, text)) == 1
    assert not re.search(r"Exchange hashpartitioning\((query_id#\d+, docid|term#\d+, docid)", text)


def test_batch_reads_the_folders_of_its_terms(spark, saved):
    queries = spark.createDataFrame([(1, "red"), (2, "fox")], "query_id int, term string")
    of_table = lookup(saved, query_terms(queries), ["b", "t"])
    of_list = lookup(saved, query_terms_from_tokens(saved, ["red", "fox"]), ["b", "t"])
    found = sorted(map(tuple, of_table.collect()))
    assert found == sorted(map(tuple, of_list.collect())) and len(found) == 7
    assert re.search(r"PartitionFilters: \[[^\n]*shard#\d+ IN \(", plan(of_table))


def test_top_k_is_cut_before_the_shuffle(batch):
    assert plan(batch).count("WindowGroupLimit") == 2


def test_no_cartesian_product_and_no_python(batch):
    text = plan(batch)
    for node in ("CartesianProduct", "NestedLoop", "Python", "Pandas"):
        assert node not in text


def test_building_shuffles_nothing_when_docids_come_once(spark):
    docs = spark.createDataFrame([("a", "red fox")], "id string, t string")
    index = build_index(corpus_from_columns(docs, "id", {"t": "b"}))
    assert "Exchange" not in plan(index.postings)
    hits = lookup(index, query_terms_from_tokens(index, ["fox"]), ["b"])
    assert "Exchange" not in plan(hits)


def test_saving_shuffles_once(spark, tmp_path):
    docs = spark.createDataFrame([("a", "red fox")], "id string, t string")
    index = build_index(corpus_from_columns(docs, "id", {"t": "b"}))
    rebalanced = index.entries.hint("rebalance", "field")
    assert plan(rebalanced).count("Exchange ") == 1


def test_rows_are_counted_before_they_move(spark, monkeypatch):
    from termloom import corpus_from_rows

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([("a", "b", "red fox"), ("a", "b", "fox")], "id string, f string, t string")
        index = build_index(corpus_from_rows(rows, "id", "f", "t"))
        text = index.postings._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for line in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text):
        assert not re.search(r"\btext#|\bt#", line)
    # The exchange by docid and term stands above a partial sum of counts.
    assert re.search(r"Exchange hashpartitioning\([^)]*term[^)]*\)[^\n]*\n[^\n]*HashAggregate\([^\n]*partial_sum\(tf", text)
    assert sorted(tuple(r) for r in index.postings.select("term", "tf", "len").collect()) == [("fox", 2, 3), ("red", 1, 3)]


def test_saving_analyses_a_text_once(spark):
    docs = spark.createDataFrame([("a", "red fox")], "id string, t string")
    index = build_index(corpus_from_columns(docs, "id", {"t": "b"}))
    text = index.entries._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_replace") == 2


def test_lengths_have_their_own_folder(saved):
    text = plan(saved.lengths)
    assert re.search(r"PartitionFilters: \[.*shard#\d+ = -1", text)
    assert "ReadSchema: struct<docid:string,len:bigint>" in text


def test_duplicate_check_does_not_read_texts(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(3).select(F.col("id"), F.lit("some text").alias("t")).write.parquet(path)
    corpus = corpus_from_columns(spark.read.parquet(path), "id", {"t": "b"})
    text = corpus.keys._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in text
