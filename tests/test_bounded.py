"""The bounded batch search gives the rows of the full one and looks at fewer matches."""

import random

import pytest
from pyspark.sql import functions as F

from termloom import (
    build_index,
    corpus_from_columns,
    field_params,
    load_bounds,
    load_index,
    query_terms,
    save_bounds,
    save_index,
    score_bounds,
    search_batch,
    search_batch_bounded,
)
from termloom.operators import bounded
from termloom.operators.bounds import block_of, saturation_bounds, term_frequency_in
from termloom.operators.retrieve import gather_fields, with_field_scores

TWO = field_params({"a": 1.0, "b": 0.4}, {"a": 1.2, "b": 0.9}, {"a": 0.75, "b": 0.3})
ONE = field_params({"b": 1.0}, {"b": 1.2}, {"b": 1.0})


def zipf_words(rnd, n):
    return " ".join(f"w{int(200 * rnd.random() ** 4)}" for _ in range(n))


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        text = zipf_words(rnd, rnd.randint(0, 40))
        rows.append((f"d{i}", text if rnd.random() < 0.9 else None, zipf_words(rnd, rnd.randint(0, 15))))
    rows += [(f"copy{i}", "w3 w100 w101", "w3") for i in range(30)]
    df = spark.createDataFrame(rows, "id string, x string, y string")
    path = str(tmp_path_factory.mktemp("bounded") / "index")
    save_index(build_index(corpus_from_columns(df, "id", {"x": "a", "y": "b"})), path)
    index = load_index(spark, path)
    save_bounds(score_bounds(index, docs_per_block=50), path)
    return index, load_bounds(spark, path)


def queries(spark):
    rnd = random.Random(8)
    rows = [(q, f"w{int(200 * rnd.random() ** 3)}") for q in range(25) for _ in range(rnd.randint(1, 12))]
    # Repeated terms, frequent terms only, rare terms only, unknown and null terms.
    rows += [(50, "w0"), (50, "w0"), (50, "w1"), (51, "w199"), (52, "nowhere"), (53, None), (54, "w100"), (54, "w3")]
    return query_terms(spark.createDataFrame(rows, "query_id int, term string"))


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["docid"], round(r["score"], 6)) for r in df.collect())


@pytest.mark.parametrize("params", [TWO, ONE], ids=["two", "one"])
@pytest.mark.parametrize("k", [1, 5, 40])
def test_same_rows(spark, saved, params, k):
    index, bounds = saved
    query = queries(spark)
    want = rows_of(search_batch(index, query, params, k, decimals=6))
    assert rows_of(search_batch_bounded(index, bounds, query, params, k, decimals=6)) == want
    assert want


def test_same_rows_without_length_norm(spark, saved):
    index, bounds = saved
    query = queries(spark)
    want = rows_of(search_batch(index, query, TWO, 3, "off", 6))
    assert rows_of(search_batch_bounded(index, bounds, query, TWO, 3, "off", 6)) == want


def test_same_rows_by_shuffles(spark, saved, monkeypatch):
    """Nothing is broadcast."""
    index, bounds = saved
    query = queries(spark)
    want = rows_of(search_batch(index, query, TWO, 5, decimals=6))
    monkeypatch.setattr(bounded, "MAX_BROADCAST_ROWS", -1)
    by_shuffles = type(query)(query.rows, False, False)
    assert rows_of(search_batch_bounded(index, bounds, by_shuffles, TWO, 5, decimals=6)) == want


def test_bounds_hold(saved):
    index, bounds = saved
    limits = saturation_bounds(bounds, index.field_stats, TWO)
    scored = with_field_scores(gather_fields(index.postings, TWO), index.field_stats, TWO)
    total = F.coalesce("score0", F.lit(0.0)) + F.coalesce("score1", F.lit(0.0))
    scored = scored.select("term", block_of(F.col("docid"), bounds.n_blocks).alias("block"), total.alias("s"))
    joined = scored.join(limits, ["term", "block"], "left")
    assert joined.where("bound IS NULL OR s > bound + 1e-12").count() == 0
    assert joined.count() > 5000


def test_one_field_is_read_once_for_bounds_and_documents(spark, saved, tmp_path):
    """Documents of a term are added up from the bounds, not counted in the postings again."""
    path = saved_field_b(spark, tmp_path)
    index = load_index(spark, path)
    bounds = score_bounds(index, docs_per_block=4)
    assert "n_docs" in bounds.bounds.columns and bounds.only_field == "b"
    save_bounds(bounds, path)
    loaded = load_bounds(spark, path)
    want = index.postings.groupBy("term").agg(F.countDistinct("docid").alias("df"))
    assert sorted(term_frequency_in(loaded, ["b"]).collect()) == sorted(want.collect())
    assert sorted(term_frequency_in(bounds, ["b"]).collect()) == sorted(want.collect())
    query = query_terms(spark.createDataFrame([(1, "w1"), (1, "w2"), (2, "w9")], "query_id int, term string"))
    assert rows_of(search_batch_bounded(index, loaded, query, ONE, 3, decimals=6)) == rows_of(
        search_batch(index, query, ONE, 3, decimals=6)
    )


def saved_field_b(spark, tmp_path):
    rnd = random.Random(9)
    df = spark.createDataFrame([(f"d{i}", zipf_words(rnd, 12)) for i in range(40)], "id string, x string")
    save_index(build_index(corpus_from_columns(df, "id", {"x": "b"})), str(tmp_path / "one"))
    return str(tmp_path / "one")


@pytest.mark.parametrize("fields", [["a"], ["b"], ["a", "b"]])
def test_document_frequencies(saved, fields):
    index, bounds = saved
    want = index.postings.where(F.col("field").isin(fields)).groupBy("term").agg(F.countDistinct("docid").alias("df"))
    assert sorted(term_frequency_in(bounds, fields).collect()) == sorted(want.collect())


def test_fewer_than_half_of_the_matches(spark, saved):
    index, bounds = saved
    query = queries(spark)
    weights = bounded.weighted_terms(index, bounds, query, TWO)
    least = bounded.lead_thresholds(index, query, weights, TWO, 1, "mean").select("query_id", F.col("threshold").alias("least"))
    plan = bounded.block_plan(weights, saturation_bounds(bounds, index.field_stats, TWO), least, True)
    needed = bounded.matched_rows(index, bounds, plan.where("needed"), TWO).first()["n"]
    everything = index.postings.join(query.rows, "term").count()
    assert 0 < needed < everything / 2


def test_no_terms_and_no_documents(spark, tmp_path):
    df = spark.createDataFrame([], "id string, x string")
    save_index(build_index(corpus_from_columns(df, "id", {"x": "b"})), str(tmp_path / "index"))
    index = load_index(spark, str(tmp_path / "index"))
    save_bounds(score_bounds(index), str(tmp_path / "index"))
    bounds = load_bounds(spark, str(tmp_path / "index"))
    assert search_batch_bounded(index, bounds, queries(spark), ONE, 3).collect() == []


def test_parameters_are_checked(spark, saved):
    index, bounds = saved
    with pytest.raises(ValueError, match="positive"):
        search_batch_bounded(index, bounds, queries(spark), ONE, 0)
    with pytest.raises(ValueError, match="no fields"):
        search_batch_bounded(index, bounds, queries(spark), field_params({"z": 1}, {"z": 1}, {"z": 1}), 3)
