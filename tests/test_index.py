import pytest
from conftest import GOLDEN, PARAMS, json_corpus
from pyspark.sql import functions as F

from termloom import (
    build_index,
    load_index,
    merge_indexes,
    query_terms,
    save_index,
    search,
    search_batch,
    vocabulary,
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def postings(index):
    return rows(index.postings.select("field", "term", "docid", "tf", "len"))


def lengths(index):
    return rows(index.lengths.select("field", "docid", "len"))


def hits(df):
    return [(r["docid"], r["score"]) for r in df.collect()]


def test_golden_tables(golden):
    assert lengths(golden) == [
        ("b", "d1", 4), ("b", "d2", 4), ("b", "d3", 2), ("b", "d4", 1),
        ("t", "d1", 2), ("t", "d2", 2), ("t", "d3", 0),
    ]
    stats = {r["field"]: r for r in golden.field_stats.collect()}
    assert stats["t"]["avg_len"] == pytest.approx(4 / 3) and stats["t"]["n_field_docs"] == 3
    assert stats["b"]["avg_len"] == 2.75 and stats["b"]["total_len"] == 11
    assert golden.corpus_stats.first()["n_docs"] == 5
    assert ("b", "", "d2", 1, 4) in postings(golden)
    assert ("b", "fox", "d2", 2, 4) in postings(golden)
    terms = rows(vocabulary(golden.postings))
    assert ("b", "fox", 2, 3) in terms and ("t", "fox", 2, 2) in terms


def test_tf_adds_up_to_length(golden):
    sums = rows(golden.postings.groupBy("field", "docid").agg(F.sum("tf")))
    assert sums == [r for r in lengths(golden) if r[2] > 0]


REPEATED = [
    '{"docid":"x","title":"one two"}',
    '{"docid":"x","title":"two three","body":"b"}',
    '{"docid":"x","title":""}',
    '{"docid":"y","title":"two"}',
]


def test_repeated_docids_are_merged(spark):
    want = [
        ("b", "b", "x", 1, 1),
        ("t", "one", "x", 1, 4),
        ("t", "three", "x", 1, 4),
        ("t", "two", "x", 2, 4),
        ("t", "two", "y", 1, 1),
    ]
    index = build_index(json_corpus(spark, REPEATED))
    assert postings(index) == want
    assert lengths(index) == [("b", "x", 1), ("t", "x", 4), ("t", "y", 1)]
    assert index.corpus_stats.first()["n_docs"] == 4


def test_repeated_docids_can_be_refused(spark):
    with pytest.raises(ValueError, match="more than once"):
        build_index(json_corpus(spark, REPEATED), duplicates="error")
    with pytest.raises(ValueError, match="duplicates"):
        build_index(json_corpus(spark, REPEATED), duplicates="drop")


def test_merge_of_disjoint_indexes(spark, golden):
    a, b = (build_index(json_corpus(spark, part)) for part in (GOLDEN[:2], GOLDEN[2:]))
    merged = merge_indexes(a, b, duplicates="error")
    assert postings(merged) == postings(golden)
    assert lengths(merged) == lengths(golden)
    assert rows(merged.field_stats) == rows(golden.field_stats)
    assert merged.corpus_stats.first()["n_docs"] == 5


def test_merge_of_overlapping_indexes(spark):
    a, b = (build_index(json_corpus(spark, part)) for part in (REPEATED[:2], REPEATED[2:]))
    whole = build_index(json_corpus(spark, REPEATED))
    c = build_index(json_corpus(spark, [REPEATED[1]]))
    merged = merge_indexes(a, b)
    assert postings(merged) == postings(whole) and lengths(merged) == lengths(whole)
    with pytest.raises(ValueError, match="more than once"):
        merge_indexes(a, c, duplicates="error")


@pytest.mark.parametrize("shards", [1, 8, None])
def test_save_and_load(spark, golden, tmp_path, shards):
    path = str(tmp_path / "index")
    save_index(golden, path, shards=shards)
    loaded = load_index(spark, path)
    assert postings(loaded) == postings(golden)
    assert lengths(loaded) == lengths(golden)
    assert hits(search(loaded, ["red", "fox"], PARAMS, decimals=6)) == hits(
        search(golden, ["red", "fox"], PARAMS, decimals=6)
    )
    queries = spark.createDataFrame([(1, "red"), (1, "fox"), (2, "den")], "query_id int, term string")
    want = search_batch(golden, query_terms(queries), PARAMS, 3, decimals=6)
    assert rows(search_batch(loaded, query_terms(queries), PARAMS, 3, decimals=6)) == rows(want)
    # A merged index is one that can be saved again, from the saved parts.
    other = build_index(json_corpus(spark, ['{"docid":"d6","title":"red"}']))
    save_index(merge_indexes(loaded, other), str(tmp_path / "next"), shards=shards)
    again = load_index(spark, str(tmp_path / "next"))
    assert again.corpus_stats.first()["n_docs"] == 6
    assert len(postings(again)) == len(postings(golden)) + 1


def test_loading_some_fields_keeps_the_document_count(spark, golden, tmp_path):
    path = str(tmp_path / "index")
    save_index(golden, path)
    loaded = load_index(spark, path, ["b"])
    assert {r[0] for r in postings(loaded)} == {"b"}
    assert loaded.corpus_stats.first()["n_docs"] == 5
    only = {"b": PARAMS["b"]}
    assert hits(search(loaded, ["fox"], only)) == hits(search(golden, ["fox"], only))


def test_field_names_survive_the_folders(spark, tmp_path):
    aliases = {"a": "1", "b": "x/y=z", "c": "T", "d": "t"}
    lines = ['{"docid":"1","a":"p","b":"q","c":"r","d":"s"}']
    path = str(tmp_path / "index")
    save_index(build_index(json_corpus(spark, lines, aliases)), path)
    assert [r[:2] for r in postings(load_index(spark, path))] == [
        ("1", "p"), ("T", "r"), ("t", "s"), ("x/y=z", "q")
    ]


def test_empty_corpus(spark, tmp_path):
    index = build_index(json_corpus(spark, ["{"]))
    path = str(tmp_path / "index")
    save_index(index, path)
    loaded = load_index(spark, path)
    assert postings(loaded) == [] and hits(search(loaded, ["fox"], PARAMS)) == []
    assert loaded.corpus_stats.first()["n_docs"] == 0


def test_fields_are_kept_or_refused(spark, tmp_path):
    from termloom import corpus_from_rows, lookup, query_terms_from_tokens

    names = ["a b", "x=y", "1", "Ä/%", "", "__HIVE_DEFAULT_PARTITION__", None]
    rows_in = spark.createDataFrame([("d", name, "red") for name in names], "id string, f string, t string")
    corpus = corpus_from_rows(rows_in, "id", "f", "t")
    assert sorted(r["reason"] for r in corpus.quarantine.collect()) == ["field_name_refused"] * 2
    index = build_index(corpus)
    save_index(index, str(tmp_path / "index"), shards=2)
    loaded = load_index(spark, str(tmp_path / "index"))
    assert postings(loaded) == postings(index) and loaded.fields == tuple(sorted(names[:4]))
    with pytest.raises(ValueError, match="nope"):
        load_index(spark, str(tmp_path / "index"), ["a b", "nope"])
    some = load_index(spark, str(tmp_path / "index"), ["a b"])
    with pytest.raises(ValueError, match="x=y"):
        lookup(some, query_terms_from_tokens(some, ["red"]), ["a b", "x=y"])
