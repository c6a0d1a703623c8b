"""What is analysed, moved and held once, however large the tables."""

import re

import pytest
from conftest import PARAMS, json_corpus
from test_index import rows

from termloom import (
    TextbookBM25F,
    build_index,
    corpus_from_columns,
    load_index,
    query_terms,
    save_index,
    score_batch,
    score_by_model,
)
from termloom.operators import expand, ngrams, phrases, retrieve
from termloom.operators.expand import deletion_keys, fuzzy_terms, pattern_terms
from termloom.operators.phrases import Positions, build_positions, phrase_from_tokens, phrase_matches
from termloom.operators.tokens import count_within_rows

TEXTS = ["red fox den", "red fox red", "blue den fox", ""]


@pytest.fixture(scope="module")
def corpus(spark):
    return json_corpus(spark, [f'{{"docid":"d{i}","body":"{text}"}}' for i, text in enumerate(TEXTS)])


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(1, "red"), (2, "fox"), (3, "den")], "query_id int, term string")


def parts_by_docid(hits):
    text = hits._jdf.queryExecution().executedPlan().toString()
    return {int(n) for n in re.findall(r"hashpartitioning\(docid#\d+, (\d+)\), REPARTITION", text)}


@pytest.mark.parametrize("saved", [False, True])
def test_tasks_grow_with_documents_and_queries(spark, monkeypatch, tmp_path, corpus, queries, saved):
    index = build_index(corpus)
    if saved:
        save_index(index, str(tmp_path / "index"), shards=2)
        index = load_index(spark, str(tmp_path / "index"))
    params = {"b": PARAMS["b"]}
    few, few_by_model = (
        score_batch(index, query_terms(queries), params),
        score_by_model(index, query_terms(queries), {"b": 1.0}, TextbookBM25F()),
    )
    # 4 documents and 3 queries are 12 pairs.
    monkeypatch.setattr(retrieve, "PAIRS_PER_TASK", 2)
    many = score_batch(index, query_terms(queries), params)
    by_model = score_by_model(index, query_terms(queries), {"b": 1.0}, TextbookBM25F())
    assert parts_by_docid(many) == {6} and parts_by_docid(by_model) == {6}
    assert rows(many) == rows(few) and rows(by_model) == rows(few_by_model)


def test_a_search_analyses_texts_once(spark, corpus, queries):
    query = query_terms(queries)
    for hits in (
        score_batch(build_index(corpus), query, {"b": PARAMS["b"]}),
        score_by_model(build_index(corpus), query, {"b": 1.0}, TextbookBM25F()),
    ):
        text = hits._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in text.split("Subquery")[0] and "sort_array" not in text


def test_expanded_queries_are_tables(spark, corpus):
    index = build_index(corpus)
    for query in (
        fuzzy_terms(index, spark.createDataFrame([(1, "rid")], "query_id int, term string")),
        pattern_terms(index, spark.createDataFrame([(1, "r?d")], "query_id int, term string")),
    ):
        text = query.rows._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in text and "levenshtein" not in text
        assert rows(query.rows.select("term")) == [("red",)]


def test_keys_of_short_and_long_terms(spark):
    terms = ["", "a", "ab", "aab", "abcdefgh", "abcdefghij", "éüab"]

    def left_out(text, n):
        found = {text}
        for _ in range(n):
            found |= {t[:i] + t[i + 1 :] for t in found for i in range(len(t))}
        return sorted(found)

    table = spark.createDataFrame([(t,) for t in terms], "term string")
    for distance in range(3):
        keys = table.select("term", deletion_keys(table["term"], distance).alias("keys")).collect()
        assert {r["term"]: sorted(r["keys"]) for r in keys} == {t: left_out(t[: expand.PREFIX], distance) for t in terms}
    text = table.select(deletion_keys(table["term"], 2))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in text


def test_terms_are_sorted_without_a_comparator(spark, corpus):
    for table in (count_within_rows(corpus.texts), build_positions(corpus).postings):
        text = table._jdf.queryExecution().optimizedPlan().toString()
        assert "sort_array" in text and "array_sort" not in text


@pytest.mark.parametrize("listed", [0, 100])
def test_only_asked_terms_are_placed(spark, monkeypatch, corpus, listed):
    monkeypatch.setattr(phrases, "MAX_LISTED", listed)
    positions = build_positions(corpus)
    got = rows(phrase_matches(positions, phrase_from_tokens(spark, ["red", "fox"]), ["b"]))
    assert got == [(0, "b", "d0", 1), (0, "b", "d1", 1)]
    asked = phrase_from_tokens(spark, ["red", "fox"])
    text = phrases._postings_of(positions, asked, ["b"])._jdf.queryExecution().optimizedPlan().toString()
    assert (" IN (" in text) == (listed > 0)
    assert Positions(positions.postings).texts is None


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_grams_are_moved_only_if_frequent(spark, monkeypatch, broadcast):
    monkeypatch.setattr(ngrams, "MAX_BROADCAST_ROWS", broadcast)
    # A docid comes twice, which is one document.
    table = spark.createDataFrame([("x", "a b a b c"), ("y", "a b c"), ("x", "b c d"), (None, "a b")], "id string, t string")
    corpus = corpus_from_columns(table, "id", {"t": "b"})
    got = rows(ngrams.ngram_postings(corpus, 3, 2).select("n", "term", "docid", "tf"))
    texts = [(r["docid"], r["text"].split()) for r in corpus.texts.collect()]
    counts = {}
    for docid, terms in texts:
        for n in (1, 2, 3):
            for i in range(len(terms) - n + 1):
                key = (n, " ".join(terms[i : i + n]))
                counts.setdefault(key, {}).setdefault(docid, 0)
                counts[key][docid] += 1
    want = [(n, t, d, c) for (n, t), found in counts.items() if sum(found.values()) >= 2 for d, c in found.items()]
    assert got == sorted(want)
    labels = []
    real = ngrams.written
    monkeypatch.setattr(ngrams, "written", lambda df, label: labels.append(label) or real(df, label))
    ngrams.ngram_postings(corpus, 1, 2)
    # The places of single terms are no table.
    assert labels == ["frequent"]
