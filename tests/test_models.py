import math

import pytest
from conftest import json_corpus

from termloom import (
    DirichletLikelihood,
    TextbookBM25F,
    build_index,
    document_lengths,
    query_terms_from_tokens,
    score_by_model,
    search_by_model,
)

WEIGHTS = {"t": 2.0, "b": 0.5}
# What the golden corpus says: weighted lengths, and the bags of "fox".
LENGTHS = {"d1": 6.0, "d2": 6.0, "d3": 1.0, "d4": 0.5}
FOX = {"d1": 2.5, "d2": 3.0}
RED = {"d1": 2.5, "d4": 0.5}
N, TOTAL = 5, 2.0 * 4 + 0.5 * 11


def scores(index, tokens, model, weights=WEIGHTS):
    hits = score_by_model(index, query_terms_from_tokens(index, tokens), weights, model)
    return {row["docid"]: row["score"] for row in hits.collect()}


def test_lengths_count_all_fields(golden):
    assert dict(map(tuple, document_lengths(golden, WEIGHTS).collect())) == LENGTHS


def textbook(bag, docid, k1=1.2, b=0.75):
    idf = math.log(1 + (N - len(bag) + 0.5) / (len(bag) + 0.5))
    norm = k1 * (1 - b + b * LENGTHS[docid] / (TOTAL / N))
    return idf * bag[docid] * (k1 + 1) / (bag[docid] + norm)


def test_textbook(golden):
    want = {
        "d1": 2 * textbook(FOX, "d1") + textbook(RED, "d1"),
        "d2": 2 * textbook(FOX, "d2"),
        "d4": textbook(RED, "d4"),
    }
    assert scores(golden, ["fox", "red", "fox", "absent"], TextbookBM25F()) == pytest.approx(want)


def test_dirichlet(golden):
    def likelihood(docid, query):
        # The definition, with probabilities of the smoothed distribution.
        mu, got = 7.0, 0.0
        for bag in query:
            background = sum(bag.values()) / TOTAL
            smoothed = (bag.get(docid, 0.0) + mu * background) / (LENGTHS[docid] + mu)
            got += math.log(smoothed) - math.log(background)
        return got

    query = [FOX, RED, FOX]
    want = {docid: likelihood(docid, query) for docid in ("d1", "d2", "d4")}
    assert scores(golden, ["fox", "red", "fox", "absent"], DirichletLikelihood(7.0)) == pytest.approx(want)


def test_one_field_needs_no_lengths(golden):
    query = query_terms_from_tokens(golden, ["fox"])
    hits = score_by_model(golden, query, {"b": 0.5}, TextbookBM25F(b=1.0))
    assert {row["docid"] for row in hits.collect()} == {"d1", "d2"}
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("docid") and "doc_len" in plan


def test_best_and_ties(golden):
    query = query_terms_from_tokens(golden, ["red", "den"])
    best = search_by_model(golden, query, {"b": 1.0}, TextbookBM25F(b=0.0), k=2, decimals=6)
    # Both terms are in two documents, once each: all four tie.
    assert sorted((r["rank"], r["docid"]) for r in best.collect()) == [(1, "d1"), (2, "d2")]


def test_empty(spark):
    index = build_index(json_corpus(spark, ['{"docid":"a"}']))
    assert scores(index, ["x"], TextbookBM25F()) == {} and scores(index, ["x"], DirichletLikelihood()) == {}


@pytest.mark.parametrize("make", [lambda: TextbookBM25F(k1=0), lambda: TextbookBM25F(b=2), lambda: DirichletLikelihood(-1)])
def test_bad_parameters(make):
    with pytest.raises(ValueError):
        make()


def test_bad_weights(golden):
    query = query_terms_from_tokens(golden, ["x"])
    for weights in ({}, {"t": 0.0}):
        with pytest.raises(ValueError):
            score_by_model(golden, query, weights, TextbookBM25F())
