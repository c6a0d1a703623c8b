import pytest
from conftest import GOLDEN, PARAMS, json_corpus

from termloom import (
    FieldParams,
    build_index,
    field_params,
    query_terms,
    query_terms_from_texts,
    rank_all,
    score_batch,
    score_term,
    search,
    search_batch,
    search_text,
)

# Hand-computed: tokens, hits with the mean length, hits without it.
SCORES = [
    (["fox"], [("d2", 2.645065), ("d1", 2.091178)], [("d2", 7.333333), ("d1", 6.722222)]),
    (["red"], [("d4", 2.240741), ("d1", 2.091178)], [("d1", 6.722222), ("d4", 3.055556)]),
    (["the"], [("d3", 1.769006), ("d1", 1.244856)], [("d1", 3.055556), ("d3", 3.055556)]),
    (["den"], [("d3", 1.769006), ("d2", 1.244856)], [("d2", 3.055556), ("d3", 3.055556)]),
    ([""], [("d2", 2.489712)], [("d2", 6.111111)]),
    (["Fox"], [], []),
    ([], [], []),
    (
        ["red", "fox"],
        [("d1", 4.182355), ("d2", 2.645065), ("d4", 2.240741)],
        [("d1", 13.444444), ("d2", 7.333333), ("d4", 3.055556)],
    ),
    (
        ["red", "red"],
        [("d4", 4.481481), ("d1", 4.182355)],
        [("d1", 13.444444), ("d4", 6.111111)],
    ),
]


def hits(df):
    return [(row["docid"], row["score"]) for row in df.collect()]


@pytest.mark.parametrize("tokens, mean, off", SCORES)
def test_golden_scores(golden, tokens, mean, off):
    assert hits(search(golden, tokens, PARAMS, decimals=6)) == mean
    assert hits(search(golden, tokens, PARAMS, decimals=6, length_norm="off")) == off


def test_top_k_of_fewer_hits(golden):
    assert hits(search(golden, ["fox"], PARAMS, k=5, decimals=6)) == SCORES[0][1]
    assert hits(search(golden, ["fox"], PARAMS, k=1, decimals=6)) == SCORES[0][1][:1]


def test_single_token_equals_query_of_one(golden):
    assert sorted(hits(score_term(golden, "fox", PARAMS))) == sorted(
        hits(search(golden, ["fox"], PARAMS))
    )


def test_query_text_is_analysed_only_on_request(golden):
    assert hits(search(golden, ["RED,", "Fox!"], PARAMS)) == []
    assert hits(search_text(golden, "RED, Fox!", PARAMS, decimals=6)) == SCORES[7][1]


def test_df_counts_documents_of_the_chosen_fields(golden):
    only_body = {"b": PARAMS["b"]}
    # "fox" is in the body of d1 and d2, "blue" in no body.
    assert [d for d, _ in hits(search(golden, ["fox"], only_body))] == ["d2", "d1"]
    assert hits(search(golden, ["blue"], only_body)) == []


def test_batch_equals_single_queries(spark, golden):
    bags = {str(i): tokens for i, (tokens, _, _) in enumerate(SCORES)}
    rows = [(q, t) for q, tokens in bags.items() for t in tokens]
    query = query_terms(spark.createDataFrame(rows, "query_id string, term string"))
    assert query.few_rows and query.few_terms
    got = search_batch(golden, query, PARAMS, k=2, decimals=6).collect()
    want = [
        (str(i), docid, score, rank)
        for i, (_, mean, _) in enumerate(SCORES)
        for rank, (docid, score) in enumerate(mean[:2], 1)
    ]
    assert sorted((r["query_id"], r["docid"], r["score"], r["rank"]) for r in got) == sorted(want)


def test_large_query_tables_take_shuffled_joins(spark, golden, monkeypatch):
    rows = [(str(i), t) for i, (tokens, _, _) in enumerate(SCORES) for t in tokens]
    queries = spark.createDataFrame(rows, "query_id string, term string")
    small = rank_all(score_batch(golden, query_terms(queries), PARAMS)).collect()
    distinct = len({term for _, term in rows})
    for limit, few_terms in ((distinct, True), (0, False)):
        monkeypatch.setattr("termloom.operators.retrieve.MAX_BROADCAST_ROWS", limit)
        query = query_terms(queries)
        assert (query.few_rows, query.few_terms) == (False, few_terms)
        large = rank_all(score_batch(golden, query, PARAMS)).collect()
        assert [r[:2] for r in large] == [r[:2] for r in small]
        assert [r[2] for r in large] == pytest.approx([r[2] for r in small])


def test_many_tokens(golden):
    many = ["red", "fox", *(f"w{i}" for i in range(2000))]
    assert hits(search(golden, many, PARAMS, decimals=6)) == SCORES[7][1]


def test_query_texts(spark, golden):
    texts = spark.createDataFrame([(1, "Red FOX!"), (2, "red red"), (3, " ")], "id int, q string")
    query = query_terms_from_texts(texts, "id", "q")
    got = search_batch(golden, query, PARAMS, k=1, decimals=6).collect()
    assert sorted(tuple(r) for r in got) == [(1, "d1", 4.182355, 1), (2, "d4", 4.481481, 1)]


def test_partitioning_does_not_change_results(spark, golden):
    other = build_index(json_corpus(spark, GOLDEN))
    assert hits(search(other, ["red", "fox"], PARAMS, decimals=6)) == SCORES[7][1]


def test_parameters_are_checked():
    with pytest.raises(ValueError, match="k1 has no value"):
        field_params({"t": 1.0}, {}, {"t": 0.5})
    for bad in ((0.0, 1.2, 0.5), (1.0, -1.0, 0.5), (1.0, 1.2, 1.5), (float("nan"), 1.2, 0.5)):
        with pytest.raises(ValueError):
            FieldParams(*bad)


def test_unknown_length_norm(golden):
    with pytest.raises(ValueError, match="length_norm"):
        search(golden, ["fox"], PARAMS, length_norm="log")
