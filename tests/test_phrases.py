"""Phrases against a search through the lists of terms."""

import random

import pyarrow.parquet as pq
import pytest

from termloom import (
    build_index,
    build_positions,
    corpus_from_columns,
    corpus_from_rows,
    field_params,
    load_positions,
    phrase_matches,
    phrases_from_texts,
    save_positions,
    search_phrase,
    search_phrases,
)

PARAMS = field_params({"a": 1.0, "b": 0.5}, {"a": 1.2, "b": 1.2}, {"a": 0.75, "b": 0.75})


def plain_count(text, phrase):
    terms = (text or "").split()
    return sum(terms[i : i + len(phrase)] == phrase for i in range(len(terms) - len(phrase) + 1))


@pytest.fixture(scope="module")
def corpus_rows():
    rnd = random.Random(1)
    rows = [
        (f"d{i}", *[" ".join(rnd.choices("xyzuv", [8, 4, 2, 1, 1], k=rnd.randint(0, 25))) for _ in range(2)])
        for i in range(150)
    ]
    return rows + [("empty", "", None), ("none", None, None), ("long", "x " * 3000 + "y", "x")]


PHRASES = [["x"], ["x", "x"], ["x", "x", "x"], ["x", "y", "x"], ["u", "v"], ["v", "x", "u", "x"], ["x", "nowhere"], ["z", "z"]]


@pytest.fixture(scope="module")
def corpus(spark, corpus_rows):
    df = spark.createDataFrame(corpus_rows, "id string, p string, q string")
    return corpus_from_columns(df, "id", {"p": "a", "q": "b"})


def phrase_table(spark):
    rows = [(q, " ".join(phrase)) for q, phrase in enumerate(PHRASES)] + [(90, None), (91, " ")]
    return phrases_from_texts(spark.createDataFrame(rows, "qid int, text string"), "qid", "text")


def plain_matches(corpus_rows):
    return sorted(
        (q, field, docid, n)
        for q, phrase in enumerate(PHRASES)
        for docid, *texts in corpus_rows
        for field, text in zip("ab", texts)
        if (n := plain_count(text, phrase))
    )


def test_matches(spark, corpus, corpus_rows):
    found = phrase_matches(build_positions(corpus), phrase_table(spark), ["a", "b"])
    assert sorted(map(tuple, found.select("query_id", "field", "docid", "tf").collect())) == plain_matches(corpus_rows)


def test_saved_positions(spark, corpus, corpus_rows, tmp_path):
    save_positions(build_positions(corpus), str(tmp_path), 3)
    found = phrase_matches(load_positions(spark, str(tmp_path), 3), phrase_table(spark), ["b"])
    want = [row for row in plain_matches(corpus_rows) if row[1] == "b"]
    assert sorted(map(tuple, found.select("query_id", "field", "docid", "tf").collect())) == want
    # Places are stored as differences.
    file = next((tmp_path / "positions" / "field=a").rglob("*.parquet"))
    chunk = pq.ParquetFile(file).metadata.row_group(0)
    places = next(chunk.column(i) for i in range(chunk.num_columns) if chunk.column(i).path_in_schema.startswith("positions"))
    assert "DELTA_BINARY_PACKED" in places.encodings or "RLE_DICTIONARY" in places.encodings


def test_scores(spark, corpus, corpus_rows):
    """The formula by hand, the phrase as the term."""
    index, positions = build_index(corpus), build_positions(corpus)
    mean = {
        f: sum(len(t.split()) for t in texts) / len(texts)
        for f, texts in (("a", [r[1] for r in corpus_rows if r[1] is not None]), ("b", [r[2] for r in corpus_rows if r[2] is not None]))
    }
    phrase = ["x", "y", "x"]
    scores = {}
    for docid, *texts in corpus_rows:
        hit = {f: (plain_count(t, phrase), len(t.split())) for f, t in zip("ab", texts) if plain_count(t, phrase)}
        length = sum(PARAMS[f].weight * n for f, (_, n) in hit.items())
        for f, (tf, _) in hit.items():
            p, x = PARAMS[f], PARAMS[f].weight * tf
            s = x * (p.k1 + 1) / (p.k1 * ((1 - p.b) + p.b * length / (p.weight * mean[f]) + x))
            scores[docid] = scores.get(docid, 0) + s
    want = sorted(((d, round(s * len(corpus_rows) / len(scores), 6)) for d, s in scores.items()), key=lambda r: (-r[1], r[0]))
    got = search_phrase(index, positions, phrase, PARAMS, decimals=6).collect()
    assert [tuple(row) for row in got] == want and len(want) > 20
    batch = search_phrases(index, positions, phrase_table(spark), PARAMS, k=4, decimals=6).where("query_id = 3")
    assert [(r["docid"], r["score"]) for r in batch.orderBy("rank").collect()] == want[:4]


def test_phrases_stay_within_a_row(spark):
    rows = [("c", "a", "x y"), ("c", "a", "z x y"), ("c", "a", "y z"), ("e", "a", "y"), ("e", "a", "z")]
    corpus = corpus_from_rows(spark.createDataFrame(rows, "id string, f string, t string"), "id", "f", "t")
    asked = phrases_from_texts(spark.createDataFrame([(1, "x y"), (2, "y z")], "q int, t string"), "q", "t")
    found = phrase_matches(build_positions(corpus), asked, ["a"])
    assert sorted(map(tuple, found.select("query_id", "docid", "tf").collect())) == [(1, "c", 2), (2, "c", 1)]


def test_no_phrases(spark, corpus):
    assert search_phrase(build_index(corpus), build_positions(corpus), [], PARAMS).collect() == []
