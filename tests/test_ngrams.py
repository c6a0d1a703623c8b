import random
from collections import Counter
from pathlib import Path

import pytest
from conftest import PARAMS, json_corpus
from test_index import rows

from termloom import build_ngram_index, frequent_ngrams, load_index, ngram_postings, save_index, search
from termloom.operators import gram_counts, ngrams
from termloom.sources.corpus import corpus_from_columns, corpus_from_rows


def brute_force(texts, longest, least):
    """By definition, over ``texts[docid]`` of one field."""
    found = {}
    for docid, text in texts.items():
        terms = text.split()
        for n in range(1, longest + 1):
            for i in range(len(terms) - n + 1):
                found.setdefault((n, " ".join(terms[i : i + n])), Counter())[docid] += 1
    return sorted((n, "b", term, len(c), c.total()) for (n, term), c in found.items() if c.total() >= least)


def corpus_of(spark, texts):
    return json_corpus(spark, [f'{{"docid":"{docid}","body":"{text}"}}' for docid, text in texts.items()])


@pytest.mark.parametrize("stretch", [4096, 3])
def test_against_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(ngrams, "STRETCH", stretch)
    rng = random.Random(stretch)
    # Few words, so that grams repeat and overlap; a text of one word, an empty one, a long run.
    texts = {f"d{i}": " ".join(rng.choices("ab", k=rng.randint(0, 25))) for i in range(12)}
    texts |= {"one": "c", "none": "", "run": "a " * 30}
    got = rows(frequent_ngrams(corpus_of(spark, texts), 4, 3))
    assert got == brute_force(texts, 4, 3)
    assert any(n == 4 for n, *_ in got)


def test_stops_where_nothing_is_frequent(spark):
    texts = {"x": "a b c", "y": "b a d"}
    assert rows(frequent_ngrams(corpus_of(spark, texts), 9, 2)) == [(1, "b", "a", 2, 2), (1, "b", "b", 2, 2)]
    assert rows(frequent_ngrams(corpus_of(spark, {"x": ""}), 3, 1)) == []
    with pytest.raises(ValueError):
        ngram_postings(corpus_of(spark, texts), 0, 1)


def by_postings(corpus, longest, least):
    """As it was before counts had their own way: the documents and occurrences of postings."""
    found = {}
    for row in ngram_postings(corpus, longest, least).collect():
        found.setdefault((row["n"], row["field"], row["term"]), []).append(row["tf"])
    return sorted((*key, len(tfs), sum(tfs)) for key, tfs in found.items())


@pytest.mark.parametrize("many", [0, 1, 1000])
def test_counts_of_repeated_docids_and_fields(spark, monkeypatch, many):
    """Small slices and buckets; no, one or most docids come several times."""
    monkeypatch.setattr(gram_counts, "SLICE_TERMS", 20)
    monkeypatch.setattr(gram_counts, "TERMS_PER_BUCKET", 30)
    monkeypatch.setattr(gram_counts, "MAX_BROADCAST_ROWS", 3)
    rng = random.Random(many)
    words = [["a", "b", "c", "é", "--", "x%d" % i] for i in range(40)]
    docids = [f"d{i // 2 if many > 1 else max(i, many)}" for i in range(40)]
    texts = [(docid, " ".join(rng.choices(some, k=rng.randint(0, 15))), rng.choice(["a b c", " ", None])) for docid, some in zip(docids, words)]
    df = spark.createDataFrame(texts, "id string, body string, title string").repartition(3)
    corpus = corpus_from_columns(df, "id", {"body": "b", "title": "t"})
    got = rows(frequent_ngrams(corpus, 5, 3))
    assert got == by_postings(corpus, 5, 3)
    assert {n for n, *_ in got} >= {1, 2, 3} and {field for _, field, *_ in got} == {"b", "t"}


def test_counts_of_many_rows_a_text(spark):
    turns = [(f"c{i // 3}", "user" if i % 2 else "system", "so it is so it is") for i in range(9)]
    corpus = corpus_from_rows(spark.createDataFrame(turns, "id string, role string, text string"), "id", "role", "text")
    assert rows(frequent_ngrams(corpus, 4, 4)) == by_postings(corpus, 4, 4)


def test_frequent_ngrams_writes_few_bytes(spark):
    """Places of grams took some 10 bytes a term; now the numbers of terms and counts are written."""
    rng = random.Random(1)
    texts = [(str(i), " ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(500))) for i in range(400)]
    corpus = corpus_from_columns(spark.createDataFrame(texts, "id string, body string").repartition(2), "id", {"body": "b"})
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(root.rglob("*.parquet"))
    assert frequent_ngrams(corpus, 4, 5).count() > 1000
    new = set(root.rglob("*.parquet")) - before
    assert new and sum(path.stat().st_size for path in new) < 3 * 400 * 500


def test_index_of_ngrams(spark, tmp_path):
    texts = {"x": "red fox den", "y": "red fox", "z": "fox red"}
    save_index(build_ngram_index(corpus_of(spark, texts), 2, 2), str(tmp_path / "index"))
    index = load_index(spark, str(tmp_path / "index"))
    params = {"b": PARAMS["b"]}
    assert [row["docid"] for row in search(index, ["red fox"], params).collect()] == ["y", "x"]
    assert rows(index.lengths) == [("b", "x", 3), ("b", "y", 2), ("b", "z", 2)]
    # Seldom grams are no terms.
    assert search(index, ["fox den"], params).collect() == []
