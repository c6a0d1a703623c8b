"""Near and matching terms against plain comparison of all pairs."""

import fnmatch
import random

import pytest

from termloom import build_index, corpus_from_columns, field_params, fuzzy_terms, pattern_terms, search_batch
from termloom.operators.expand import deletion_table, gram_table, matching_terms, near_terms

PARAMS = field_params({"a": 1.0}, {"a": 1.2}, {"a": 0.75})


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@pytest.fixture(scope="module")
def words():
    rnd = random.Random(2)
    found = {"".join(rnd.choices("abñ", [5, 4, 1], k=rnd.randint(0, 14))) for _ in range(350)}
    for word in list(found)[:120]:
        cut = rnd.randint(0, len(word))
        found |= {word[:cut] + rnd.choice("aé日") + word[cut:], word[:cut] + word[cut + 2 :], word + "ab" * 20}
    return sorted(found | {"", "a", "日本", "x" * 500, "x" * 499 + "y"})


def table_of(spark, words, name="term"):
    return spark.createDataFrame([(word,) for word in [*words, None]], f"{name} string")


@pytest.mark.parametrize("d", [0, 1, 2])
def test_near_terms(spark, words, d):
    rnd = random.Random(d)
    asked = rnd.sample(words, 60) + ["", "ab", "x" * 500, "nothing like it"]
    vocabulary = table_of(spark, words).where("term IS NOT NULL")
    found = near_terms(table_of(spark, asked, "asked"), deletion_table(vocabulary, d), d)
    want = sorted((a, w, distance(a, w)) for a in set(asked) for w in words if abs(len(a) - len(w)) <= d and distance(a, w) <= d)
    assert sorted(map(tuple, found.select("asked", "term", "distance").collect())) == want
    assert len(want) >= 60


def test_distance_is_checked(spark, words):
    with pytest.raises(ValueError, match="distance"):
        near_terms(table_of(spark, ["a"], "asked"), deletion_table(table_of(spark, words), 1), 3)


def test_matching_terms(spark, words):
    patterns = ["a*", "*a", "*ab*ba*", "a?b*", "??", "*", "", "?", "ñ*", "*日*", "ab", "a*b", "*ñ?a", "nothing*", "*xxx*y",
                "a.*", "(", "b\\E*"]
    vocabulary = table_of(spark, [*words, "b\\Ex", "a.b", "("]).where("term IS NOT NULL")
    found = matching_terms(table_of(spark, patterns, "pattern"), gram_table(vocabulary))
    want = sorted(
        (p, w) for p in patterns for w in [*words, "b\\Ex", "a.b", "("] if fnmatch.fnmatchcase(w, p)
    )
    assert sorted(map(tuple, found.select("pattern", "term").collect())) == want


@pytest.fixture(scope="module")
def index(spark):
    rows = [(1, "color of the house"), (2, "colour of a horse"), (3, "colors, houses"), (4, "cool hose"), (5, None)]
    return build_index(corpus_from_columns(spark.createDataFrame(rows, "id int, t string"), "id", {"t": "a"}))


def hits(index, query):
    return {(r["query_id"], r["docid"]): round(r["score"], 9) for r in search_batch(index, query, PARAMS, 10).collect()}


def query(spark, rows):
    return spark.createDataFrame(rows, "query_id int, term string")


def test_fuzzy_search(spark, index):
    from termloom import query_terms

    got = hits(index, fuzzy_terms(index, query(spark, [(1, "color"), (1, "hose"), (2, "zzz"), (3, None)])))
    # The expanded bag, written out: "hose" is near hose, horse and house.
    bag = [(1, t) for t in ("color", "colour", "colors", "hose", "house", "horse")]
    assert got == hits(index, query_terms(query(spark, bag))) and len(got) == 4


def test_pattern_search(spark, index):
    from termloom import query_terms

    got = hits(index, pattern_terms(index, query(spark, [(1, "col*"), (1, "h?use"), (1, "colo?"), (2, "q*")])))
    bag = [(1, t) for t in ("color", "colour", "colors", "house", "color")]
    assert got == hits(index, query_terms(query(spark, bag))) and len(got) == 3
