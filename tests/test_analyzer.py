import pytest
from pyspark.sql import functions as F

from termloom import analyzed_terms, chunk_count, tokenize

CASES = [
    ("Hello, World!  -- foo_bar 1st", ["hello", "world", "", "foobar", "1st"]),
    ("½ Ⅷ ² x²", ["½", "ⅷ", "²", "x²"]),
    ("İstanbul", ["istanbul"]),
    ("ΟΔΟΣ Σ ΑΣ.", ["οδος", "σ", "ας"]),
    ("a\u00a0b\u0085c\u2028d\u200be\u001cf", ["a", "b", "c", "def"]),
    ("e\u0301te caf\u00e9", ["ete", "caf\u00e9"]),
    ("हिन्दी", ["हिन्दी".replace("\u094d", "")]),
    ("Straße ẞ", ["straße", "ß"]),
    ("--", [""]),
    ("-- a --", ["", "a", ""]),
    (" \t\n lead and\u2003trail \u3000", ["lead", "and", "trail"]),
    ("", []),
    ("   ", []),
    ("\u00a0\t", []),
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(str(i), "f", text) for i, (text, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "docid string, field string, text string")


def test_terms_and_lengths(texts):
    rows = texts.select(
        "docid", analyzed_terms(F.col("text")).alias("t"), chunk_count(F.col("text")).alias("n")
    ).collect()
    got = {int(r["docid"]): (r["t"], r["n"]) for r in rows}
    assert got == {i: (terms, len(terms)) for i, (_, terms) in enumerate(CASES)}


def test_token_stream_keeps_empty_terms(texts):
    got = sorted((int(r["docid"]), r["term"]) for r in tokenize(texts).collect())
    assert got == sorted((i, t) for i, (_, terms) in enumerate(CASES) for t in terms)


def test_null_text_has_no_terms(spark):
    row = spark.range(1).select(analyzed_terms(F.lit(None).cast("string")).alias("t")).first()
    assert row["t"] is None


def test_a_text_is_analysed_once(texts):
    plan = tokenize(texts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 2
