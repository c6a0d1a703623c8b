import pytest
from pyspark.sql import functions as F
from conftest import ALIASES, json_corpus

from termloom import (
    build_index,
    corpus_from_columns,
    corpus_from_rows,
    parse_records,
    read_corpus,
    read_json_directory,
    read_json_lines,
    split_records,
    stage_records,
)
from termloom.sources.hidden_files import FilesReader, read_files

E17 = "é" * 17

# record text, docid and fields if accepted, or the reason it is refused.
CASES = [
    ('{"docid":"a","f":"x"}', ("a", {"f": "x"})),
    ('{"docid":"a"}', ("a", {})),
    ('{"docid":"a","f":""}', ("a", {"f": ""})),
    ('\n{ "docid" : "a" }\r\n ', ("a", {})),
    ('{"docid":"a","docid":"b"}', ("b", {})),
    ('{"docid":"a\\u0000"}', ("a", {})),
    ('{"docid":"' + "x" * 32 + '"}', ("x" * 32, {})),
    ('{"docid":"a","n":[{"m":[{}]} ]}', ("a", {})),
    ('{"docid":"a","other":1,"f":"[{}] {} ]"}', ("a", {"f": "[{}] {} ]"})),
    ("{'docid':'a'}", "bad_json"),
    ('{"docid":"a",}', "bad_json"),
    ('{"docid":"a"} x', "bad_json"),
    ('{"docid":"a"}{"docid":"b"}', "bad_json"),
    ('{"docid":"a"},{"docid":"b"}', "bad_json"),
    ('{"docid":"a"}] junk', "bad_json"),
    ('{"docid":"a"} ] junk', "bad_json"),
    ('{"docid":"a"}} junk', "bad_json"),
    ('{"docid":"a"},"r2":{}', "bad_json"),
    ('{"docid":NaN}', "bad_json"),
    ('{"docid":"a', "bad_json"),
    ("﻿" + '{"docid":"a"}', "bad_json"),
    ("", "bad_json"),
    ("  ", "bad_json"),
    ("1,2", "bad_json"),
    ("[1]] junk", "bad_json"),
    ("[1]", "docid_missing"),
    ('"s"', "docid_missing"),
    ("null", "docid_missing"),
    ('{"f":"x"}', "docid_missing"),
    ('{"Docid":"x"}', "docid_missing"),
    ('{"docid":"' + "x" * 33 + '"}', "docid_too_long"),
    ('{"docid":"' + E17 + '"}', "docid_too_long"),
    ('{"docid":1}', "docid_not_string"),
    ('{"docid":null}', "docid_not_string"),
    ('{"docid":"a","f":null}', "field_not_string"),
    ('{"docid":"a","f":3}', "field_not_string"),
    ('{"docid":"a","f":{"g":"h"}}', "field_not_string"),
    (b'{"docid":"a\xff"}', "bad_utf8"),
]


def outcome(row):
    return row["reason"] or (row["docid"], row["fields"])


def test_records(spark):
    rows = [
        (str(i), bytearray(t if isinstance(t, bytes) else t.encode()))
        for i, (t, _) in enumerate(CASES)
    ]
    records = spark.createDataFrame(rows, "path string, content binary")
    parsed = parse_records(records, {"f": "f"}).collect()
    got = {int(r["path"]): outcome(r) for r in parsed}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_keys_are_literal(spark):
    text = '{"docid":"a","x.y":"1","q\\"q":"2","s\'s":"3","b\\"\'":"4","]":"5","x":{"y":"no"}}'
    keys = {"x.y": "dot", 'q"q': "double", "s's": "single", "b\"'": "both", "]": "bracket"}
    records = spark.createDataFrame([("p", text)], "path string, content string")
    (row,) = parse_records(records, keys).collect()
    assert row["fields"] == {
        "dot": "1", "double": "2", "single": "3", "both": "4", "bracket": "5"
    }


def test_a_long_text_is_kept_whole(spark):
    n = 30 * 1024 * 1024
    records = spark.range(1).selectExpr(
        "'p' AS path", f"concat('{{\"docid\":\"a\",\"f\":\"', repeat('x', {n}), '\"}}') AS content"
    )
    (row,) = parse_records(records, {"f": "f"}).selectExpr("reason", "length(fields['f'])").collect()
    assert tuple(row) == (None, n)


def test_directory(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"docid":"a","title":"One","skip":"x"}')
    (tmp_path / "b.json").write_text('{"docid":"b","body":"Two words"}')
    (tmp_path / "bad.json").write_text("{")
    (tmp_path / "c.JSON").write_text('{"docid":"c"}')
    (tmp_path / "d.txt").write_text('{"docid":"d"}')
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.json").write_text('{"docid":"e"}')
    corpus = read_corpus(spark, str(tmp_path), ALIASES)
    assert sorted(r["docid"] for r in corpus.records.collect()) == ["a", "b"]
    assert sorted(tuple(r) for r in corpus.texts.collect()) == [
        ("a", "t", "One"),
        ("b", "b", "Two words"),
    ]
    (refused,) = corpus.quarantine.collect()
    assert refused["source"].endswith("bad.json") and refused["reason"] == "bad_json"
    with pytest.raises(ValueError, match="bad_json"):
        read_corpus(spark, str(tmp_path), ALIASES, mode="strict")


def test_hidden_names_are_read(spark, tmp_path):
    folder = tmp_path / "with blank"
    folder.mkdir()
    for name in ("a.json", "_u.json", ".h.json", "_c.txt", "_é %20,x.json", "_bad.JSON"):
        (folder / name).write_text('{"docid":"%s"}' % name[:2])
    (folder / "_none.json").write_text("")
    (folder / "none.json").write_text("")
    (folder / "_sub.json").mkdir()
    corpus = read_corpus(spark, str(folder), ALIASES)
    assert sorted(r["docid"] for r in corpus.records.collect()) == [".h", "_u", "_é", "a."]
    assert build_index(corpus).corpus_stats.first()["n_docs"] == 4
    refused = sorted((r["source"].rsplit("/", 1)[1], r["reason"]) for r in corpus.quarantine.collect())
    assert refused == [("_none.json", "bad_json"), ("none.json", "bad_json")]
    paths = {r["path"].rsplit("/", 1)[0] for r in read_json_directory(spark, str(folder)).select("path").collect()}
    assert len(paths) == 1


def test_only_hidden_names(spark, tmp_path):
    (tmp_path / "_u.json").write_text('{"docid":"u"}')
    assert [r["docid"] for r in read_corpus(spark, str(tmp_path), ALIASES).records.collect()] == ["u"]


def test_files_that_cannot_be_opened_are_quarantined(spark, tmp_path):
    gone = [(f"file:{tmp_path}/_gone.json", 3), ("nosuch://store/_x.json", 3)]
    assert [r["content"] for r in read_files(spark, gone).collect()] == [None, None]


def test_hidden_files_are_dealt_to_splits():
    files = [(f"f{i}", 1) for i in range(2500)] + [("big", 40 << 20), ("small", 1)]
    splits = FilesReader(files).partitions()
    assert [len(split.paths) for split in splits] == [1000, 1000, 500, 1, 1]


@pytest.mark.parametrize("table", [0, 1])
def test_each_record_is_parsed_once(spark, table):
    """No copy of a parse in a filter or another column, whatever is selected."""
    records = spark.createDataFrame([("p", '{"docid":"a","title":"x"}')], "path string, content string")
    df = split_records(parse_records(records, ALIASES))[table]
    written = parse_records(records, ALIASES)._jdf.queryExecution().analyzed().toString().count("from_json")
    for part in (df, df.groupBy().count(), df.select(df.columns[0])):
        assert part._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= written == 4


def test_a_huge_value_of_another_key_does_not_matter(spark):
    # A variant of the whole record could not hold so much.
    huge = F.repeat(F.lit("x"), 135 * 1024 * 1024)
    content = F.concat(F.lit('{"docid":"a","other":["'), huge, F.lit('"],"title":"red"}')).cast("binary")
    records = spark.range(1).select(F.lit("p").alias("path"), content.alias("content"))
    (row,) = parse_records(records, ALIASES).collect()
    assert (row["docid"], row["fields"], row["reason"]) == ("a", {"t": "red"}, None)


def test_json_is_parsed_once_when_staged(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"docid":"a"}\n{"docid":1}\n')
    parsed = stage_records(parse_records(read_json_lines(spark, str(tmp_path)), {"f": "f"}))
    docs, refused = split_records(parsed)
    for table in (docs, refused):
        assert "from_json" not in table._jdf.queryExecution().optimizedPlan().toString()
    assert docs.count() == 1 and [r["reason"] for r in refused.collect()] == ["docid_not_string"]


def test_lines_keep_their_bytes(spark, tmp_path):
    (tmp_path / "x.jsonl").write_bytes(b'{"docid":"a\xff"}\n{"docid":"\xc3\xa9"}\n')
    parsed = parse_records(read_json_lines(spark, str(tmp_path)), {"f": "f"}).collect()
    assert sorted((r["docid"] or "", r["reason"] or "") for r in parsed) == [
        ("", "bad_utf8"),
        ("é", ""),
    ]


def test_columns(spark):
    rows = [("a", "x", None), ("b", None, None), (None, "x", "y"), ("c" * 33, "x", "y")]
    df = spark.createDataFrame(rows, "id string, t string, b string")
    corpus = corpus_from_columns(df, "id", {"t": "title", "b": "body"})
    assert [tuple(r) for r in corpus.texts.collect()] == [("a", "title", "x")]
    assert sorted(r["docid"] for r in corpus.records.collect()) == ["a", "b"]
    assert sorted(r["reason"] for r in corpus.quarantine.collect()) == [
        "docid_missing",
        "docid_too_long",
    ]


def test_rows(spark):
    rows = [(1, "t", "x y"), (1, "t", "z"), (1, "b", None), (2, "t", "")]
    df = spark.createDataFrame(rows, "id int, role string, say string")
    index = build_index(corpus_from_rows(df, "id", "role", "say"))
    assert sorted((r["docid"], r["field"], r["len"]) for r in index.lengths.collect()) == [
        ("1", "t", 3),
        ("2", "t", 0),
    ]
    assert index.corpus_stats.first()["n_docs"] == 2


def test_aliases_are_checked(spark):
    records = spark.createDataFrame([("p", "{}")], "path string, content string")
    for aliases, message in (({"a": "x", "b": "x"}, "same index field"), ({}, "at least one")):
        with pytest.raises(ValueError, match=message):
            parse_records(records, aliases)


def test_empty_directory(spark, tmp_path):
    assert read_json_directory(spark, str(tmp_path)).count() == 0


def test_corpus_without_any_field(spark):
    index = build_index(json_corpus(spark, ['{"docid":"a"}']))
    assert index.corpus_stats.first()["n_docs"] == 1
    assert index.field_stats.count() == 0
