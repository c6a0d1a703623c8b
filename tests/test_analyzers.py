import pytest
from conftest import PARAMS, json_corpus
from test_index import rows

from termloom import (
    append_index,
    build_index,
    load_index,
    load_parts,
    merge_indexes,
    query_terms_from_texts,
    save_index,
    search,
    search_batch,
    search_text,
    word_parts,
)

LINES = ['{"docid":"a","title":"re-use the CITIES","body":"-- !"}', '{"docid":"b","title":"the the","body":"http://a.b/dogs"}']
PARTS = word_parts(["the"], plurals=True)


def terms_of(spark, text, analyzer):
    table = spark.createDataFrame([(text,)], "text string")
    return table.select(analyzer.terms(table.text)).first()[0]


def test_word_parts(spark):
    assert terms_of(spark, "Re-use\tof http://x.y/Ä9?  ", word_parts()) == ["re", "use", "of", "http", "x", "y", "ä9"]
    assert terms_of(spark, " -- ", word_parts()) == [] and terms_of(spark, "", word_parts()) == []
    assert terms_of(spark, None, word_parts()) is None


def test_plurals(spark):
    singular = {
        "cities": "city", "zombies": "zomby", "eies": "eies", "aies": "aies", "boxes": "boxe", "shoes": "shoes",
        "trees": "trees", "dogs": "dog", "bus": "bus", "class": "class", "s": "s", "es": "e", "ies": "y",
    }
    assert terms_of(spark, " ".join(singular), word_parts(plurals=True)) == list(singular.values())


def test_index_of_another_analyzer(spark, tmp_path):
    built = build_index(json_corpus(spark, LINES), analyzer=PARTS)
    want = [
        ("b", "a", "b", 1, 4), ("b", "b", "b", 1, 4), ("b", "dog", "b", 1, 4), ("b", "http", "b", 1, 4),
        ("t", "city", "a", 1, 3), ("t", "re", "a", 1, 3), ("t", "use", "a", 1, 3),
    ]
    assert rows(built.postings.select("field", "term", "docid", "tf", "len")) == want
    # A field whose terms are all left out is there, with no length.
    assert rows(built.lengths.select("field", "docid", "len")) == [("b", "a", 0), ("b", "b", 4), ("t", "a", 3), ("t", "b", 0)]
    save_index(built, str(tmp_path / "index"))
    append_index(built, str(tmp_path / "parts"), first=True)
    queries = spark.createDataFrame([(1, "The city; a dog?")], "id int, text string")
    for index in (built, load_index(spark, str(tmp_path / "index")), load_parts(spark, str(tmp_path / "parts"))):
        assert index.analyzer == PARTS.label == "parts+plurals-[the]/1"
        best = search_batch(index, query_terms_from_texts(queries, "id", "text", PARTS), PARAMS, k=2)
        assert {row["docid"] for row in best.collect()} == {"a", "b"}
        with pytest.raises(ValueError, match="analyzer"):
            search_batch(index, query_terms_from_texts(queries, "id", "text"), PARAMS, k=2)
        with pytest.raises(ValueError, match="analyzer"):
            search_text(index, "city", PARAMS)
    assert [row["docid"] for row in search_text(built, "Cities", PARAMS, analyzer=PARTS).collect()] == ["a"]
    # Tokens are looked up as they are, whatever the analyzer.
    assert [row["docid"] for row in search(built, ["city"], PARAMS).collect()] == ["a"]


def test_analyzers_do_not_mix(spark, tmp_path):
    parts, words = (build_index(json_corpus(spark, LINES), analyzer=a) for a in (PARTS, word_parts()))
    with pytest.raises(ValueError, match="analyzer"):
        merge_indexes(parts, words)
    append_index(parts, str(tmp_path / "parts"), first=True)
    with pytest.raises(ValueError, match="analyzer"):
        append_index(words, str(tmp_path / "parts"))
