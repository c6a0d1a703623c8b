import pytest
from conftest import GOLDEN, PARAMS, json_corpus
from test_index import REPEATED, hits, lengths, postings, rows

from termloom import append_index, build_index, compact_index, index_parts, load_parts, search


def appended(spark, tmp_path, parts, **options):
    path = str(tmp_path / "index")
    for i, lines in enumerate(parts):
        append_index(build_index(json_corpus(spark, lines)), path, shards=3, first=i == 0, **options)
    return path


def same_index(a, b):
    assert postings(a) == postings(b) and lengths(a) == lengths(b)
    assert rows(a.field_stats) == rows(b.field_stats)
    assert rows(a.corpus_stats.select("n_docs")) == rows(b.corpus_stats.select("n_docs"))


def test_three_parts_equal_one_build(spark, tmp_path, golden):
    path = appended(spark, tmp_path, [GOLDEN[:2], GOLDEN[2:3], GOLDEN[3:]])
    index = load_parts(spark, path)
    same_index(index, golden)
    # Nothing to add up, so folders of terms still prune.
    assert index.shards == 3
    assert dict(hits(search(index, ["fox", "red"], PARAMS))) == pytest.approx(dict(hits(search(golden, ["fox", "red"], PARAMS))))


@pytest.mark.parametrize("cuts", [(1, 2), (1, 3), (2, 3)])
def test_docids_in_several_parts_add_up(spark, tmp_path, cuts):
    a, b = cuts
    path = appended(spark, tmp_path, [REPEATED[:a], REPEATED[a:b], REPEATED[b:]])
    whole = build_index(json_corpus(spark, REPEATED))
    same_index(load_parts(spark, path), whole)
    compact_index(spark, path)
    index = load_parts(spark, path)
    same_index(index, whole)
    assert index.shards is not None and len(index_parts(spark, path)) == 1


def test_part_after_a_compaction(spark, tmp_path, golden):
    path = appended(spark, tmp_path, [GOLDEN[:1], GOLDEN[1:3]])
    compact_index(spark, path, shards=2)
    append_index(build_index(json_corpus(spark, GOLDEN[3:])), path)
    index = load_parts(spark, path)
    same_index(index, golden)
    assert index.shards == 2
    compact_index(spark, path, shards=5)
    same_index(load_parts(spark, path), golden)


def test_parts_of_different_shards(spark, tmp_path, golden):
    path = str(tmp_path / "index")
    append_index(build_index(json_corpus(spark, GOLDEN[:2])), path, shards=2, first=True)
    append_index(build_index(json_corpus(spark, GOLDEN[2:])), path, shards=5)
    index = load_parts(spark, path)
    same_index(index, golden)
    assert dict(hits(search(index, ["fox"], PARAMS))) == pytest.approx(dict(hits(search(golden, ["fox"], PARAMS))))


def test_refused_part_is_not_read(spark, tmp_path):
    path = appended(spark, tmp_path, [GOLDEN[:3]])
    again = build_index(json_corpus(spark, ['{"docid":"d2","extra":"x","body":"new"}', GOLDEN[4]]))
    with pytest.raises(ValueError, match="d2"):
        append_index(again, path, duplicates="error")
    same_index(load_parts(spark, path), build_index(json_corpus(spark, GOLDEN[:3])))
    with pytest.raises(ValueError, match="duplicates"):
        append_index(again, path, duplicates="some")


def test_fields_of_parts(spark, tmp_path, golden):
    # The last part has no title, the one before it nothing at all.
    path = appended(spark, tmp_path, [GOLDEN[:3], GOLDEN[4:], GOLDEN[3:4]])
    index = load_parts(spark, path, ["b"])
    assert postings(index) == [row for row in postings(golden) if row[0] == "b"]
    assert index.corpus_stats.first()["n_docs"] == 5
    with pytest.raises(ValueError, match="no fields"):
        load_parts(spark, path, ["zzz"])


def test_folders_of_parts_and_terms_prune(spark, tmp_path):
    path = appended(spark, tmp_path, [GOLDEN[:2], GOLDEN[2:]])
    compact_index(spark, path, shards=4)
    live = index_parts(spark, path)[0]["part"]
    plan = search(load_parts(spark, path), ["fox"], PARAMS)._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "tf#" in line]
    assert scans
    for scan in scans:
        pruned = scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
        assert live in pruned and "shard" in pruned and "field" in pruned
