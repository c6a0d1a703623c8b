"""Small and odd inputs of every operator, and each kernel against brute force."""

import hashlib
import itertools
import json
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from termloom.llm import common, fingerprint, gru, language, lm, minhash, packing, repeats, sampling, shards, topk, toxicity
from termloom.llm.common import documents, tokenizer_path
from termloom.llm.graph import components
from termloom.llm.words import shingle_sets

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "the quick brown fox jumps over the lazy dog and runs far away from here " * 30

#: Null ids and texts, empty texts, white space, ties, repeated rows, a long text.
ODD = [
    (1, "The red fox sat on the warm mat today", "en", "s", 37),
    (2, "The red fox sat on the warm mat today", "en", "s", 37),
    (2, "The red fox sat on the warm mat today", "en", "s", 37),
    (3, None, "en", None, None),
    (4, "", None, "s", 0),
    (5, " \t\n ", "en", "s", 4),
    (None, "A text without an id but with words enough", "en", "s", 42),
    (None, None, None, None, None),
    (6, "... 123 !!!", "de", "s", 11),
    (7, LONG, "en", "s", len(LONG)),
    (8, "x" * 5000, "en", "s", 5000),
    (9, "Ünï ▁ cødé 日本語 \U0001f600 á \x00 end", "fr", "s", 30),
    (10, "word", "de", "s", 4),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(odd):
    """Extra columns with the names that operators use inside."""
    names = ["class", "band", "bands", "part", "record", "ref", "first", "n", "score", "lang_pred", "root", "slot",
             "bucket", "kind", "word", "slice", "text_bytes", "place", "runs", "block", "component_id", "left"]
    return odd.withColumns({name: F.lit("clash") for name in names})


def rows(df):
    return [tuple(row) for row in df.collect()]


def by_id(df, *names):
    return sorted((tuple(r[n] for n in ("doc_id", *names)) for r in df.collect()), key=repr)


# --- 1 ----------------------------------------------------------------------


def test_lm_odd_rows_and_base_scores(odd, clashing):
    found = rows(lm.score_documents(odd))
    assert len(found) == len(ODD)
    tokens, n_texts = Counter(), 0
    for doc_id, text, *_ in ODD:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10:
            tokens.update((text or "").encode().lower().split())
            n_texts += 1
    total, distinct = sum(tokens.values()) + n_texts, len(tokens) + 1
    base = lambda c: math.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
    want = []
    for doc_id, text, *_ in ODD:
        words = (text or "").encode().lower().split()
        held = None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 10 == 0
        score = round(sum(base(tokens[w]) for w in words) + base(n_texts), 6)
        want.append((doc_id, held, len(words) + 1, sum(tokens[w] > 0 for w in words) + 1, total, score))
    assert sorted(((*r[:5], round(r[5], 6)) for r in found), key=repr) == sorted(want, key=repr)
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in found)
    assert len(rows(lm.score_documents(clashing))) == len(ODD)


def test_lm_empty_table(none):
    assert rows(lm.score_documents(none)) == []


def test_lm_probabilities_add_up_and_state_is_carried():
    shape = gru.Shape(70, 3)
    model = gru.Model(shape, gru.first_weights(shape, np.full(shape.n_classes, 1.0), np.full(70, 1.0)))
    rng = np.random.default_rng(0)
    state = rng.normal(size=(1, gru.HIDDEN)).astype(np.float32)
    every = np.arange(shape.n_tokens)
    logs = model.log_probabilities(np.repeat(state, len(every), 0), every)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)
    # Any mix of lengths and lanes scores a text as it is scored alone, step by step.
    texts = [rng.integers(0, shape.n_tokens, n).astype(np.int32) for n in (1, 5, 100, 33, 64, 2)]
    scores = model.score(texts)
    for text, score in zip(texts, scores):
        h, total, before = np.zeros((1, gru.HIDDEN), np.float32), 0.0, 0
        for token in text:
            h = model._step(np.array([before]), h)[0]
            total += float(model.log_probabilities(h, np.array([token]))[0])
            before = token
        assert score == pytest.approx(total, rel=1e-4)


def test_lm_gradient_by_differences():
    shape = gru.Shape(40, 2)
    rng = np.random.default_rng(1)
    start = gru.first_weights(shape, np.full(shape.n_classes, 1.0), np.full(40, 1.0)).astype(np.float32)
    text = [rng.integers(0, shape.n_tokens, gru.TRAIN_STEPS).astype(np.int32)]
    loss = lambda w: -float(gru.Model(shape, w).score(text)[0])
    model = gru.Model(shape, start)
    model.train(text, rate=1.0)
    step = model.weights - start
    moved = np.flatnonzero(np.abs(step) > 1e-4)
    for i in rng.choice(moved, 12, replace=False):
        up, down = start.copy(), start.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        slope = (loss(up) - loss(down)) / 2e-2 / gru.TRAIN_LANES
        assert -step[i] == pytest.approx(slope / math.sqrt(0.05 + slope * slope), rel=0.1, abs=2e-3)


def test_lm_training_lowers_the_loss():
    shape = gru.Shape(40, 2)
    texts = [np.array([1, 2, 3, 4] * 20 + [0], np.int32)] * 50
    model = gru.Model(shape, gru.first_weights(shape, np.full(shape.n_classes, 1.0), np.full(40, 1.0)))
    before = model.score(texts[:1])[0]
    for _ in range(5):
        model.train(texts)
    assert model.score(texts[:1])[0] > 0.7 * before


def test_lm_learns_from_every_training_token(spark):
    docs = [(i, " ".join(f"w{(i * j) % 97}" for j in range(i % 40))) for i in range(300)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 10 == 0}
    learned = []
    vocab = lm.Vocabulary({b"w1": 5}, {}, 1, 10, 2)
    for row in lm._slices(table, 2000, 4).collect():
        learned += [len(text) for text in lm.lessons(row.asDict(), vocab)]
    assert sorted(learned) == sorted(len(text.split()) + 1 for i, text in docs if i not in held)
    assert lm.FREQUENT >= 3072


def test_lm_rounds_and_words_grow_with_the_corpus(spark, monkeypatch):
    assert [lm.round_count(n * 100, 100) for n in (0, 1, 2, 4, 5, 49, 3000)] == [1, 1, 2, 2, 3, 7, 55]
    docs = spark.createDataFrame([(i, "a b c d " * 40) for i in range(100)], "doc_id bigint, text string").coalesce(1)
    slices = lm._slices(docs, 1000, 4).select("slice", "round").collect()
    per_round = Counter(row["round"] for row in slices)
    assert sorted(per_round) == [0, 1, 2, 3] and max(per_round.values()) <= min(per_round.values()) + 1
    # All rounds run, and each starts from what the one before came to.
    starts, trained = [], lm._trained

    def watched(slices, vocab, weights, squares):
        starts.append((slices.count(), weights, squares))
        return trained(slices, vocab, weights, squares)

    monkeypatch.setattr(lm, "_trained", watched)
    lm.score_documents(docs, 1000)
    assert len(starts) == lm.round_count(100 * 320, 1000) == 6
    assert sum(n for n, _, _ in starts) == len(slices)
    assert all((a[2] <= b[2]).all() and (a[1] != b[1]).any() for a, b in zip(starts, starts[1:]))
    # Beyond the least number, the counts decide which words have an output.
    monkeypatch.setattr(lm, "FREQUENT", 2)
    words = [(f"w{i}", 1000 // (i + 1), []) for i in range(200)]
    vocab = lm.vocabulary(spark.createDataFrame(words, "word string, c bigint, slices array<bigint>"), 10)
    total = sum(c for _, c, _ in words)
    assert vocab.shape.n_frequent == sum(c >= 0.25 * math.sqrt(total) for _, c, _ in words) > 2


def test_lm_cuts_texts_into_words_once(spark, monkeypatch):
    texts = [None, "", "  ", " B\x0ba  a\n", "É \x1c \xa0 a\x00b", "b\t", "x y a"]
    for some in (texts, texts[1:3], texts[6:], []):
        encoded = [(text or "").encode().lower() for text in some]
        numbers, words, sizes = common.words_of(encoded)
        split = [[words[i] for i in part] for part in np.split(numbers, np.cumsum(sizes)[:-1])] if some else []
        assert split == [lm.tokens_of(text) for text in encoded]
        assert len(words) == len(set(words).intersection(*[{word for text in split for word in text}]))
    # Slices hold each word once, and counting, training and scoring do not cut texts again.
    table = spark.createDataFrame([(i, f"a b{i} a c " * 50) for i in range(1, 40)], "doc_id bigint, text string").coalesce(1)
    (row,) = lm._slices(table, 1 << 20, 1).collect()
    assert sorted(lm._words(row.asDict())) == sorted({b"a", b"c"} | {b"b%d" % i for i in range(1, 40)})
    counts = {r["word"]: (r["c"], [tuple(at) for at in r["slices"]]) for r in lm.word_counts(lm._slices(table, 1 << 20, 1)).collect()}
    n_training = sum(zlib.crc32(str(i).encode()) % 10 > 0 for i in range(1, 40))
    assert counts["a"][0] == 100 * n_training and counts["c"][0] == 50 * n_training
    words = lm._words(row.asDict())
    assert all(words[number] == word.encode() for word, (_, places) in counts.items() for _, number in places)


def test_lm_word_classes_in_tiles_have_the_slopes_of_single_rows():
    # One class has many tiles, one a part of a tile, one none.
    shape = gru.Shape(90, 2)
    model = gru.Model(shape, gru.first_weights(shape, np.full(shape.n_classes, 1.0), np.full(90, 1.0)))
    rng = np.random.default_rng(2)
    targets = np.concatenate([rng.integers(1, 33, 100), rng.integers(65, 91, 5), [0, 91, 92]])
    rng.shuffle(targets)
    rows, place, lie, tiles = model._by_word_class(targets)
    assert sorted(targets[rows]) == sorted(t for t in targets if 0 < t <= 90)
    assert tiles.tolist() == [0] * 7 + [2] and len(set(lie.tolist())) == len(rows)
    assert (tiles[lie // gru.TILE] * shape.class_size + place + 1 == targets[rows]).all()
    states = rng.normal(size=(len(rows), gru.HIDDEN + 1)).astype(np.float32)
    states[:, -1] = 1
    tiled, logits = model._within(states, lie, tiles)
    for state, at in zip(states, lie):
        number = tiles[at // gru.TILE]
        want = state[:-1] @ model.parts[4][number] + model.parts[5][number]
        assert np.allclose(logits.reshape(-1, shape.class_size)[at], want, atol=1e-5)
    assert not tiled.reshape(-1, gru.HIDDEN + 1)[np.setdiff1d(np.arange(8 * gru.TILE), lie)].any()
    # Numbers beyond the range of exponentials keep their shares.
    for axis in (0, 1):
        big = np.array([[1000.0, 999.0], [0.0, -1000.0]], np.float32)
        shares = gru._probabilities(big.copy(), axis)
        assert np.isfinite(shares).all() and np.allclose(shares.sum(axis=axis), 1)


def test_lm_counts_move_in_buckets_and_by_slice(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)] + ["x", "É", "é", "日本", "y" * 300]
    docs = [(i, " ".join(words[(i * j) % 405] for j in range(i % 90))) for i in range(300)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    slices = common.shared_table(lm._slices(table, 2000, 4), "slices")
    of_slice = {row["slice"]: row.asDict() for row in slices.collect()}
    want, held = Counter(), {}
    for number, row in of_slice.items():
        own, (numbers, ends) = lm._words(row), lm._numbers(row)
        held[number] = len(own)
        for mark, text in zip(row["marks"], np.split(numbers, ends[:-1])):
            for i in text.tolist():
                want[own[i].decode()] += mark == 1
    for buckets in (1, 7, 1000):
        counts = common.shared_table(lm.word_counts(slices, buckets), "counts")
        assert {row["word"]: row["c"] for row in counts.collect()} == dict(want)
        # A slice gets rows of many counts back, and each of its words once.
        for pairs in (50, 1 << 20):
            monkeypatch.setattr(lm, "_PAIRS", pairs)
            rows_back = lm._by_slice(counts).collect()
            assert len(rows_back) < sum(held.values())
            got = {number: {} for number in of_slice}
            for row in rows_back:
                at, c = np.frombuffer(row["places"], np.int32).tolist(), np.frombuffer(row["c"], np.int64).tolist()
                assert not set(at) & set(got[row["slice"]])
                got[row["slice"]].update(zip(at, c))
            for number, row in of_slice.items():
                assert [got[number][i] for i in range(held[number])] == [want[word.decode()] for word in lm._words(row)]


def test_lm_words_become_tokens_at_once(spark):
    words = [b"a", b"b", b"abc", b"xbc", "É".encode(), "日本".encode(), b"\x00", b"q\x1c"]
    assert lm.rare_classes(words).tolist() == [lm.rare_class(word) for word in words]
    assert lm.rare_classes([]).tolist() == []
    vocab = lm.Vocabulary({b"abc": 5, b"b": 2}, {}, 1, 10, 2)
    want = [vocab.token.get(word) or 3 + lm.rare_class(word) for word in words]
    assert vocab.model_tokens(words).tolist() == want
    # Sums of the classes leave out words with outputs of their own.
    counts = spark.createDataFrame([(word.decode(), i, []) for i, word in enumerate(words)], "word string, c bigint, slices array<bigint>")
    vocab = lm.vocabulary(counts, 3)
    assert len(vocab.frequent) == len(words) - 1 and vocab.total == 28 + 3 and vocab.distinct == len(words)
    assert not vocab.rare_sum.any() and not vocab.rare_distinct.any()


def test_lm_sums_of_rare_words_by_class(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 3)
    monkeypatch.setattr(lm, "FREQUENT_ROOT", 100)
    words = ["a", "b", "ab", "cab", "É", "日本"] + [f"w{i}" for i in range(60)]
    counts = [(word, (i * 7) % 11, []) for i, word in enumerate(words)]
    vocab = lm.vocabulary(spark.createDataFrame(counts, "word string, c bigint, slices array<bigint>"), 1)
    sums = np.zeros((2, lm.RARE_CLASSES))
    for word, c, _ in counts:
        if c and word.encode() not in vocab.frequent:
            sums[:, lm.rare_class(word.encode())] += (c, 1)
    assert vocab.rare_sum.tolist() == sums[0].tolist() and vocab.rare_distinct.tolist() == sums[1].tolist()


def test_lm_slopes_of_inputs_are_added_up():
    rng = np.random.default_rng(3)
    for n, size in ((5, 0), (5, 40), (300, 200), (1 << 17, 50)):
        numbers, rows_ = rng.integers(0, n, size), rng.normal(size=(size, 6)).astype(np.float32)
        met, sums = gru._added_up(numbers, rows_, n)
        assert met.tolist() == sorted(set(numbers.tolist()))
        for number, found in zip(met, sums):
            assert np.allclose(found, rows_[numbers == number].sum(axis=0), atol=1e-4)


def test_lm_trains_on_whole_texts_with_the_state_carried(spark, monkeypatch):
    docs = [(i, f"first{i} " + f"inner{i} " * ((i * 7) % 300)) for i in range(1, 200)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    firsts = [f"first{i}".encode() for i, _ in docs]
    vocab = lm.Vocabulary(dict.fromkeys(firsts, 1), {}, 199, 500, 400)
    (row,) = lm._slices(table, 1 << 20, 1).collect()
    texts = lm.lessons(row.asDict(), vocab)
    n_training = sum(zlib.crc32(str(i).encode()) % 10 > 0 for i, _ in docs)
    windows, window = [], gru.Model._train_window

    def watched(self, token, target, state, *rest):
        windows.append((token.copy(), target.copy(), state.copy()))
        return window(self, token, target, state, *rest)

    monkeypatch.setattr(gru.Model, "_train_window", watched)
    model = gru.Model(vocab.shape, vocab.first_weights())
    assert model.train(texts) == sum(map(len, texts)) == sum(
        len(text.split()) + 1 for i, text in docs if zlib.crc32(str(i).encode()) % 10
    )
    # Every text begins once, with its own first word; no other word begins a text.
    begun = np.concatenate([target[token < 0] for token, target, _ in windows])
    assert len(begun) == n_training and set(begun.tolist()) <= set(range(1, vocab.shape.n_frequent + 1))
    assert len(windows) > 5 and all(np.abs(state).max(axis=1).min() > 0 for _, _, state in windows[1:])


# --- 2 ----------------------------------------------------------------------


def removed_by_brute_force(texts):
    counts = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    found = []
    for text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - 199):
            if counts[text[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found.append((len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def test_repeats_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (40, 60, 90, 300)]
    texts = [prose(rng.randint(1, 80)) for _ in range(40)]
    for _ in range(60):
        parts = [prose(rng.randint(0, 40)), rng.choice(shared), prose(rng.randint(0, 40))]
        if rng.random() < 0.5:
            cut = rng.randint(0, 60)
            parts[1] = parts[1][cut : len(parts[1]) - rng.randint(0, 60)]
        texts.append("".join(parts))
    texts += ["ab" * 400, "ab" * 300 + "c", "x" * 1000, "x" * 199, "x" * 200, texts[0], "é" * 150, "é" * 100]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = removed_by_brute_force([t.encode() for t in texts])
    assert by_id(repeats.remove_repeats(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(
        ((i, *w) for i, w in enumerate(want)), key=repr
    )


def test_repeats_odd_rows(odd, none, clashing):
    found = rows(repeats.remove_repeats(odd))
    want = removed_by_brute_force([(text or "").encode() for _, text, *_ in ODD])
    assert sorted(r[1:] for r in found) == sorted(want)
    assert rows(repeats.remove_repeats(none)) == []
    assert len(rows(repeats.remove_repeats(clashing))) == len(ODD)


def test_repeats_in_whole_characters():
    text = ("é" * 150).encode()
    kept, removed, _ = repeats.kept_bytes(text, [(1, 1)], True)
    assert kept.decode() == "é" * (150 - removed // 2) and removed == 198
    assert repeats.kept_bytes(text, [(1, 1)])[1] == 200


def test_segments_cover_every_place_once():
    rng = np.random.default_rng(2)
    for raw in (rng.integers(0, 4, 3000), np.zeros(700), rng.integers(0, 2, 199), np.tile([1, 2, 3], 400)):
        _, _, first, n, behind = repeats.segments(raw.astype(np.uint8))
        places = [p for f, k in zip(first, n) for p in range(f, f + k)]
        assert places == list(range(max(0, len(raw) - 199)))
        assert all(0 <= k - 1 <= b < repeats.WINDOW for k, b in zip(n, behind))


# --- 3 ----------------------------------------------------------------------


def test_shards_hold_every_row_once(spark):
    docs = spark.range(0, 5003).select(F.col("id").alias("doc_id"), F.lit("a text of some bytes").alias("text"))
    found = rows(shards.shuffle_to_shards(docs, "doc_id", F.lit(28), bucket_bytes=20_000).select("record.doc_id", "shard", "slot"))
    assert sorted(r[0] for r in found) == list(range(5003))
    sizes = Counter(r[1] for r in found)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r[2] for r in found if r[1] == shard) == list(range(n))
    again = rows(shards.shuffle_to_shards(docs, "doc_id", F.lit(28), bucket_bytes=20_000).select("record.doc_id", "shard", "slot"))
    assert sorted(found) == sorted(again)
    order = [r[0] for r in sorted(found, key=lambda r: (r[2], r[1]))]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.1


def test_shards_split_repeated_rows(spark):
    docs = spark.range(0, 3000).select(F.lit(7).alias("doc_id"), F.lit("same").alias("text"))
    sharded = shards.shuffle_to_shards(docs, "doc_id", F.lit(12), bucket_bytes=3000)
    per_task = sharded.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_task) < 1500


def test_shards_odd_rows(odd, none, clashing, tmp_path):
    found = rows(shards.shuffle_to_shards(odd, "doc_id", F.lit(1)).select("record.doc_id", "shard", "slot"))
    assert len(found) == len(ODD) and len({r[1:] for r in found}) == len(ODD)
    assert rows(shards.shuffle_to_shards(none, "doc_id", F.lit(1))) == []
    sharded = shards.shuffle_to_shards(clashing, "doc_id", F.lit(1))
    assert sorted(sharded.select("record.*").columns) == sorted(clashing.columns)
    shards.write_shards(sharded, str(tmp_path / "shards"))
    assert len(list((tmp_path / "shards").glob("shard=*"))) == len(ODD)


def test_fisher_yates_is_uniform():
    counts = Counter(tuple(shards.fisher_yates(3, np.random.default_rng(i)).tolist()) for i in range(3000))
    assert len(counts) == 6 and min(counts.values()) > 400


def test_rows_that_share_a_key_have_one_order(spark):
    df = spark.range(3000, numPartitions=3).select(F.lit(None).cast("long").alias("k"), F.col("id"), F.lit("x").alias("at"))
    found = []
    for turn in range(2):
        # The exchange may meet the rows in another order of tasks each time.
        sharded = shards.shuffle_to_shards(df, "k", F.lit(8), n_shards=7, bucket_bytes=4096, spread=1)
        found.append(sorted((r["shard"], r["slot"], r["record"]["id"]) for r in sharded.collect()))
    assert found[0] == found[1]
    assert [(shard, slot) for shard, slot, _ in found[0]] == sorted((p % 7, p // 7) for p in range(3000))
    plan = sharded._jdf.queryExecution().optimizedPlan().toString()
    order = next(line for line in plan.splitlines() if "Sort [" in line)
    assert order.count("ASC") == 3 and "at#" in order
    assert sorted(i for _, _, i in found[0]) == list(range(3000))


# --- 4 ----------------------------------------------------------------------


def groups_by_brute_force(texts):
    def shingles(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())

    sets = [shingles(text) for text in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [(i, len(sets[i]), find(i), find(i) == i) for i in range(len(texts))]


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    prose = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    texts = [" ".join(prose(rng.randint(1, 40))) for _ in range(20)]
    for n in (20, 60, 150):
        base = prose(n)
        for _ in range(120):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, n // 12))):
                copy[rng.randrange(n)] = rng.choice(prose(1))
            texts.append(" ".join(copy))
    texts += [texts[0], texts[0].upper(), "", "  "]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = by_id(minhash.near_duplicates(docs), "n_shingles", "component_id", "kept")
    assert found == sorted(groups_by_brute_force(texts), key=repr)


def test_near_duplicates_odd_rows(odd, none, clashing):
    found = by_id(minhash.near_duplicates(odd), "n_shingles", "component_id", "kept")
    assert (2, 5, 1, False) in found and (1, 5, 1, True) in found and len(found) == len(ODD)
    assert (3, 0, 3, True) in found and (5, 0, 5, True) in found and (None, 0, None, None) in found
    assert rows(minhash.near_duplicates(none)) == []
    assert by_id(minhash.near_duplicates(clashing), "component_id") == sorted(((r[0], r[2]) for r in found), key=repr)


def test_circulant_signature_by_definition():
    scatter, shifted = minhash._circle()
    values = shifted[:, 0]
    shingles = shingle_sets([LONG.encode()])[0]
    places = scatter[(shingles >> np.uint64(44)).astype(int)]
    want = [min(int(values[(p + k) % len(values)]) for p in places) for k in range(minhash.COORDINATES)]
    assert minhash.signature(shingles).tolist() == want


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(6)
    shared = rng.integers(0, 2**64, 600, np.uint64)
    a, b = shared[:500], shared[100:]
    agree = (minhash.signature(np.sort(a)) == minhash.signature(np.sort(b))).mean()
    assert agree == pytest.approx(400 / 600, abs=0.1)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (201, 200), (200, 201)]
    found = dict(rows(components(spark.createDataFrame(links, "a bigint, b bigint"))))
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 150))
    assert found[200] == found[201] == 200
    assert rows(components(spark.createDataFrame([], "a bigint, b bigint"))) == []


# --- 5 ----------------------------------------------------------------------


def test_fingerprints_of_edits_by_brute_force(spark, odd):
    texts = {i: f"text number {i} " + "é and more words " * (i % 7) for i in range(300)}
    texts[5], texts[6], texts[7] = None, "", texts[8]
    docs = spark.createDataFrame(sorted(texts.items(), reverse=True), "doc_id bigint, text string").repartition(4)
    for range_bytes in (1 << 20, 2000):
        found = {r["doc_id"]: r for r in fingerprint.fingerprint_edits(docs, range_bytes=range_bytes).collect()}
        assert len(found) == 300
        for i, r in found.items():
            text, following = texts[i] or "", texts[(i + 1) % 300] or ""
            changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
            own = fingerprint.sketch(text.encode())
            assert r["n_chars"] == len(text)
            assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
            assert r["fingerprint"] == fingerprint.to_text(own)
            assert r["edited_fingerprint"] == fingerprint.to_text(fingerprint.sketch(changed.encode()))
            assert r["near_next"] == fingerprint.likeness(own, fingerprint.sketch(following.encode()))
        assert found[7]["near_next"] == 1.0


def test_fingerprints_odd_rows(odd, none, clashing):
    assert len(rows(fingerprint.fingerprint_edits(odd))) == len(ODD)
    assert rows(fingerprint.fingerprint_edits(none)) == []
    assert len(rows(fingerprint.fingerprint_edits(clashing))) == len(ODD)
    found = by_id(fingerprint.fingerprints(odd), "fingerprint")
    assert (3, "") in found and (4, "") in found


def test_sketches_merge_and_estimate_containment():
    rng = random.Random(7)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(30_000)]
    whole, part = " ".join(words).encode(), " ".join(words[5000:9000]).encode()
    a, b = fingerprint.sketch(part), fingerprint.sketch(whole)
    assert fingerprint.containment(a, b) > 0.98
    assert fingerprint.containment(b, a) == pytest.approx(4 / 30, abs=0.03)
    first, second = " ".join(words[:20_000]).encode(), " ".join(words[19_000:]).encode()
    merged = fingerprint.merge(fingerprint.sketch(first), fingerprint.sketch(second))
    assert fingerprint.likeness(merged, b) > 0.99
    short = [b"a few words only", b"a", b"other words, few too and short"]
    both = fingerprint.merge(fingerprint.sketch(short[0]), fingerprint.sketch(short[2]))
    hashes = np.concatenate([fingerprint.shingle_hashes(short[0]), fingerprint.shingle_hashes(short[2])])
    assert np.array_equal(both, fingerprint._kept(hashes, fingerprint.SCALE))
    assert np.array_equal(fingerprint.from_text(fingerprint.to_text(a)), a)


# --- 6 ----------------------------------------------------------------------


def test_sampled_pieces_decode_to_the_text(odd, none, clashing):
    model = tokenizer_path(sampling.MODEL)
    found = rows(sampling.decode_pieces(sampling.sample_pieces(odd, model), model))
    assert len(found) == len(ODD)
    for _, text, pieces, decoded in found:
        assert decoded == text and (pieces is None) == (text is None)
    assert rows(sampling.sample_pieces(none, model)) == []
    checked = sampling.sample_pieces(odd, model, checked=True).collect()
    assert sorted((r["doc_id"], r["pieces"]) for r in checked if r["doc_id"]) == sorted(r[:1] + r[2:3] for r in found if r[0])
    assert all(r["round_trip"] for r in checked)
    want = {hashlib.sha256((text or "").encode()).hexdigest() for _, text, *_ in ODD}
    assert {r["decoded_sha256"] for r in checked} == want
    assert len(rows(sampling.decode_pieces(sampling.sample_pieces(clashing, model), model))) == len(ODD)
    assert by_id(sampling.sample_pieces(odd, model), "pieces") == by_id(sampling.sample_pieces(odd.repartition(3), model), "pieces")


def test_sampled_pieces_of_any_text():
    sampler = sampling.Sampler(tokenizer_path(sampling.MODEL))
    rng = random.Random(8)
    texts = ["".join(rng.choice(" ab▁\n\t日é\U0001f600x.") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts += [" " * 50, "\n", "y" * 9000, "▁" * 3]
    pieces, ends = sampler.encode(list(range(len(texts))), texts)
    for text, start, end in zip(texts, [0, *ends], ends):
        assert sampling.decode(pieces[start:end].tolist(), sampler.vocab).decode() == text


def test_long_runs_are_drawn_as_whole_words(monkeypatch):
    sampler = sampling.Sampler(tokenizer_path(sampling.MODEL))
    rng = random.Random(17)
    run = "".join(rng.choice(["the", "data", "e", "ing", "x", "日本", "\U0001f600", "é", "\x07"]) for _ in range(4000))
    texts = [run, "a " + run[:3000] + " b", run, "plain words only", "", None]
    drawn = {}
    for stretch in (10**9, 1000, 37):
        monkeypatch.setattr(sampling, "STRETCH", stretch)
        drawn[stretch] = [part.tolist() for part in sampler.encode(list(range(len(texts))), texts)]
    assert drawn[10**9] == drawn[1000] == drawn[37]
    pieces, ends = drawn[37]
    assert sampling.decode(pieces[: ends[0]], sampler.vocab).decode() == run
    assert len({tuple(pieces[: ends[0]]), tuple(pieces[ends[1] : ends[2]])}) == 2


def test_samples_follow_the_exact_distribution():
    sampler = sampling.Sampler(tokenizer_path(sampling.MODEL))
    vocab = sampler.vocab

    def ways(word):
        if not word:
            yield (), 1.0
        for k in range(1, len(word) + 1):
            if word[:k] in vocab.weights:
                for rest, weight in ways(word[k:]):
                    yield (vocab.ids[word[:k]], *rest), weight * vocab.weights[word[:k]]

    for text in ("nation", "thing"):
        exact = dict(ways("▁" + text))
        total = sum(exact.values())
        pieces, ends = sampler.encode(list(range(20_000)), [text] * 20_000)
        counts = Counter(tuple(pieces[a:b].tolist()) for a, b in zip([0, *ends], ends))
        for way, weight in exact.items():
            assert counts[way] / 20_000 == pytest.approx(weight / total, abs=0.015)
        # Word by word gives the same lattice as all words at once.
        one = sampling._OneByOne(vocab, 1, 0)
        one.add("▁" + text)
        many = sampling.filtered(["▁" + text], vocab)
        found = []
        for lattice, skip in ((one, 0), (many, 1)):
            cuts = [*list(lattice.first_option)[skip:], len(lattice.share)]
            own = [np.minimum(1, np.array(lattice.share)[a:b]) for a, b in zip(cuts, cuts[1:])]
            found.append([np.sort(np.diff(shares, prepend=0)) for shares in own])
        assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(*found)) and len(found[0]) == len(found[1])


# --- 7 ----------------------------------------------------------------------


def test_packing_holds_every_piece_in_place(spark, odd, none, clashing):
    encoder = packing.WordEncoder(tokenizer_path(packing.TOKENIZER))
    for capacity in (4096, 64):
        found = packing.pack_documents(odd, capacity=capacity).collect()
        pieces = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found if r["doc_id"])
        want = []
        for doc_id, text, *_ in ODD:
            ids = [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
            for start in range(0, len(ids), capacity):
                part = ids[start : start + capacity]
                want.append((doc_id, start // capacity, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
        assert pieces == sorted(w for w in want if w[0])
        assert len(found) == len(want)
        sequences = {}
        for r in found:
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for own in sequences.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= capacity
    assert rows(packing.pack_documents(none)) == []
    assert len(rows(packing.pack_documents(clashing))) == len(rows(packing.pack_documents(odd)))


def test_words_have_the_ids_of_the_whole_text():
    encoder = packing.WordEncoder(tokenizer_path(packing.TOKENIZER))
    rng = random.Random(9)
    texts = ["Hello, World! don't a<|endoftext|>b <|ENDOFTEXT|> İ ΑΣ. ½", "", " "]
    texts += ["".join(rng.choice("abCé ñ.,!'’1٣́̇İẞ\n\t\x1c　가\U0001d538<|>s") for _ in range(50)) for _ in range(200)]
    encoded = encoder.encode([text.encode() for text in texts])
    for text, ids in zip(texts, encoded):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_encoded_once_in_a_batch(monkeypatch):
    encoder, asked = packing.WordEncoder(tokenizer_path(packing.TOKENIZER)), []
    encode = packing.WordEncoder._encode_words
    monkeypatch.setattr(packing.WordEncoder, "_encode_words", lambda self, words: asked.extend(words) or encode(self, words))
    texts = ["Word*** word### (word) word's word%&!? été### ét\u00e9*", " ", "\u3000 word*** \u3000", "", "x<|endoftext|> Word***"] * 3
    for _ in range(2):
        found = encoder.encode([text.encode() for text in texts] + [None])
        for text, ids in zip([*texts, ""], found, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(asked) == len(set(asked)) == len(encoder.known)
    # Signs at the end of a word are taken off, whatever ASCII signs they are.
    words = []
    monkeypatch.setattr(packing.WordEncoder, "_encode_letters", lambda self, some: words.extend(some) or {})
    encode(encoder, {b"one***", b"two%&!?", b"three###", b"four's"})
    assert sorted(words) == [b"one", b"three", b"two"]


def test_packing_many_pieces_needs_few_sequences(spark):
    rng = np.random.default_rng(10)
    lengths = np.minimum(4096, rng.lognormal(6, 1, 6000).astype(int) + 1).tolist()
    items = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], packing.PIECE_SCHEMA)
    found = packing.pack(items, block_pieces=1500).select("sequence_id", "length").collect()
    fills = Counter()
    for r in found:
        fills[r["sequence_id"]] += r["length"]
    assert len(found) == 6000 and max(fills.values()) <= 4096
    assert len(fills) <= -(-sum(lengths) // 4096) + 1


@pytest.mark.parametrize("kind", ["tens", "same", "empty", "third", "wide"])
def test_packing_in_blocks_needs_no_more_sequences_than_best_fit_over_all(spark, kind):
    rng = np.random.default_rng(12)
    n = 20_000 if kind != "third" else 6_001
    lengths = {
        "tens": 10 * rng.integers(1, 120, n),
        "same": np.full(n, 1400),
        "empty": np.ones(n, np.int64),
        "third": rng.choice([1366, 1400, 1300], n),
        "wide": rng.integers(1, 4096, n),
    }[kind]
    lengths = np.sort(lengths)[::-1].tolist()
    over_all = max(packing.best_fit(lengths, list(range(n)), [], 4096)) + 1
    items = spark.createDataFrame([(i, 0, 0, size, 0) for i, size in enumerate(lengths)], packing.PIECE_SCHEMA)
    found = packing.pack(items, block_pieces=4096 if n > 10_000 else 1000).select("doc_id", "sequence_id", "length").collect()
    fills = Counter()
    for r in found:
        fills[r["sequence_id"]] += r["length"]
    assert sorted(r["doc_id"] for r in found) == list(range(n)) and max(fills.values()) <= 4096
    assert len(fills) <= over_all


def test_settled_sequences_leave_at_most_half_of_the_pieces(spark):
    placed = spark.createDataFrame([(free,) for free in [0, 1, 2, 3, 3, 3, 900, 900, 4000]], "free long")
    assert packing._to_settle(placed, 4) == (3, 3)
    assert packing._to_settle(placed, 6) == (2, 6)
    assert packing._to_settle(placed, 2) == (900, 1)
    assert packing._to_settle(placed, 0) == (4000, 0)


def test_a_word_encoder_is_shared_and_forgets_what_it_may_not_remember(monkeypatch):
    path = tokenizer_path(packing.TOKENIZER)
    assert packing.word_encoder(path) is packing.word_encoder(path)
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 2)
    encoder = packing.WordEncoder(path)
    want = encoder.tokenizer.encode("one two three four", add_special_tokens=False).ids
    for _ in range(2):
        assert np.frombuffer(encoder.encode([b"one two three four"])[0], "<u4").tolist() == want
        assert len(encoder.known) == 2


def test_a_worker_keeps_one_thing_and_forgets_it():
    made = []

    def make():
        made.append(1)
        return object()

    first = common.remembered("a", make)
    assert common.remembered("a", make) is first
    common.remembered("b", make)
    assert list(common._remembered) == ["b"]
    # Operators that take as much memory drop what another one has left.
    list(language._count_ngrams(iter([])))
    assert not common._remembered and len(made) == 2


def test_operators_that_keep_rows_move_their_text_once(spark):
    docs = spark.createDataFrame([(1, "a ñ"), (2, None), (3, "")], "doc_id long, text string")
    assert common.with_record(docs).columns == ["record"]
    other = docs.select("doc_id", F.encode("text", "utf-8").alias("text"))
    assert common.with_record(other).columns == ["record", "text"]
    record = pa.array(docs.toArrow().to_pylist())
    (batch,) = common.with_text(iter([pa.record_batch([record], names=["record"]).slice(1)]))
    assert batch.column("text").to_pylist() == [None, ""]
    for rows in (docs, other):
        found = language.identify(rows, language.Identifier([]))
        assert sorted(r["doc_id"] for r in found.collect()) == [1, 2, 3]
        assert repeats.without_repeats(rows).count() == 3


def test_evolution_never_loses_a_piece_and_gets_better():
    rng = np.random.default_rng(11)
    lengths = np.sort(rng.integers(1200, 1500, 200))[::-1].astype(np.int32)
    block = packing.Block(lengths, 4096)
    population = [block.first(rng, 0.3) for _ in range(4)]
    best = max(map(block.fitness, population))
    evolved = block.evolve(population, rng, 20, 4)
    for packed in evolved:
        assert block.fills(packed).max() <= 4096 and len(packed) == 200 and block.fills(packed).min() > 0
    assert block.fitness(evolved[0]) >= best
    child = block.crossed(population[0], population[1], rng)
    assert block.fills(child).sum() == lengths.sum()


# --- 8 ----------------------------------------------------------------------


def top_by_brute_force(vectors, k, step):
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in vectors.items()}
    found = []
    for q in (i for i in whole if i % step == 0):
        scores = [(-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q and len(whole[i]) == len(whole[q])]
        found += [(q, rank, i, -score) for rank, (score, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(12)
    vectors = {i: rng.normal(0, 0.2, 8).astype(np.float32).astype(float).tolist() for i in range(700)}
    vectors |= {1000 + i: vectors[i] for i in range(30)}  # ties
    vectors |= {2000 + i: [0.5, -0.25] for i in range(15)}
    docs = spark.createDataFrame(list(vectors.items()), "id bigint, v array<double>")
    for block_rows in (10_000, 100):
        found = rows(topk.top_k(docs, "id", "v", k=7, query_step=50, block_rows=block_rows))
        assert sorted(found) == top_by_brute_force(vectors, 7, 50)


def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, []),
            (6, [1.0, 0.0]), (7, [-1.0, 0.0]), (6, [0.5, 0.0]), (100, [0.0, 0.0])]
    docs = spark.createDataFrame(data, "vec_id bigint, embedding array<double>").withColumn("block", F.lit(1))
    found = sorted(rows(topk.top_k(docs, "vec_id", "embedding")))
    assert found[:4] == [(0, 1, 6, 1048576), (0, 2, 6, 524288), (0, 3, 100, 0), (0, 4, 7, -1048576)]
    assert [r[2] for r in found[4:]] == [0, 6, 6, 7]
    assert rows(topk.top_k(docs.limit(0), "vec_id", "embedding")) == []


def best_pairs(data, k, step):
    """By definition: the best pairs of rows with a query's id and rows with another."""
    scaled = [(i, [math.floor(1024.0 * x) for x in v]) for i, v in data]
    found = []
    for query in {i for i, _ in scaled if i % step == 0}:
        pairs = [
            (-sum(a * b for a, b in zip(v, w)), j)
            for i, v in scaled if i == query for j, w in scaled if j != query
        ]
        found += [(query, rank, j, min(max(-score, -(2**63)), 2**63 - 1)) for rank, (score, j) in enumerate(sorted(pairs)[:k], 1)]
    return sorted(found)


def test_top_k_repeated_ids_and_large_components(spark):
    rng = random.Random(15)
    # A third of the rows has one id, some of them equal; a few components are large.
    data = [(0 if i % 3 == 0 else i, [float(rng.randint(-3, 3)) for _ in range(3)]) for i in range(90)]
    data += [(0, [2.0, 1.0, 0.0])] * 15 + [(7, [2.0, 1.0, 0.0])] * 15
    data += [(200, [20000.0, -20000.0, 1.5]), (201, [30000.0, 5.0, 2.0**40]), (100, [-(2.0**50), 2.0**30, 1.0]), (50, [2.0**45, 0.0, 1.0])]
    table = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    for block_rows in (1000, 20):
        found = sorted(rows(topk.top_k(table, "vec_id", "embedding", k=10, query_step=50, block_rows=block_rows)))
        assert found == best_pairs(data, 10, 50)


def test_bit_sliced_sums_are_exact():
    rng = np.random.default_rng(13)
    values = rng.integers(-1000, 1000, (150, 6))
    block = topk.SlicedBlock(np.arange(150), values, low=0)
    query = rng.integers(-1000, 1000, 6)
    sums = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:150].astype(object) << i for i, s in enumerate(block.coarse_sums(query)))
    order = np.argsort(values @ query, kind="stable")
    assert np.array_equal(np.diff((values @ query)[order]), np.diff(sums[order]))


# --- 9 ----------------------------------------------------------------------


def test_folding():
    assert toxicity.fold("1D1OT!") == " idiot "
    assert toxicity.fold("ѕtuріd") == " stupid "
    assert toxicity.fold("ｆｏｏ​bar é") == " foobar é "


def test_signs_of_all_scripts_part_words():
    lexicon = toxicity.Lexicon({toxicity.fold("idiot"): 3.0, toxicity.fold("moron"): 2.0})
    for text in ["“idiot”", "wow—idiot", "you\u00a0idiot", "moron’s", "moron…", "«moron»", "idiot。", "moron\u2028x", "\U0001f621idiot\U0001f621",
                 "\U0001d422\U0001d41d\U0001d422\U0001d428\U0001d42d", "ⓜⓞⓡⓞⓝ", "ｍｏｒｏｎ"]:
        assert len(lexicon.hits(toxicity.fold(text))) == 1, text
    # Marks belong to their word, and other scripts' words stay whole.
    for text in ["हिन्दी", "cafe\u0301s", "日本語", "ñandú", "ﬁn", "x²"]:
        assert len(toxicity.fold(text).split()) == 1, text
    assert toxicity.fold("naïve “Ünï” – é") == " naïve ünï é "
    for text in ["moronic", "xmoron", "mo\u0301ron"]:
        assert not lexicon.hits(toxicity.fold(text)), text


def test_automaton_equals_naive_search():
    rng = random.Random(13)
    for _ in range(300):
        letters = "ab" if rng.random() < 0.5 else "abc"

        def word():
            return "".join(rng.choice(letters) for _ in range(rng.randint(1, 5)))

        entries = {f" {word()}{rng.choice(['', ' '])}": rng.choice([0.5, 1.0, 2.0]) for _ in range(8)}
        phrases = list({f" {word()} {word()} " for _ in range(6)})
        folded = toxicity.fold(" ".join(word() for _ in range(rng.randint(0, 30))))
        want = {}
        for start in range(len(folded)):
            own = [weight for entry, weight in entries.items() if folded.startswith(entry, start)]
            if own:
                want[start] = max(own)
        for phrase in phrases:
            for start in range(len(folded)):
                if folded.startswith(phrase, start):
                    # The blank at its end already belongs to the next word.
                    want = {at: w for at, w in want.items() if not start <= at < start + len(phrase) - 1}
        assert toxicity.Lexicon(entries, phrases).hits(folded) == want


def test_folding_of_i_and_l():
    for word, others in {"kill": ["ki11", "k1ll", "k|ll", "ki!l", "ki||"], "loser": ["1oser", "|oser", "l0ser"], "asshole": ["a55h01e"]}.items():
        assert {toxicity.fold(other) for other in others} == {toxicity.fold(word)}
        lexicon = toxicity.Lexicon({toxicity.fold(word): 3.0})
        assert all(lexicon.density(f"you {other} there") > 0 for other in others)
        # Signs between words still part them.
        assert lexicon.density(f"a|{word}|b") > 0 and lexicon.density(f"no!{word}!!") > 0 and lexicon.density(f"| {word} |") > 0
    assert toxicity.fold("a | b ! c! d") == " a b c d "


def test_lexicon_hits_exceptions_and_length():
    lexicon = toxicity.Lexicon({" idiot": 3.0, " idiot ": 4.0, " trash": 2.0}, [" trash can "], -3.0, 4.0)
    assert sum(lexicon.hits(toxicity.fold("An idiot, idiotic 1d1ot")).values()) == 11.0
    assert lexicon.hits(toxicity.fold("the trash can is full")) == {}
    assert lexicon.hits(toxicity.fold("you trash, can you")) == {}
    assert sum(lexicon.hits(toxicity.fold("trash talk")).values()) == 2.0
    assert lexicon.density("idiot " + "word " * 10) > lexicon.density("idiot " + "word " * 1000) > 0
    assert lexicon.score(None) == lexicon.score("") < 0.1 < lexicon.score("idiot idiot")


@pytest.fixture(scope="module")
def toxic_texts(spark):
    rng = random.Random(14)
    words = [f"{a}{b}" for a in ("ba", "do", "ki", "lu", "me") for b in ("ra", "so", "tu", "vi", "we")]
    data = []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                text[rng.randrange(len(text))] = rng.choice(["grumpfish", "grumpfoot", "zornix"])
        elif i % 6 == 1:
            text[2:4] = ["zornix", "garden"]
        data.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in data], "doc_id bigint, quality int, toxic int")
    return docs, labels, {i: y for i, _, y in data}


def test_toxicity_is_learned_with_its_exceptions(toxic_texts):
    docs, labels, truth = toxic_texts
    lexicon = toxicity.learn_toxicity(docs, labels.where("doc_id % 5 > 0"))
    assert any(" grum".startswith(entry[:5]) for entry in lexicon.weights)
    found = dict(rows(toxicity.score_toxicity(docs, lexicon)))
    held = [i for i in truth if i % 5 == 0]
    assert sum((found[i] >= 0.3) == truth[i] for i in held) / len(held) > 0.95


def test_toxicity_odd_rows(spark, odd, none, clashing):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, 1, None), (None, 1, 1), (3, 0, 1)], "doc_id bigint, quality int, toxic int")
    lexicon = toxicity.learn_toxicity(odd, labels)
    for docs in (odd, clashing):
        found = rows(toxicity.score_toxicity(docs, lexicon))
        assert len(found) == len(ODD) and all(0 <= r[1] <= 1 for r in found)
    assert rows(toxicity.score_toxicity(none, toxicity.learn_toxicity(none, labels.limit(0)))) == []


# --- 10 ---------------------------------------------------------------------


def test_ngrams_by_definition():
    grams, alphabet = language.ngrams(["ab c!", "", "12", "x"])
    bits = language._bits(alphabet)
    letters = lambda g: "".join(chr(alphabet[(int(g) >> s) & ((1 << bits) - 1)]) or "" for s in (2 * bits, bits, 0)).lstrip("\0")
    # A blank in front is a leading zero, so only the grams' own letters are compared.
    assert sorted(letters(g).replace("\0", "_") for g in grams[0]) == sorted(
        ["a", "b", "c", "a", "ab", "b_", "c", "c_", "ab", "ab_", "c_"]
    )
    assert len(grams[1]) == len(grams[2]) == 0 and len(grams[3]) == 4


def test_languages_are_told_apart(spark, odd, none, clashing):
    texts = [("the house is on the hill and the sun shines", "en"), ("das haus steht auf dem berg und die sonne", "de"),
             ("la casa está en la colina y el sol brilla", "es")]
    labelled = spark.createDataFrame(texts * 20, "text string, lang string")
    model = language.learn_languages(labelled)
    assert model.languages == ["de", "en", "es"]
    assert [lang for lang, _ in model.predict(["the hill is the house", "das haus auf dem berg", "la casa y el sol"])] == ["en", "de", "es"]
    assert model.predict([None, "", "123 ..."]) == [("und", 0.0)] * 3
    for docs in (odd, clashing):
        found = by_id(language.identify(docs, model), "lang_pred", "score")
        assert len(found) == len(ODD) and all(0 <= r[2] <= 1 for r in found)
        assert (6, "und", 0.0) in found
    assert rows(language.identify(none, model)) == []
    assert language.learn_languages(none).predict(["abc"]) == [("und", 0.0)]


def test_out_of_place_distance_by_definition():
    rng = random.Random(15)
    text = " ".join("".join(rng.choice("abcd") for _ in range(4)) for _ in range(50))
    grams, alphabet = language.ngrams([text])
    own = language._in_code_points(language.most_frequent(grams[0], 30), alphabet).tolist()
    profile = own[::-1][:20]
    model = language.Identifier([("xx", rank, gram) for rank, gram in enumerate(profile)], 20)
    want = sum(abs(i - profile.index(g)) if g in profile else 30 for i, g in enumerate(own))
    assert model.predict([text], 30)[0][1] == pytest.approx(1 - want / (30 * len(own)))


# --- the pipeline -----------------------------------------------------------


@pytest.fixture(scope="module")
def labels_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_keep_rows_and_columns(spark, odd, none, clashing, labels_dir):
    kept = {}
    for docs in (odd, clashing, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, labels_dir)
            assert found.columns == docs.columns, name
            kept[name, docs] = sorted((r["doc_id"] for r in found.collect()), key=repr)
    for docs in (odd, clashing):
        assert [i for i in (3, 4, 5, 6) if i in kept["language", docs]] == []
        assert [i for i in (1, 2, 7, 9, 10) if i not in kept["language", docs]] == []
        assert len(kept["toxicity", docs]) == len(ODD)
        assert kept["near_duplicates", docs].count(2) == 0 and kept["near_duplicates", docs].count(1) == 1
        assert len(kept["near_duplicates", docs]) == len(ODD) - 2
        assert len(kept["repeats", docs]) == len(ODD)


def test_repeats_stage_counts_characters_anew(spark, labels_dir):
    passage = "".join(random.Random(16).choice("abcdef é") for _ in range(400))
    data = [(1, "begin " + passage + " one", "en", "s", 410), (2, passage + " two", "en", "s", 404), (3, None, "en", "s", None)]
    docs = spark.createDataFrame(data, SCHEMA)
    found = {r["doc_id"]: r for r in corpus_pipeline.repeats(spark, docs, labels_dir).collect()}
    assert found[3]["text"] is None and found[3]["n_chars"] is None
    for i in (1, 2):
        assert passage[50:300] not in found[i]["text"] and found[i]["n_chars"] == len(found[i]["text"])
    assert found[1]["text"].startswith("begin") and found[2]["text"].endswith("two")
