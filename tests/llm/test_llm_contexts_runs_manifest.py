"""Personal data, periodic runs and the manifest, against brute force."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from termloom.llm import manifest as m
from termloom.llm import private, runs
from termloom.llm.manifest import OP13_SQL, op13_manifest
from termloom.llm.private import op11_private
from termloom.llm.runs import op12_runs

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string"


def folder(spark, tmp_path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- personal data ----------------------------------------------------------


def plain_seeds(text):
    """The forms as they are stated, tried at every place."""

    def luhn(digits):
        doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(digits[::-1])]
        return sum(sum(map(int, str(d))) for d in doubled) % 10 == 0

    def digits(s):
        return re.sub("[^0-9]", "", s)

    forms = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x.lstrip("0")[:4] or 0) <= 255 for x in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    ]
    return sorted(
        (x.start(), kind, x.end()) for kind, (form, good) in enumerate(forms) for x in re.finditer(form, text) if good(x[0])
    )


def test_seeds_equal_the_forms():
    rnd = random.Random(3)
    pieces = ["a", "b.", "@", "x@y.z", ".", "-", "_", "+", "1", "25", "256", "0", " ", "(", ")", "é", "\n",
              "4111111111111111", "4111 1111-1111 1111", "+1 (988) 555-2485", "10.0.0.1", "%"]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(0, 14))) for _ in range(6000)]
    texts += ["a@b.com@c.org_x@d.de", "x@y.z_w@v.u", "0" * 6000 + "1.2.3.4", "1.2.3.4.5.6.7.8", "a" * 3000 + " b@c.d"]
    assert sum(len(plain_seeds(text)) for text in texts) > 1000
    for text in texts:
        assert private.seeds_in(text) == plain_seeds(text), text


def test_candidates_do_not_touch_seeds():
    text = "mail bob [at] host [dot] org or 10.0.0.1, call 555 123 4567 (4111111111111111 4111111111111111)"
    seeds, mentions = private.mentions_in(text)
    assert [text[s["start"] : s["end"]] for s in seeds] == ["10.0.0.1"]
    new = [(x["value"], text[x["start"] : x["end"]]) for x in mentions if x["kind"] < 0]
    assert new == [
        ("mail:bob@host.org", "bob [at] host [dot] org"),
        ("short:5551234567", "555 123 4567"),
        ("long:4111111111111111", "4111111111111111"),
        ("long:4111111111111111", "4111111111111111"),
    ]
    assert "call <short>" in mentions[2]["patterns"]


def contextual_rows():
    rows = [(i, f"Please dial +1 (30{i}) 555-010{i} tonight, {i} of us wait", "en", "s", 1, "x") for i in range(8)]
    return rows + [
        (20, "Please dial 415 555 0199 tonight", "en", "s", 1, "x"),
        (21, "part number 415 555 0177 in stock", "en", "s", 1, "x"),
        # A number that is known from another text, in a context that is not.
        (22, "he wrote 303-555-0103 on it", "en", "s", 1, "x"),
        (23, "", "en", None, 0, "x"),
        (24, None, None, None, None, None),
        (None, "ask a@b.org or +1 (301) 555-0101", "en", "s", 1, "x"),
        (None, "ask a@b.org or +1 (301) 555-0101", "en", "s", 1, "x"),
    ]


def test_contexts_find_what_has_no_form(spark, tmp_path):
    rows = op11_private(spark, folder(spark, tmp_path, contextual_rows())).collect()
    found = {row["doc_id"]: row for row in rows}
    assert len(rows) == len(contextual_rows())
    assert found[20]["spans"] == "phone:12:24" and found[20]["n_phone"] == 0 and found[20]["n_added"] == 1
    assert found[21]["spans"] == "" and found[21]["base_sha256"] == sha("")
    assert found[22]["spans"] == "phone:9:21"
    assert found[23]["spans"] == "" and found[24]["spans"] == ""
    assert found[3]["spans"] == "phone:12:29" and found[3]["n_phone"] == 1
    no_id = [row for row in rows if row["doc_id"] is None]
    assert [row["spans"] for row in no_id] == ["email:4:11,phone:15:32"] * 2
    assert no_id[0]["base_sha256"] == sha("email:4:11,phone:15:32")


def test_addresses_without_at_signs_and_digits_are_read(spark, tmp_path):
    rows = [(i, f"Please write to a{i}@host.org tonight", "en", "s", 1, "x") for i in range(8)]
    hidden = ["bob at host.org", "bob (at) host.org", "bob [at] host (.) org", "bob\u00a0at\u00a0host\u2003dot\u2003org"]
    texts = [f"Please write to {one} tonight" for one in hidden]
    rows += [(20 + i, text, "en", "s", 1, "x") for i, text in enumerate(texts)]
    at = folder(spark, tmp_path, rows)
    found = {row["doc_id"]: row for row in op11_private(spark, at).collect()}
    for i, one in enumerate(hidden):
        assert found[20 + i]["spans"] == f"email:16:{16 + len(one)}" and found[20 + i]["n_added"] == 1, one
    read = {row["doc_id"]: row for row in private.read_mentions(spark.read.parquet(f"{at}/documents.parquet")).collect()}
    for i, text in enumerate(texts):
        assert [x.asDict() for x in read[20 + i]["mentions"]] == private.mentions_in(text)[1]


def test_bootstrap_equals_plain_loops(spark):
    rnd = random.Random(5)
    mentions = []
    for _ in range(400):
        n = rnd.randrange(60)
        kind = rnd.choice([-1, private.PHONE]) if n < 30 else -1
        mentions.append((kind, f"short:{n}", [f"p{rnd.randrange(1 + n // 3)}" for _ in range(2)]))
    df = spark.createDataFrame(mentions, "kind int, value string, patterns array<string>")
    patterns, scores = private.bootstrap(df)
    edges = {(value, p) for _, value, found in mentions for p in found}
    known = {value: 1.0 for kind, value, _ in mentions if kind >= 0}
    state = dict(known)
    for _ in range(private.ROUNDS):
        sums, sizes = {}, {}
        for value, p in edges:
            sums[p] = sums.get(p, 0) + state.get(value, 0)
            sizes[p] = sizes.get(p, 0) + 1
        good = {p: s / (sizes[p] + 1) for p, s in sums.items() if s >= private.LEAST_SUPPORT - 1e-9}
        good = {p: c for p, c in good.items() if c >= private.LEAST_CONFIDENCE}
        doubt = {}
        for value, p in edges:
            if p in good:
                doubt[value] = doubt.get(value, 1) * (1 - good[p])
        state = {value: 1 - d for value, d in doubt.items() if 1 - d >= private.ACCEPTED} | known
    assert {r["pattern"]: round(r["confidence"], 9) for r in patterns.collect()} == {p: round(c, 9) for p, c in good.items()}
    assert {r["value"]: round(r["score"], 9) for r in scores.collect()} == {v: round(s, 9) for v, s in state.items()}
    assert len(state) > len(known)


# --- runs -------------------------------------------------------------------


def plain_runs(words):
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(runs.LEAST, 2 * q):
                part = words[i : j + q]
                if all(part[d:] != part[: length - d] for d in range(1, q)):
                    found.append((i, length, q))
            i = j + 1 if j == i else j
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rnd):
    words = [b"%d" % rnd.randrange(rnd.choice([1, 2, 3, 40])) for _ in range(rnd.randint(0, 60))]
    if words and rnd.random() < 0.6:
        at, q = rnd.randrange(len(words)), rnd.randint(1, 20)
        unit = words[at : at + q]
        words = words[:at] + (unit * 40)[: rnd.randint(0, 60)] + words[: rnd.randint(0, 9)]
    return words


def test_runs_equal_brute_force():
    rnd = random.Random(11)
    n = 0
    for _ in range(250):
        texts = [random_words(rnd) for _ in range(rnd.randint(1, 6))]
        found = [list(zip(*(x.tolist() for x in triple))) for triple in runs.runs_of_texts(texts)]
        assert found == [plain_runs(words) for words in texts]
        n += sum(map(len, found))
    assert n > 300


def test_stretches_without_a_run():
    words = [b"%d" % i for i in range(15)]
    start, length, period = runs.runs_of([runs.np.array([0, 1, 2, 3]), runs.np.array([0, 1, 0, 2])])[1:]
    assert not len(start) and not len(length) and not len(period)
    assert [len(x[0]) for x in runs.runs_of_texts([words + [b"x"] + words])] == [0]


def plain_op12(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), hashlib.sha256(kept).hexdigest(),
    )


def test_op12_equals_brute_force(spark, tmp_path):
    rnd = random.Random(12)
    rows = [(i, b" ".join(random_words(rnd)).decode(), None, None, None, "x") for i in range(200)]
    rows += [
        (300, None, None, None, None, None),
        (301, " \t\n", None, None, None, None),
        (302, "a " * 30000, None, None, None, None),
        (None, "x y\x0bz " * 20, None, None, None, None),
        (None, "x y\x0bz " * 20, None, None, None, None),
        (303, "é é " * 40 + "ü", None, None, None, None),
    ]
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [tuple(row) for row in op12_runs(spark, folder(spark, tmp_path, rows)).select(names).collect()]
    want = [plain_op12(row[0], row[1]) if row[0] != 302 else None for row in rows]
    long_one = next(row for row in got if row[0] == 302)
    assert long_one[1:6] == (1, 0, 30000, 1, 30000000)
    assert long_one[7] == sha("a")
    assert sorted(map(repr, (row for row in got if row[0] != 302))) == sorted(map(repr, filter(None, want)))


# --- manifest ---------------------------------------------------------------


def plain_op13(rows):
    def h(*parts):
        return sha("".join(parts))

    def leaf(doc_id, text, lang, source, n_chars):
        values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
        return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])

    def tree(nodes):
        """The root, and for each node the runs above it as (left, right)."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, place in enumerate(at):
                low = place - place % 3
                paths[i].append(("".join(nodes[low:place]), "".join(nodes[place + 1 : low + 3])))
                at[i] = place // 3
            nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        return nodes[0], paths

    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append((row[0], leaf(*row[:5]), row))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in by_source[s]])
    found = []
    if not sources:
        return found
    root, above = tree([trees[s][0] for s in sources])
    for s, up in zip(sources, above):
        for (doc_id, digest, row), path in zip(by_source[s], trees[s][1]):
            path = path + up
            text = row[1]
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = leaf(doc_id, text, *row[2:5])
            for left, right in path:
                node = h(left, node, right)
            found.append((doc_id, digest, trees[s][0], root, h(*[x + y for x, y in path]), node, node == root))
    return found


NAMES13 = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("n", [1, 10, 2300])
def test_op13_equals_plain_tree(spark, tmp_path, n):
    rnd = random.Random(n)
    rows = []
    for i in range(n):
        # One source holds most rows, so that its tree has several tiers of blocks.
        source = rnd.choice(["hot"] * 30 + [None, "", "a", "é", "z", "Z"]) if n > 4 else rnd.choice(["hot", None])
        text = rnd.choice([None, "", "a\nb", "no break", "\n", "ü\n" * 50])
        rows.append((i * 7 - 20, text, rnd.choice([None, "en"]), source, rnd.choice([None, 5]), "extra"))
    if n >= 10:
        rows += [(None, "a\nb", "en", "hot", 3, "x"), (None, "c", "en", "hot", 3, "x")]
        rows += [(8, "same\n", "en", "hot", 4, "x")] * 3
    path = folder(spark, tmp_path, rows)
    got = [tuple(row) for row in op13_manifest(spark, path).select(NAMES13).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_op13(rows)))


def test_op13_sql(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([None, "a\nb", "c"]), "en", rnd.choice(["s", None, "t"]), 3, "x") for i in range(-5, 60)]
    rows += [(None, "x\n", None, "s", None, "x")]
    path = folder(spark, tmp_path, rows)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    want = duck.execute(f"SELECT {', '.join(NAMES13)} FROM ({OP13_SQL})").fetchall()
    got = [tuple(row) for row in op13_manifest(spark, path).select(NAMES13).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_op13_ranks_spread_a_large_group(spark):
    """One source in many parts: ranks are gapless all the same."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        nodes = spark.range(5000).select(F.lit("=hot").alias("g"), (F.col("id") * 37 % 5000).alias("key"))
        ranks = m.ranked(nodes, "g", ["key"]).select("key", "rank", "total").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(row["key"] == row["rank"] and row["total"] == 5000 for row in ranks) and len(ranks) == 5000


# --- odd tables -------------------------------------------------------------


@pytest.mark.parametrize("query", [op11_private, op12_runs, op13_manifest])
def test_empty_table(spark, tmp_path, query):
    assert query(spark, folder(spark, tmp_path, [])).collect() == []


@pytest.mark.parametrize("query", [op11_private, op12_runs, op13_manifest])
def test_clashing_columns(spark, tmp_path, query):
    schema = SCHEMA.replace("row string", "row string, kind string, rank string, tie string, runs string, leaf string")
    rows = [(i, f"word +1 (30{i}) 555-0101 x", "en", "s", 3, *"abcdef") for i in range(4)]
    assert query(spark, folder(spark, tmp_path, rows, schema)).count() == 4
