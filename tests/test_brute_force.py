"""Random corpora against the formula in plain Python."""

import json
import random
from collections import Counter, defaultdict

import pytest
from conftest import json_corpus

from termloom import build_index, field_params, merge_indexes, query_terms, score_batch

WORDS = ["Red", "fox", "the", "--", "den!", "blue", "über"]
CLEAN = {"Red": "red", "--": "", "den!": "den"}
FIELDS = {"x": "f", "y": "g", "z": "h"}
PARAMS = field_params(
    {"f": 2.0, "g": 0.5, "h": 1.0}, {"f": 1.2, "g": 0.9, "h": 2.0}, {"f": 0.75, "g": 0.0, "h": 1.0}
)


def random_records(rng, n):
    records = []
    for _ in range(n):
        record = {"docid": f"d{rng.randrange(n)}"}  # some come back
        for key in FIELDS:
            if rng.random() < 0.7:  # else absent
                record[key] = "  ".join(rng.choices(WORDS, k=rng.randrange(7)))
        records.append(record)
    return records


def brute_force(records, queries, length_norm):
    tf, lengths = Counter(), Counter()
    for record in records:
        for key, field in FIELDS.items():
            if key in record:
                lengths[field, record["docid"]] += 0
                for word in record[key].split():
                    tf[field, CLEAN.get(word, word), record["docid"]] += 1
                    lengths[field, record["docid"]] += 1
    mean = {
        field: sum(n for (g, _), n in lengths.items() if g == field)
        / max(1, sum(g == field for g, _ in lengths))
        for field in PARAMS
    }
    matches = defaultdict(dict)
    for (field, term, docid), n in tf.items():
        matches[term, docid][field] = n
    df = Counter(term for term, _ in matches)
    hits = Counter()
    for query_id, terms in queries.items():
        for term in terms:
            for (found, docid), fields in matches.items():
                if found != term:
                    continue
                length = sum(PARAMS[f].weight * lengths[f, docid] for f in fields)
                for f, n in fields.items():
                    p = PARAMS[f]
                    x = p.weight * n
                    relative = length / (p.weight * mean[f]) if length_norm == "mean" else 0.0
                    s = x * (p.k1 + 1) / (p.k1 * (1 - p.b + p.b * relative + x))
                    hits[query_id, docid] += len(records) / df[term] * s
    return hits


@pytest.mark.parametrize("seed", [1, 2])
def test_scores(spark, seed):
    rng = random.Random(seed)
    records = random_records(rng, 24)
    terms = ["red", "fox", "the", "", "den", "blue", "über", "absent"]
    queries = {q: rng.choices(terms, k=rng.randrange(1, 6)) for q in range(8)}
    rows = [(q, t) for q, bag in queries.items() for t in bag]
    query = query_terms(spark.createDataFrame(rows, "query_id int, term string"))
    lines = [json.dumps(record) for record in records]
    whole = build_index(json_corpus(spark, lines, FIELDS))
    halves = [build_index(json_corpus(spark, part, FIELDS)) for part in (lines[:11], lines[11:])]
    for index, norm in ((whole, "mean"), (whole, "off"), (merge_indexes(*halves), "mean")):
        got = {
            (r["query_id"], r["docid"]): r["score"]
            for r in score_batch(index, query, PARAMS, norm).collect()
        }
        assert got == pytest.approx(dict(brute_force(records, queries, norm)))
