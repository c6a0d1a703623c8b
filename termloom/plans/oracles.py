"""The driver queries in SQL, for DuckDB."""

from __future__ import annotations

from collections.abc import Iterable

from termloom.functions.bm25f import FieldParams
from termloom.plans.driver_queries import (
    CONVERSATION_SUBSET,
    DIRICHLET,
    FIELD_PHRASE,
    GRAMS,
    LEADING_TERMS,
    LEAST_IN_DOCUMENTS,
    LEAST_IN_TURNS,
    LONGEST_GRAM,
    MISSPELLED,
    MULTI_TERM,
    PATTERNS,
    PHRASE,
    STOP_WORDS,
    TEXTBOOK,
    TOP_K_TERMS,
)
from termloom.plans.tables import (
    CONVERSATION_PARAMS,
    DOCUMENT_PARAMS,
    PAGE_PARAMS,
    parameters_sql,
)

CHUNKS = r"regexp_extract_all(text, '[^\s\p{Z}]+')"
TERM = r"regexp_replace(lower(chunk), '[^\p{L}\p{N}]', '', 'g')"

DOCUMENTS = """texts AS (
  SELECT CAST(doc_id AS VARCHAR) AS docid, 'text' AS field, text
  FROM documents WHERE text IS NOT NULL),
corpus_stats AS (SELECT CAST(count(*) AS BIGINT) AS n_docs FROM documents)"""

CONVERSATIONS = """texts AS (
  SELECT CAST(conv_id AS VARCHAR) AS docid, role AS field, text
  FROM conversations WHERE text IS NOT NULL AND role IS NOT NULL),
corpus_stats AS (SELECT CAST(count(DISTINCT conv_id) AS BIGINT) AS n_docs FROM conversations)"""

PAGES = """texts AS (
  SELECT CAST(page_id AS VARCHAR) AS docid, 'address' AS field, url AS text
  FROM pages WHERE url IS NOT NULL
  UNION ALL
  SELECT CAST(page_id AS VARCHAR), 'markup', html FROM pages WHERE html IS NOT NULL),
corpus_stats AS (SELECT CAST(count(*) AS BIGINT) AS n_docs FROM pages)"""

PARTS = """texts AS (
  SELECT CAST(p_partkey AS VARCHAR) AS docid, 'text' AS field, p_name AS text
  FROM part WHERE p_name IS NOT NULL),
corpus_stats AS (SELECT CAST(count(*) AS BIGINT) AS n_docs FROM part)"""

INDEX = f"""tokens AS (
  SELECT docid, field, {TERM} AS term
  FROM (SELECT docid, field, unnest({CHUNKS}) AS chunk FROM texts)),
lengths AS (
  SELECT field, docid, CAST(sum(len({CHUNKS})) AS BIGINT) AS len
  FROM texts GROUP BY field, docid),
field_stats AS (
  SELECT field, CAST(count(*) AS BIGINT) AS n_field_docs,
         CAST(sum(len) AS BIGINT) AS total_len, avg(len) AS avg_len
  FROM lengths GROUP BY field),
postings AS (
  SELECT t.field, t.term, t.docid, t.tf, l.len
  FROM (SELECT field, term, docid, CAST(count(*) AS BIGINT) AS tf
        FROM tokens GROUP BY field, term, docid) t
  JOIN lengths l ON l.field = t.field AND l.docid = t.docid)"""

# Whatever matches a term of a query, with the parameters of its field.
MATCHES = """matches AS (
  SELECT p.field, p.term, p.docid, p.tf, p.len, q.w, q.k1, q.b, s.avg_len
  FROM postings p
  JOIN params q ON q.field = p.field
  JOIN field_stats s ON s.field = p.field
  WHERE p.term IN (SELECT term FROM query_terms)),
document_frequencies AS (
  SELECT term, CAST(count(DISTINCT docid) AS BIGINT) AS df FROM matches GROUP BY term),
matched_lengths AS (
  SELECT term, docid, sum(w * len) AS weighted_len FROM matches GROUP BY term, docid)"""

EVERY_TERM = "query_terms AS (SELECT DISTINCT 0 AS query_id, term, 1 AS qtf FROM postings)"

BENCHMARK = rf"""query_terms AS (
  SELECT query_id, term, count(*) AS qtf
  FROM (SELECT item_id AS query_id, {TERM} AS term
        FROM (SELECT item_id, unnest({CHUNKS}) AS chunk FROM benchmark))
  GROUP BY query_id, term)"""


def _tokens(tokens: Iterable[str]) -> str:
    rows = ", ".join(f"('{token}')" for token in tokens)
    return (
        "query_terms AS (SELECT 0 AS query_id, term, count(*) AS qtf "
        f"FROM (VALUES {rows}) AS t(term) GROUP BY term)"
    )


def _field_scores(length_norm: str = "mean") -> str:
    relative = "m.weighted_len / (w * avg_len)" if length_norm == "mean" else "0"
    return f"""field_scores AS (
  SELECT x.term, x.docid, x.field,
         (w * tf * (k1 + 1)) / (k1 * ((1 - b) + b * ({relative}) + w * tf)) AS score
  FROM matches x JOIN matched_lengths m ON m.term = x.term AND m.docid = x.docid)"""


HITS = """hits AS (
  SELECT q.query_id, s.docid,
         round(sum(q.qtf * (CAST(n_docs AS DOUBLE) / d.df) * s.score), 6) AS score
  FROM field_scores s
  JOIN document_frequencies d ON d.term = s.term
  JOIN query_terms q ON q.term = s.term
  JOIN corpus_stats ON true
  GROUP BY q.query_id, s.docid)"""


def _with(parts: Iterable[str], select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _search(
    corpus: str,
    params: dict[str, FieldParams],
    query: str,
    select: str = "SELECT docid, score FROM hits",
    length_norm: str = "mean",
) -> str:
    parts = [corpus, INDEX, parameters_sql(params), query, MATCHES, _field_scores(length_norm), HITS]
    return _with(parts, select)


def _conversation_terms(select: str) -> str:
    parts = [
        CONVERSATIONS, INDEX, parameters_sql(CONVERSATION_PARAMS), EVERY_TERM, MATCHES, _field_scores()
    ]
    return _with(parts, select)


LISTS = f"""term_lists AS (
  SELECT docid, field, list_transform({CHUNKS}, lambda chunk: {TERM}) AS terms FROM texts)"""

# A phrase is a list of terms; every place of every text is tried.
PHRASE_POSTINGS = """postings AS (
  SELECT h.field, h.term, h.docid, h.tf, l.len
  FROM (SELECT field, query_id AS term, docid,
               CAST(sum(len(list_filter(range(1, len(terms) - len(phrase) + 2),
                                        lambda i: terms[i:i + len(phrase) - 1] = phrase))) AS BIGINT) AS tf
        FROM term_lists JOIN phrases ON list_has_all(terms, phrase)
        GROUP BY field, query_id, docid) h
  JOIN lengths l ON l.field = h.field AND l.docid = h.docid
  WHERE h.tf > 0),
query_terms AS (SELECT query_id, query_id AS term, 1 AS qtf FROM phrases)"""

BENCHMARK_PHRASES = f"""phrases AS (
  SELECT item_id AS query_id, list_transform({CHUNKS}, lambda chunk: {TERM})[1:{LEADING_TERMS}] AS phrase FROM benchmark)"""


def _phrase_search(corpus: str, params: dict[str, FieldParams], phrases: str, select: str) -> str:
    # The tables of an index without its postings, which are those of the phrases.
    lengths = INDEX[: INDEX.index(",\npostings AS")]
    parts = [corpus, lengths, LISTS, phrases, PHRASE_POSTINGS, parameters_sql(params), MATCHES, _field_scores(), HITS]
    return _with(parts, select)


def _one_phrase(tokens: Iterable[str]) -> str:
    return f"phrases AS (SELECT 0 AS query_id, {list(tokens)} AS phrase)"


# DuckDB counts edits of bytes. Terms are in lower case, so the letters of the tables
# outside ASCII become capitals for the comparison.
EDITS = "levenshtein(translate({a}, {letters}), translate({b}, {letters}))".replace(
    "{letters}", "'áäçèéêíñóöúüßû', 'ABCDEFGHIJKLMN'"
)


def _near(asked: str, distance: int) -> str:
    """Each asked term with all terms of its length, give or take the distance."""
    edits = EDITS.format(a="q.asked", b="v.term")
    return f"""near_terms AS (
  SELECT asked, term, distance FROM (
    SELECT q.asked, v.term, CAST({edits} AS INTEGER) AS distance
    FROM {asked} q JOIN vocabulary_terms v ON abs(length(q.asked) - length(v.term)) <= {distance})
  WHERE distance <= {distance})"""


VOCABULARY_TERMS = "vocabulary_terms AS (SELECT DISTINCT term FROM postings)"
BENCHMARK_TERMS = f"""benchmark_terms AS (
  SELECT DISTINCT {TERM} AS term FROM (SELECT unnest({CHUNKS}) AS chunk FROM benchmark))"""


def _values(name: str, column: str, texts: Iterable[str]) -> str:
    rows = ", ".join(f"({i}, '{text}')" for i, text in enumerate(texts))
    return f"{name}(query_id, {column}) AS (VALUES {rows})"


def _like(pattern: str) -> str:
    return f"replace(replace({pattern}, '*', '%'), '?', '_')"


def _expanded_search(parts: Iterable[str], found: str) -> str:
    query = f"query_terms AS (SELECT query_id, term, count(*) AS qtf FROM ({found}) GROUP BY query_id, term)"
    all_parts = [DOCUMENTS, INDEX, VOCABULARY_TERMS, *parts, query, parameters_sql(DOCUMENT_PARAMS)]
    return _with([*all_parts, MATCHES, _field_scores(), HITS], BEST_OF_EACH)


BEST_OF_EACH = """SELECT query_id, docid, score, rank FROM (
  SELECT query_id, docid, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, docid) AS INTEGER) AS rank
  FROM hits) WHERE rank <= 5"""

BAGS = """bags AS (
  SELECT p.term, p.docid, sum(q.w * p.tf) AS tf
  FROM postings p JOIN params q ON q.field = p.field
  WHERE p.term IN (SELECT term FROM query_terms) GROUP BY p.term, p.docid),
term_stats AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM bags GROUP BY term),
document_lengths AS (
  SELECT l.docid, sum(q.w * l.len) AS doc_len
  FROM lengths l JOIN params q ON q.field = l.field GROUP BY l.docid),
totals AS (
  SELECT sum(q.w * s.total_len) AS total_len FROM field_stats s JOIN params q ON q.field = s.field),
query_lengths AS (
  SELECT query_id, sum(qtf) AS query_len FROM query_terms JOIN term_stats USING (term) GROUP BY query_id)"""

TEXTBOOK_TERM = (
    f"ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * ({TEXTBOOK.k1} + 1)"
    f" / (tf + {TEXTBOOK.k1} * (1 - {TEXTBOOK.b} + {TEXTBOOK.b} * doc_len / (total_len / n_docs)))"
)
DIRICHLET_TERM = f"ln(1 + tf * total_len / ({DIRICHLET.mu} * cf))"
DIRICHLET_DOCUMENT = f"query_len * ln({DIRICHLET.mu} / ({DIRICHLET.mu} + doc_len))"


def _by_model(
    corpus: str, params: dict[str, FieldParams], query: str, select: str, term: str, document: str = "0"
) -> str:
    hits = f"""hits AS (
  SELECT query_id, docid, round(sum(qtf * {term}) + any_value({document}), 6) AS score
  FROM bags JOIN term_stats USING (term) JOIN document_lengths USING (docid)
  JOIN query_terms USING (term) JOIN query_lengths USING (query_id), totals, corpus_stats
  GROUP BY query_id, docid)"""
    return _with([corpus, INDEX, parameters_sql(params), query, BAGS, hits], select)




def _grams(least: int) -> str:
    return f"""all_grams AS (
  SELECT n, field, docid, array_to_string(terms[i:i + n - 1], ' ') AS term FROM (
    SELECT n, field, docid, terms, unnest(range(1, len(terms) - n + 2)) AS i
    FROM term_lists, (SELECT CAST(unnest(range(1, {LONGEST_GRAM + 1})) AS INTEGER) AS n))),
frequent AS (
  SELECT n, field, term, CAST(count(DISTINCT docid) AS BIGINT) AS df, CAST(count(*) AS BIGINT) AS cf
  FROM all_grams GROUP BY n, field, term HAVING count(*) >= {least}),
postings AS (
  SELECT g.field, g.term, g.docid, g.tf, l.len
  FROM (SELECT n, field, term, docid, CAST(count(*) AS BIGINT) AS tf
        FROM all_grams GROUP BY n, field, term, docid) g
  JOIN frequent f USING (n, field, term)
  JOIN lengths l ON l.field = g.field AND l.docid = g.docid)"""


LENGTH_TABLES = INDEX[: INDEX.index(",\npostings AS")]

# The other analyzer: its terms, in place of those of the default one.
RUNS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
SINGULAR = """CASE
  WHEN regexp_matches(run, '(^|[^ea])ies$') THEN left(run, length(run) - 3) || 'y'
  WHEN run LIKE '%es' AND run NOT LIKE '%ies' AND regexp_matches(run, '(^|[^aeo])es$') THEN left(run, length(run) - 1)
  WHEN run NOT LIKE '%es' AND regexp_matches(run, '[^us]s$') THEN left(run, length(run) - 1)
  ELSE run END"""
STOPS = ", ".join(f"'{word}'" for word in STOP_WORDS)


def _parts(source: str) -> str:
    return f"SELECT * FROM (SELECT * EXCLUDE (run), {SINGULAR} AS term FROM ({source})) WHERE term NOT IN ({STOPS})"


PARTS_INDEX = f"""tokens AS ({_parts(f'SELECT docid, field, unnest({RUNS}) AS run FROM texts')}),
lengths AS (
  SELECT field, docid, CAST(count(t.term) AS BIGINT) AS len
  FROM texts LEFT JOIN tokens t USING (field, docid) GROUP BY field, docid),
field_stats AS (
  SELECT field, CAST(count(*) AS BIGINT) AS n_field_docs,
         CAST(sum(len) AS BIGINT) AS total_len, avg(len) AS avg_len
  FROM lengths GROUP BY field),
postings AS (
  SELECT t.field, t.term, t.docid, t.tf, l.len
  FROM (SELECT field, term, docid, CAST(count(*) AS BIGINT) AS tf
        FROM tokens GROUP BY field, term, docid) t
  JOIN lengths l ON l.field = t.field AND l.docid = t.docid)"""

PARTS_BENCHMARK = f"""query_terms AS (
  SELECT query_id, term, count(*) AS qtf
  FROM ({_parts(f'SELECT item_id AS query_id, unnest({RUNS}) AS run FROM benchmark')})
  GROUP BY query_id, term)"""

ACCEPTED = "(doc_id % 10) >= 5"

SQL: dict[str, str] = {
    "ingest_valid": f"""
SELECT CAST(doc_id AS VARCHAR) AS docid, 'body' AS field, text AS value
FROM documents WHERE {ACCEPTED} AND text IS NOT NULL
UNION ALL
SELECT CAST(doc_id AS VARCHAR), 'language', lang
FROM documents WHERE {ACCEPTED} AND (doc_id % 10) <> 5 AND lang IS NOT NULL""",
    "ingest_quarantine": """
SELECT reason, CAST(count(*) AS BIGINT) AS n_records FROM (
  SELECT CASE doc_id % 10
           WHEN 0 THEN 'docid_missing' WHEN 1 THEN 'docid_not_string'
           WHEN 2 THEN 'docid_too_long' WHEN 3 THEN 'bad_json'
           WHEN 4 THEN 'field_not_string' END AS reason
  FROM documents) WHERE reason IS NOT NULL GROUP BY reason""",
    "field_projection": f"""
SELECT CAST(doc_id AS VARCHAR) AS docid,
       CAST(CASE WHEN text IS NULL THEN 0 ELSE 1 END
            + CASE WHEN lang IS NULL OR doc_id % 10 = 5 THEN 0 ELSE 1 END AS BIGINT) AS n_fields,
       CASE WHEN doc_id % 10 <> 5 THEN lang END AS language
FROM documents WHERE {ACCEPTED}""",
    "ingest_directory": """
SELECT CAST(item_id AS VARCHAR) AS docid, 'body' AS field, text,
       (SELECT CAST(count(*) AS BIGINT) FROM benchmark WHERE abs(item_id) % 6 NOT IN (2, 3)) AS n_docs
FROM benchmark WHERE abs(item_id) % 6 NOT IN (2, 3) AND text IS NOT NULL""",
    "token_stream": _with(
        [DOCUMENTS, INDEX],
        "SELECT docid, term, CAST(count(*) AS BIGINT) AS n FROM tokens GROUP BY docid, term",
    ),
    "analyzer_empty_terms": _with(
        [DOCUMENTS, INDEX],
        "SELECT docid, CAST(count(*) FILTER (WHERE term = '') AS BIGINT) AS n_empty,"
        " CAST(count(*) AS BIGINT) AS n_terms FROM tokens GROUP BY docid",
    ),
    "term_frequency": _with(
        [CONVERSATIONS, INDEX],
        "SELECT field, term, docid, CAST(count(*) AS BIGINT) AS tf FROM tokens"
        " GROUP BY field, term, docid",
    ),
    "field_lengths": _with([CONVERSATIONS, INDEX], "SELECT field, docid, len FROM lengths"),
    "avg_field_length": _with(
        [CONVERSATIONS, INDEX],
        "SELECT field, n_field_docs, total_len, round(avg_len, 6) AS avg_len FROM field_stats",
    ),
    "doc_count": "SELECT CAST(count(DISTINCT conv_id) AS BIGINT) AS n_docs FROM conversations",
    "vocabulary": _with(
        [DOCUMENTS, INDEX],
        "SELECT field, term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS cf"
        " FROM postings GROUP BY field, term",
    ),
    "index_postings": _with(
        [CONVERSATIONS, INDEX], "SELECT field, term, docid, tf, len FROM postings"
    ),
    "index_merge": _with([DOCUMENTS, INDEX], "SELECT term, docid, tf, len FROM postings"),
    "index_merge_overlap": _with(
        [CONVERSATIONS, INDEX],
        "SELECT field, term, docid, tf, len,"
        " (SELECT CAST(count(DISTINCT (conv_id, turn % 2)) AS BIGINT) FROM conversations) AS n_docs"
        " FROM postings",
    ),
    "index_roundtrip": _with(
        [CONVERSATIONS, INDEX],
        "SELECT field, term, docid, tf, len, n_docs FROM postings JOIN corpus_stats ON true"
        " WHERE field = 'assistant'",
    ),
    "index_append": _with(
        [CONVERSATIONS, INDEX],
        "SELECT field, term, docid, tf, len,"
        " (SELECT CAST(count(DISTINCT (conv_id, coalesce(turn % 3, 0))) AS BIGINT) FROM conversations) AS n_docs"
        " FROM postings",
    ),
    "index_compact": _with(
        [CONVERSATIONS, INDEX],
        "SELECT field, n_field_docs, total_len, round(avg_len, 6) AS avg_len FROM field_stats",
    ),
    "search_appended_topk": _search(DOCUMENTS, DOCUMENT_PARAMS, BENCHMARK, BEST_OF_EACH),
    "postings_lookup": _with(
        [DOCUMENTS, INDEX],
        "SELECT field, term, docid, tf, len FROM postings WHERE term = 'license'",
    ),
    "doc_frequency": _conversation_terms("SELECT term, df FROM document_frequencies"),
    "idf": _conversation_terms(
        "SELECT term, round(CAST(n_docs AS DOUBLE) / df, 6) AS idf"
        " FROM document_frequencies JOIN corpus_stats ON true"
    ),
    "matched_doc_length": _conversation_terms(
        "SELECT term, docid, weighted_len FROM matched_lengths"
    ),
    "bm25f_field_scores": _conversation_terms(
        "SELECT term, docid, field, round(score, 6) AS score FROM field_scores"
    ),
    "search_single_term": _search(DOCUMENTS, DOCUMENT_PARAMS, _tokens(["license"])),
    "search_multi_term": _search(CONVERSATIONS, CONVERSATION_PARAMS, _tokens(MULTI_TERM)),
    "search_no_length_norm": _search(
        CONVERSATIONS, CONVERSATION_PARAMS, _tokens(MULTI_TERM), length_norm="off"
    ),
    "search_field_subset": _search(
        CONVERSATIONS,
        {name: CONVERSATION_PARAMS[name] for name in ("assistant", "system")},
        _tokens(MULTI_TERM),
    ),
    "search_topk": _search(
        DOCUMENTS,
        DOCUMENT_PARAMS,
        _tokens(TOP_K_TERMS),
        "SELECT docid, score FROM hits ORDER BY score DESC, docid LIMIT 5",
    ),
    "search_ties": _search(
        PARTS,
        DOCUMENT_PARAMS,
        _tokens(["red", "green"]),
        "SELECT docid, score FROM hits ORDER BY score DESC, docid LIMIT 20",
    ),
    "search_pages": _search(PAGES, PAGE_PARAMS, _tokens(["div", "the", "about"])),
    "search_batch_topk": _search(DOCUMENTS, DOCUMENT_PARAMS, BENCHMARK, BEST_OF_EACH),
    "search_saved_topk": _search(DOCUMENTS, DOCUMENT_PARAMS, BENCHMARK, BEST_OF_EACH),
    "search_bounded_topk": _search(DOCUMENTS, DOCUMENT_PARAMS, BENCHMARK, BEST_OF_EACH),
    "search_bounded_fields": _search(CONVERSATIONS, CONVERSATION_SUBSET, BENCHMARK, BEST_OF_EACH),
    "search_phrase": _phrase_search(
        DOCUMENTS, DOCUMENT_PARAMS, _one_phrase(PHRASE), "SELECT docid, score FROM hits"
    ),
    "search_phrase_fields": _phrase_search(
        CONVERSATIONS, CONVERSATION_PARAMS, _one_phrase(FIELD_PHRASE), "SELECT docid, score FROM hits"
    ),
    "search_phrase_batch": _phrase_search(DOCUMENTS, DOCUMENT_PARAMS, BENCHMARK_PHRASES, BEST_OF_EACH),
    "search_textbook_topk": _by_model(DOCUMENTS, DOCUMENT_PARAMS, BENCHMARK, BEST_OF_EACH, TEXTBOOK_TERM),
    "search_textbook_fields": _by_model(
        CONVERSATIONS, CONVERSATION_PARAMS, _tokens(MULTI_TERM), "SELECT docid, score FROM hits", TEXTBOOK_TERM
    ),
    "search_dirichlet_topk": _by_model(
        DOCUMENTS, DOCUMENT_PARAMS, BENCHMARK, BEST_OF_EACH, DIRICHLET_TERM, DIRICHLET_DOCUMENT
    ),
    "search_dirichlet_fields": _by_model(
        CONVERSATIONS,
        CONVERSATION_PARAMS,
        _tokens(MULTI_TERM),
        "SELECT docid, score FROM hits",
        DIRICHLET_TERM,
        DIRICHLET_DOCUMENT,
    ),
    "analyzer_postings": _with([PAGES, PARTS_INDEX], "SELECT field, term, docid, tf, len FROM postings"),
    "search_analyzer_topk": _with(
        [
            DOCUMENTS,
            PARTS_INDEX,
            parameters_sql(DOCUMENT_PARAMS),
            PARTS_BENCHMARK,
            MATCHES,
            _field_scores(),
            HITS,
        ],
        BEST_OF_EACH,
    ),
    "frequent_ngrams": _with(
        [DOCUMENTS, LENGTH_TABLES, LISTS, _grams(LEAST_IN_DOCUMENTS)], "SELECT n, field, term, df, cf FROM frequent"
    ),
    "ngram_index": _with(
        [CONVERSATIONS, LENGTH_TABLES, LISTS, _grams(LEAST_IN_TURNS)], "SELECT field, term, docid, tf, len FROM postings"
    ),
    "search_ngrams": _with(
        [
            CONVERSATIONS,
            LENGTH_TABLES,
            LISTS,
            _grams(LEAST_IN_TURNS),
            parameters_sql(CONVERSATION_PARAMS),
            _tokens(GRAMS),
            MATCHES,
            _field_scores(),
            HITS,
        ],
        "SELECT docid, score FROM hits",
    ),
    "near_terms": _with(
        [DOCUMENTS, INDEX, VOCABULARY_TERMS, BENCHMARK_TERMS, _near("(SELECT term AS asked FROM benchmark_terms)", 1)],
        "SELECT asked, term, distance FROM near_terms",
    ),
    "search_fuzzy": _expanded_search(
        [_values("misspelled", "asked", MISSPELLED), _near("misspelled", 2)],
        "SELECT query_id, term FROM misspelled JOIN near_terms USING (asked)",
    ),
    "matching_terms": _with(
        [
            DOCUMENTS,
            INDEX,
            VOCABULARY_TERMS,
            BENCHMARK_TERMS,
            "patterns AS (SELECT DISTINCT left(term, 2) || '?*' || right(term, 2) AS pattern FROM benchmark_terms)",
        ],
        f"SELECT pattern, term FROM patterns JOIN vocabulary_terms ON term LIKE {_like('pattern')}",
    ),
    "search_pattern": _expanded_search(
        [_values("patterns", "pattern", PATTERNS)],
        f"SELECT query_id, term FROM patterns JOIN vocabulary_terms ON term LIKE {_like('pattern')}",
    ),
    "search_batch_all": _search(
        DOCUMENTS, DOCUMENT_PARAMS, BENCHMARK, "SELECT query_id, docid, score FROM hits"
    ),
}
