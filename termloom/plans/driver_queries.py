"""One query per operator over the driver's tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.analyzers import word_parts
from termloom.operators.bounded import search_batch_bounded
from termloom.operators.bounds import load_bounds, save_bounds, score_bounds
from termloom.operators.build import (
    build_index,
    corpus_statistics,
    field_lengths,
    field_statistics,
    merge_indexes,
    term_frequencies,
    vocabulary,
)
from termloom.operators.expand import (
    deletion_table,
    fuzzy_terms,
    gram_table,
    matching_terms,
    near_terms,
    pattern_terms,
    vocabulary_terms,
)
from termloom.operators.models import DirichletLikelihood, TextbookBM25F, score_by_model, search_by_model
from termloom.operators.ngrams import build_ngram_index, frequent_ngrams
from termloom.operators.phrases import (
    build_positions,
    load_positions,
    phrases_from_texts,
    save_positions,
    search_phrase,
    search_phrases,
)
from termloom.operators.retrieve import (
    document_frequency,
    gather_fields,
    lookup,
    query_terms_from_texts,
    query_terms_from_tokens,
    rank_all,
    rounded,
    score_batch,
    score_term,
    search,
    search_batch,
    term_idf,
    with_field_scores,
    with_weighted_length,
)
from termloom.operators.tokens import tokenize
from termloom.plans.tables import (
    CONVERSATION_PARAMS,
    DOCUMENT_PARAMS,
    PAGE_PARAMS,
    conversations_corpus,
    documents_corpus,
    pages_corpus,
    parts_corpus,
    read_table,
)
from termloom.scratch import scratch_path
from termloom.sources.corpus import (
    Corpus,
    corpus_from_columns,
    corpus_from_rows,
    parse_records,
    read_corpus,
    split_records,
)
from termloom.sources.generations import append_index, compact_index, load_parts
from termloom.sources.store import load_index, save_index

DECIMALS = 6

# --- ingest -----------------------------------------------------------------


def _parsed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as JSON, a kind of fault for each last digit of the id, parsed."""
    documents = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    digit = F.col("doc_id") % 10
    number = F.col("doc_id").cast("string")
    docid = F.to_json(F.struct(number.alias("docid")))
    fields = F.to_json(F.struct("text", F.when(digit != 5, F.col("lang")).alias("lang")))
    # {"docid":"1"} and {"text":"a","lang":"b"} to one object.
    good = F.concat(F.regexp_replace(docid, r"\}$", ","), F.substring(fields, 2, 2**31 - 1))
    record = (
        F.when(digit == 0, fields)
        .when(digit == 1, F.concat(F.lit('{"docid":'), number, F.lit("}")))
        .when(digit == 2, F.concat(F.lit('{"docid":"'), F.lpad(number, 33, "0"), F.lit('"}')))
        .when(digit == 3, F.concat(good, F.lit(" x")))
        .when(digit == 4, F.concat(F.lit('{"docid":"'), number, F.lit('","text":['), F.lit("]}")))
        .otherwise(good)
    )
    records = documents.select(number.alias("path"), record.cast("binary").alias("content"))
    return parse_records(records, {"text": "body", "lang": "language"})


def ingest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = split_records(_parsed_documents(spark, sf_dir))
    return docs.select("docid", F.explode("fields").alias("field", "value"))


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refused = split_records(_parsed_documents(spark, sf_dir))
    return refused.groupBy("reason").agg(F.count("*").alias("n_records"))


def field_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = split_records(_parsed_documents(spark, sf_dir))
    return docs.select(
        "docid",
        F.size("fields").cast("bigint").alias("n_fields"),
        F.try_element_at("fields", F.lit("language")).alias("language"),
    )


def _write_files(files: DataFrame, folder: str) -> None:
    """One file for each of ``files(name, content)``, in a folder that all tasks share."""
    local = folder.removeprefix("file://").removeprefix("file:")

    def write(batches):
        os.makedirs(local, exist_ok=True)
        for batch in batches:
            for name, content in zip(*(column.to_pylist() for column in batch.columns)):
                with open(f"{local}/{name}", "w", encoding="utf-8") as file:
                    file.write(content)
            yield batch.slice(0, 0)

    files.select("name", "content").mapInArrow(write, "name string, content string").count()


def ingest_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as a directory of files, a third of them with hidden names, some
    spoilt and some with another extension; what of it is accepted."""
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    number = F.col("item_id").cast("string")
    digit = F.abs(F.col("item_id")) % 6
    name = F.concat(
        F.when(digit == 0, F.lit("_")).when(digit == 1, F.lit(".")).otherwise(F.lit("")),
        F.lit("item"),
        number,
        F.when(digit == 2, F.lit(".JSON")).otherwise(F.lit(".json")),
    )
    record = F.to_json(F.struct(number.alias("docid"), "text"))
    content = F.when(digit == 3, F.concat(record, F.lit("}"))).otherwise(record)
    folder = scratch_path(spark, "directory")
    _write_files(items.where("item_id IS NOT NULL").select(name.alias("name"), content.alias("content")), folder)
    corpus = read_corpus(spark, folder, {"text": "body"})
    n_docs = corpus_statistics(corpus.records).scalar()
    return corpus.texts.select("docid", "field", "text", n_docs.alias("n_docs"))


# --- analysis ---------------------------------------------------------------


def token_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tokenize(documents_corpus(spark, sf_dir).texts)
    return tokens.groupBy("docid", "term").agg(F.count("*").alias("n"))


def analyzer_empty_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tokenize(documents_corpus(spark, sf_dir).texts)
    return tokens.groupBy("docid").agg(
        F.count_if(F.col("term") == "").alias("n_empty"), F.count("*").alias("n_terms")
    )


# --- index ------------------------------------------------------------------


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_frequencies(conversations_corpus(spark, sf_dir).texts)


def conversation_field_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_lengths(conversations_corpus(spark, sf_dir).texts)


def avg_field_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = field_lengths(conversations_corpus(spark, sf_dir).texts)
    return field_statistics(lengths).withColumn("avg_len", F.round("avg_len", DECIMALS))


def doc_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_statistics(conversations_corpus(spark, sf_dir).records)


def documents_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary(build_index(documents_corpus(spark, sf_dir)).postings)


def index_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_index(conversations_corpus(spark, sf_dir)).postings


def _half(number: str) -> Column:
    """0 or 1 for every row; a null is in the first half."""
    return F.coalesce(F.pmod(number, F.lit(2)), F.lit(0))


def index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches that together hold all documents."""
    documents = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    even, odd = (
        build_index(
            corpus_from_columns(documents.where(_half("doc_id") == r), "doc_id", {"text": "text"})
        )
        for r in (0, 1)
    )
    return merge_indexes(even, odd).postings.select("term", "docid", "tf", "len")


def index_merge_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of all turns, so that most conversations are in both."""
    turns = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    even, odd = (
        build_index(corpus_from_rows(turns.where(_half("turn") == r), "conv_id", "role", "text"))
        for r in (0, 1)
    )
    merged = merge_indexes(even, odd)
    n_docs = merged.corpus_stats.select("n_docs").scalar()
    return merged.postings.withColumn("n_docs", n_docs)


def index_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "index")
    save_index(build_index(conversations_corpus(spark, sf_dir)), path, shards=4)
    loaded = load_index(spark, path, ["assistant"])
    return loaded.postings.select(
        "field", "term", "docid", "tf", "len", loaded.corpus_stats.scalar().alias("n_docs")
    )


PARTS = 3


def _third(number: str) -> Column:
    return F.coalesce(F.pmod(number, F.lit(PARTS)), F.lit(0))


def _appended(spark: SparkSession, corpora: list[Corpus]) -> str:
    """A saved index to which each corpus was appended in turn."""
    path = scratch_path(spark, "parts")
    for i, corpus in enumerate(corpora):
        append_index(build_index(corpus), path, shards=4, first=i == 0)
    return path


def _turns_in_parts(spark: SparkSession, sf_dir: str) -> str:
    """All turns in three parts, so that many conversations are in several of them."""
    turns = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return _appended(
        spark,
        [corpus_from_rows(turns.where(_third("turn") == r), "conv_id", "role", "text") for r in range(PARTS)],
    )


def index_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = load_parts(spark, _turns_in_parts(spark, sf_dir))
    return index.postings.select(
        "field", "term", "docid", "tf", "len", index.corpus_stats.scalar().alias("n_docs")
    )


def index_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _turns_in_parts(spark, sf_dir)
    compact_index(spark, path)
    stats = load_parts(spark, path).field_stats
    return stats.withColumn("avg_len", F.round("avg_len", DECIMALS))


def search_appended_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch search over documents that came in three parts."""
    documents = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    corpora = [
        corpus_from_columns(documents.where(_third("doc_id") == r), "doc_id", {"text": "text"})
        for r in range(PARTS)
    ]
    index = load_parts(spark, _appended(spark, corpora))
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    query = query_terms_from_texts(items, "item_id", "text")
    return search_batch(index, query, DOCUMENT_PARAMS, k=5, decimals=DECIMALS)


# --- retrieval --------------------------------------------------------------


def postings_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(documents_corpus(spark, sf_dir))
    return lookup(index, query_terms_from_tokens(index, ["license"]), ["text"])


def _gathered_conversations(spark: SparkSession, sf_dir: str) -> tuple:
    """Every posting of the conversations, fields put together."""
    index = build_index(conversations_corpus(spark, sf_dir))
    postings = index.postings.where(F.col("field").isin(sorted(CONVERSATION_PARAMS)))
    return index, gather_fields(postings, CONVERSATION_PARAMS)


def doc_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, gathered = _gathered_conversations(spark, sf_dir)
    return document_frequency(gathered)


def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, gathered = _gathered_conversations(spark, sf_dir)
    values = term_idf(index, document_frequency(gathered))
    return values.select("term", F.round("idf", DECIMALS).alias("idf"))


def matched_doc_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, gathered = _gathered_conversations(spark, sf_dir)
    return with_weighted_length(gathered, CONVERSATION_PARAMS).select(
        "term", "docid", "weighted_len"
    )


def bm25f_field_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, gathered = _gathered_conversations(spark, sf_dir)
    scored = with_field_scores(gathered, index.field_stats, CONVERSATION_PARAMS)
    pairs = [
        F.struct(F.lit(name).alias("field"), F.round(f"score{i}", DECIMALS).alias("score"))
        for i, name in enumerate(sorted(CONVERSATION_PARAMS))
    ]
    return scored.select("term", "docid", F.inline(F.array(*pairs))).where("score IS NOT NULL")


def search_single_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(documents_corpus(spark, sf_dir))
    return rounded(score_term(index, "license", DOCUMENT_PARAMS), DECIMALS)


CONVERSATION_SUBSET = {name: CONVERSATION_PARAMS[name] for name in ("assistant", "system")}

# The tokens of the searches. "you" twice counts twice.
MULTI_TERM = ["how", "you", "the", "you", "please"]
TOP_K_TERMS = ["license", "the", "data"]


def search_multi_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(conversations_corpus(spark, sf_dir))
    return search(index, MULTI_TERM, CONVERSATION_PARAMS, decimals=DECIMALS)


def search_no_length_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(conversations_corpus(spark, sf_dir))
    return search(
        index, MULTI_TERM, CONVERSATION_PARAMS, length_norm="off", decimals=DECIMALS
    )


def search_field_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the three fields: the document frequencies count those only."""
    index = build_index(conversations_corpus(spark, sf_dir))
    params = {name: CONVERSATION_PARAMS[name] for name in ("assistant", "system")}
    return search(index, MULTI_TERM, params, decimals=DECIMALS)


def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(documents_corpus(spark, sf_dir))
    return search(index, TOP_K_TERMS, DOCUMENT_PARAMS, k=5, decimals=DECIMALS)


def search_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few different names, so that nearly all scores tie."""
    index = build_index(parts_corpus(spark, sf_dir))
    return search(index, ["red", "green"], DOCUMENT_PARAMS, k=20, decimals=DECIMALS)


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short and a long field; the query comes from a text."""
    index = build_index(pages_corpus(spark, sf_dir))
    return search(index, ["div", "the", "about"], PAGE_PARAMS, decimals=DECIMALS)


def _benchmark_search(spark: SparkSession, sf_dir: str) -> tuple:
    index = build_index(documents_corpus(spark, sf_dir))
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    return index, query_terms_from_texts(items, "item_id", "text")


def search_batch_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: every benchmark item as a query, its best five documents."""
    index, query = _benchmark_search(spark, sf_dir)
    return search_batch(index, query, DOCUMENT_PARAMS, k=5, decimals=DECIMALS)


def search_saved_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship on an index that was saved in shards and opened again."""
    index, query = _benchmark_search(spark, sf_dir)
    path = scratch_path(spark, "index")
    save_index(index, path, shards=4)
    loaded = load_index(spark, path, sorted(DOCUMENT_PARAMS))
    return search_batch(loaded, query, DOCUMENT_PARAMS, k=5, decimals=DECIMALS)


def _saved_with_bounds(spark: SparkSession, corpus: Corpus, fields: list[str]) -> tuple:
    path = scratch_path(spark, "index")
    save_index(build_index(corpus), path, shards=4)
    save_bounds(score_bounds(load_index(spark, path)), path)
    return load_index(spark, path, fields), load_bounds(spark, path)


def search_bounded_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship by bounds: matches that cannot be among the best are not scored."""
    index, bounds = _saved_with_bounds(spark, documents_corpus(spark, sf_dir), ["text"])
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    query = query_terms_from_texts(items, "item_id", "text")
    return search_batch_bounded(index, bounds, query, DOCUMENT_PARAMS, k=5, decimals=DECIMALS)


def search_bounded_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items against two of the three fields of conversations, by bounds."""
    fields = sorted(CONVERSATION_SUBSET)
    index, bounds = _saved_with_bounds(spark, conversations_corpus(spark, sf_dir), fields)
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    query = query_terms_from_texts(items, "item_id", "text")
    return search_batch_bounded(index, bounds, query, CONVERSATION_SUBSET, k=5, decimals=DECIMALS)


# --- phrases ------------------------------------------------------------------

# The phrases searched; repeated tokens count for each place.
PHRASE = ["the", "the", "the"]
FIELD_PHRASE = ["the", "the", "of"]
LEADING_TERMS = 3


def search_one_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = documents_corpus(spark, sf_dir)
    return search_phrase(build_index(corpus), build_positions(corpus), PHRASE, DOCUMENT_PARAMS, decimals=DECIMALS)


def search_phrase_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A phrase in three fields of many rows each; it never runs from turn to turn."""
    corpus = conversations_corpus(spark, sf_dir)
    index, positions = build_index(corpus), build_positions(corpus)
    return search_phrase(index, positions, FIELD_PHRASE, CONVERSATION_PARAMS, decimals=DECIMALS)


def search_phrase_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first terms of every benchmark item as a phrase, on saved positions."""
    corpus = documents_corpus(spark, sf_dir)
    path = scratch_path(spark, "index")
    save_positions(build_positions(corpus), path, 4)
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    phrases = phrases_from_texts(items, "item_id", "text").where(F.col("slot") < LEADING_TERMS)
    positions = load_positions(spark, path, 4)
    return search_phrases(build_index(corpus), positions, phrases, DOCUMENT_PARAMS, k=5, decimals=DECIMALS)


# --- other models -------------------------------------------------------------------

# The parameters of the models.
TEXTBOOK = TextbookBM25F(k1=1.2, b=0.75)
DIRICHLET = DirichletLikelihood(mu=1000.0)
DOCUMENT_WEIGHTS = {name: p.weight for name, p in DOCUMENT_PARAMS.items()}
CONVERSATION_WEIGHTS = {name: p.weight for name, p in CONVERSATION_PARAMS.items()}


def search_textbook_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, query = _benchmark_search(spark, sf_dir)
    return search_by_model(index, query, DOCUMENT_WEIGHTS, TEXTBOOK, k=5, decimals=DECIMALS)


def search_dirichlet_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, query = _benchmark_search(spark, sf_dir)
    return search_by_model(index, query, DOCUMENT_WEIGHTS, DIRICHLET, k=5, decimals=DECIMALS)


def _conversations_by(spark: SparkSession, sf_dir: str, model) -> DataFrame:
    index = build_index(conversations_corpus(spark, sf_dir))
    query = query_terms_from_tokens(index, MULTI_TERM)
    hits = rounded(score_by_model(index, query, CONVERSATION_WEIGHTS, model), DECIMALS)
    return hits.select("docid", "score")


def search_textbook_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fields: lengths count those that a term is not in, too."""
    return _conversations_by(spark, sf_dir, TEXTBOOK)


def search_dirichlet_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conversations_by(spark, sf_dir, DIRICHLET)


# --- another analyzer ---------------------------------------------------------------

# Words that the analyzer leaves out.
STOP_WORDS = ["a", "and", "of", "the", "to"]
PARTS_OF_WORDS = word_parts(STOP_WORDS, plurals=True)


def analyzer_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses and markup by runs of letters and digits."""
    index = build_index(pages_corpus(spark, sf_dir), analyzer=PARTS_OF_WORDS)
    return index.postings.select("field", "term", "docid", "tf", "len")


def search_analyzer_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch search with documents and queries by the same other analyzer, saved."""
    path = scratch_path(spark, "index")
    save_index(build_index(documents_corpus(spark, sf_dir), analyzer=PARTS_OF_WORDS), path, shards=4)
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    query = query_terms_from_texts(items, "item_id", "text", PARTS_OF_WORDS)
    return search_batch(load_index(spark, path), query, DOCUMENT_PARAMS, k=5, decimals=DECIMALS)


# --- n-grams ------------------------------------------------------------------------

# Sizes and thresholds of the grams, and grams to search for.
LONGEST_GRAM, LEAST_IN_DOCUMENTS, LEAST_IN_TURNS = 4, 5, 2
GRAMS = ["the the of", "and the", "of the", "the"]


def documents_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequent_ngrams(documents_corpus(spark, sf_dir), LONGEST_GRAM, LEAST_IN_DOCUMENTS)


def _ngrams_of_turns(spark: SparkSession, sf_dir: str):
    return build_ngram_index(conversations_corpus(spark, sf_dir), LONGEST_GRAM, LEAST_IN_TURNS)


def ngram_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fields, and grams that never run from turn to turn."""
    return _ngrams_of_turns(spark, sf_dir).postings


def search_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_ngrams_of_turns(spark, sf_dir), GRAMS, CONVERSATION_PARAMS, decimals=DECIMALS)


# --- near and matching terms ----------------------------------------------------

# Terms with misspellings, and patterns.
MISSPELLED = ["lisense", "thw", "publik"]
PATTERNS = ["licen*", "*blic", "th?t"]


def _benchmark_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    texts = items.select(F.col("item_id").alias("docid"), F.lit("").alias("field"), "text")
    return tokenize(texts).select("term").distinct()


def near_terms_of_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term of the benchmark, and the terms of the documents one edit away or less."""
    terms = vocabulary_terms(build_index(documents_corpus(spark, sf_dir)))
    asked = _benchmark_terms(spark, sf_dir).withColumnRenamed("term", "asked")
    return near_terms(asked, deletion_table(terms, 1), 1)


def search_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(documents_corpus(spark, sf_dir))
    asked = spark.createDataFrame([(i, term) for i, term in enumerate(MISSPELLED)], "query_id int, term string")
    query = fuzzy_terms(index, asked, distance=2)
    return search_batch(index, query, DOCUMENT_PARAMS, k=5, decimals=DECIMALS)


def matching_terms_of_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pattern for every term of the benchmark (its beginning, one character, its end),
    and the terms of the documents that match."""
    terms = vocabulary_terms(build_index(documents_corpus(spark, sf_dir)))
    asked = _benchmark_terms(spark, sf_dir)
    pattern = F.concat(F.left("term", F.lit(2)), F.lit("?*"), F.right("term", F.lit(2)))
    return matching_terms(asked.select(pattern.alias("pattern")), gram_table(terms))


def search_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(documents_corpus(spark, sf_dir))
    asked = spark.createDataFrame([(i, term) for i, term in enumerate(PATTERNS)], "query_id int, term string")
    return search_batch(index, pattern_terms(index, asked), DOCUMENT_PARAMS, k=5, decimals=DECIMALS)


def search_batch_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hit of every benchmark item, best first."""
    index, query = _benchmark_search(spark, sf_dir)
    return rank_all(rounded(score_batch(index, query, DOCUMENT_PARAMS), DECIMALS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_valid": ingest_valid,
    "ingest_quarantine": ingest_quarantine,
    "field_projection": field_projection,
    "ingest_directory": ingest_directory,
    "token_stream": token_stream,
    "analyzer_empty_terms": analyzer_empty_terms,
    "term_frequency": term_frequency,
    "field_lengths": conversation_field_lengths,
    "avg_field_length": avg_field_length,
    "doc_count": doc_count,
    "vocabulary": documents_vocabulary,
    "index_postings": index_postings,
    "index_merge": index_merge,
    "index_merge_overlap": index_merge_overlap,
    "index_roundtrip": index_roundtrip,
    "index_append": index_append,
    "index_compact": index_compact,
    "search_appended_topk": search_appended_topk,
    "postings_lookup": postings_lookup,
    "doc_frequency": doc_frequency,
    "idf": idf,
    "matched_doc_length": matched_doc_length,
    "bm25f_field_scores": bm25f_field_scores,
    "search_single_term": search_single_term,
    "search_multi_term": search_multi_term,
    "search_no_length_norm": search_no_length_norm,
    "search_field_subset": search_field_subset,
    "search_topk": search_topk,
    "search_ties": search_ties,
    "search_pages": search_pages,
    "search_batch_topk": search_batch_topk,
    "search_saved_topk": search_saved_topk,
    "search_bounded_topk": search_bounded_topk,
    "search_bounded_fields": search_bounded_fields,
    "search_phrase": search_one_phrase,
    "search_phrase_fields": search_phrase_fields,
    "search_phrase_batch": search_phrase_batch,
    "search_textbook_topk": search_textbook_topk,
    "search_textbook_fields": search_textbook_fields,
    "search_dirichlet_topk": search_dirichlet_topk,
    "search_dirichlet_fields": search_dirichlet_fields,
    "analyzer_postings": analyzer_postings,
    "search_analyzer_topk": search_analyzer_topk,
    "frequent_ngrams": documents_ngrams,
    "ngram_index": ngram_index,
    "search_ngrams": search_ngrams,
    "near_terms": near_terms_of_items,
    "search_fuzzy": search_fuzzy,
    "matching_terms": matching_terms_of_items,
    "search_pattern": search_pattern,
    "search_batch_all": search_batch_all,
}
