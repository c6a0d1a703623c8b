"""Fielded full-text indexing and ranked retrieval as Spark jobs."""

from termloom.functions.analyzer import analyzed_terms, chunk_count
from termloom.functions.analyzers import Analyzer, word_parts
from termloom.functions.bm25f import FieldParams, field_params
from termloom.operators.bounded import search_batch_bounded
from termloom.operators.bounds import Bounds, load_bounds, save_bounds, score_bounds
from termloom.operators.build import Index, build_index, merge_indexes, vocabulary
from termloom.operators.expand import fuzzy_terms, matching_terms, near_terms, pattern_terms
from termloom.operators.models import (
    DirichletLikelihood,
    TextbookBM25F,
    document_lengths,
    score_by_model,
    search_by_model,
)
from termloom.operators.ngrams import build_ngram_index, frequent_ngrams, ngram_postings
from termloom.operators.phrases import (
    Positions,
    build_positions,
    load_positions,
    phrase_matches,
    phrases_from_texts,
    save_positions,
    search_phrase,
    search_phrases,
)
from termloom.operators.retrieve import (
    lookup,
    query_terms,
    query_terms_from_texts,
    query_terms_from_tokens,
    rank_all,
    score_batch,
    score_term,
    search,
    search_batch,
    search_text,
    top_k,
)
from termloom.operators.tokens import tokenize
from termloom.sources.corpus import (
    Corpus,
    corpus_from_columns,
    corpus_from_records,
    corpus_from_rows,
    parse_records,
    read_corpus,
    read_json_directory,
    read_json_lines,
    split_records,
    stage_records,
)
from termloom.sources.generations import append_index, compact_index, index_parts, load_parts
from termloom.sources.store import load_index, save_index

__all__ = [
    "Analyzer",
    "Bounds",
    "Corpus",
    "DirichletLikelihood",
    "FieldParams",
    "Index",
    "Positions",
    "TextbookBM25F",
    "analyzed_terms",
    "append_index",
    "build_index",
    "build_ngram_index",
    "build_positions",
    "chunk_count",
    "compact_index",
    "corpus_from_columns",
    "corpus_from_records",
    "corpus_from_rows",
    "document_lengths",
    "field_params",
    "frequent_ngrams",
    "fuzzy_terms",
    "index_parts",
    "load_bounds",
    "load_index",
    "load_parts",
    "load_positions",
    "lookup",
    "matching_terms",
    "merge_indexes",
    "near_terms",
    "ngram_postings",
    "parse_records",
    "pattern_terms",
    "phrase_matches",
    "phrases_from_texts",
    "query_terms",
    "query_terms_from_texts",
    "query_terms_from_tokens",
    "rank_all",
    "read_corpus",
    "read_json_directory",
    "read_json_lines",
    "save_bounds",
    "save_index",
    "save_positions",
    "score_batch",
    "score_bounds",
    "score_by_model",
    "score_term",
    "search",
    "search_batch",
    "search_batch_bounded",
    "search_by_model",
    "search_phrase",
    "search_phrases",
    "search_text",
    "split_records",
    "stage_records",
    "tokenize",
    "top_k",
    "vocabulary",
    "word_parts",
]
