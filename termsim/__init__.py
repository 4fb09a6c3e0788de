"""termsim: term similarity over document collections, on Spark DataFrames.

Public API (each call builds a lazy DataFrame; nothing runs until a sink or
an action)::

    corpus = read_corpus(spark, "hdfs:///corpus/*.txt")        # or corpus_from_table / corpus_from_pairs
    ranked = similar_terms(corpus, ["dis_gist_dis", "gene_egfr+_gene"], n=10)
    matrix = similarity_matrix(corpus)
"""

from termsim.functions.text import DEFAULT_PATTERN, WHITESPACE_RUN, tokenize
from termsim.operators.compare import similarity_cell_diff, similarity_diff
from termsim.operators.frequencies import (
    corpus_size,
    doc_lengths,
    document_vectors,
    term_frequencies,
)
from termsim.operators.lookup import (
    cosine_pairs,
    query_frame,
    query_similarities,
    rank_terms,
    similar_terms,
    terms_not_found,
    weight_dots,
)
from termsim.operators.report import report_lines, write_report, write_table
from termsim.operators.similarity import matrix_axis, pair_dots, similarity_matrix
from termsim.operators.weights import document_frequency, idf, term_norms, term_stats, tfidf
from termsim.sources.corpus import (
    corpus_from_pairs,
    corpus_from_table,
    parse_lines,
    read_corpus,
    to_occurrences,
)

__all__ = [
    "DEFAULT_PATTERN",
    "WHITESPACE_RUN",
    "corpus_from_pairs",
    "corpus_from_table",
    "corpus_size",
    "cosine_pairs",
    "doc_lengths",
    "document_frequency",
    "document_vectors",
    "idf",
    "matrix_axis",
    "pair_dots",
    "parse_lines",
    "query_frame",
    "query_similarities",
    "rank_terms",
    "read_corpus",
    "report_lines",
    "similar_terms",
    "similarity_cell_diff",
    "similarity_diff",
    "similarity_matrix",
    "term_frequencies",
    "term_norms",
    "term_stats",
    "terms_not_found",
    "tfidf",
    "to_occurrences",
    "tokenize",
    "weight_dots",
    "write_report",
    "write_table",
]
