"""Corpus sources: text files, text tables, (document, term) tables."""

from termsim.sources.corpus import (
    DOCUMENT_ROWS,
    OCCURRENCE_ROWS,
    corpus_from_pairs,
    corpus_from_table,
    corpus_shape,
    parse_lines,
    read_corpus,
    to_occurrences,
)

__all__ = [
    "DOCUMENT_ROWS",
    "OCCURRENCE_ROWS",
    "corpus_from_pairs",
    "corpus_from_table",
    "corpus_shape",
    "parse_lines",
    "read_corpus",
    "to_occurrences",
]
