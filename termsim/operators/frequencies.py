"""Term frequencies, document lengths and corpus size.

For document rows the counting happens inside each row (sort + run-length
count of the token array), so no shuffle is needed to get term frequencies:
a document already lives in one row. Occurrence rows are counted with
``groupBy`` (partial aggregation first, so a hot document id is split over
its terms before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsim.functions.text import (
    DEFAULT_PATTERN,
    count_runs,
    keep_matching,
    run_starts,
    total_count,
)
from termsim.sources.corpus import DOCUMENT_ROWS, corpus_shape

LENGTH_MODES = ("filtered", "original")


def _check_length(length: str) -> None:
    if length not in LENGTH_MODES:
        raise ValueError(f"length must be one of {LENGTH_MODES}, not {length!r}")


def document_vectors(
    corpus: DataFrame, pattern: str | None = DEFAULT_PATTERN, length: str = "filtered"
) -> DataFrame:
    """Document rows -> ``(doc_id, orig_len, kept_len, len, terms)``.

    ``terms`` is ``ARRAY<STRUCT<term, n>>``: the distinct kept terms of the
    document in term order with their counts. ``len`` is the TF denominator:
    ``kept_len`` (default) or ``orig_len`` (``length='original'``). The pattern
    is tested once per distinct term of a document, not once per token.
    """
    _check_length(length)
    if corpus_shape(corpus) != DOCUMENT_ROWS:
        raise ValueError("document_vectors needs document rows (doc_id, terms)")
    # a NULL entry is no term (as in occurrence rows); tokenized text has none
    terms = F.array_compact("terms") if corpus.schema["terms"].dataType.containsNull else F.col("terms")
    sorted_docs = corpus.select(
        "doc_id",
        F.size(terms).cast("bigint").alias("orig_len"),
        # native ordering (binary string order)
        F.sort_array(terms).alias("_sorted"),
    )
    with_starts = sorted_docs.select("doc_id", "orig_len", "_sorted", run_starts("_sorted").alias("_starts"))
    counted = with_starts.select(
        "doc_id", "orig_len", keep_matching(count_runs("_sorted", "_starts"), pattern).alias("terms")
    )
    with_len = counted.select("doc_id", "orig_len", total_count(F.col("terms")).alias("kept_len"), "terms")
    return fence(
        with_len.select(
            "doc_id",
            "orig_len",
            "kept_len",
            F.col("kept_len" if length == "filtered" else "orig_len").alias("len"),
            "terms",
        ),
        ["orig_len", "kept_len", "len", "terms"],
    )


def fence(df: DataFrame, computed: list[str]) -> DataFrame:
    """Keep later filters on ``computed`` columns above this point.

    Catalyst pushes a filter below projections by substituting the projected
    expressions. For the array columns built here (sort, run starts, run
    counts: each step refers to the previous one several times, also inside
    lambdas) the substituted expression recomputes the earlier steps per array
    element, which turns O(k log k) per document into O(k^3). A predicate on
    the output of a generator is not pushed below it, so the columns go
    through a one-element ``explode_outer`` (``outer``: no inferred size filter).
    """
    keep = [c for c in df.columns if c not in computed]
    boxed = df.select(*keep, F.explode_outer(F.array(F.struct(*computed))).alias("_v"))
    return boxed.select(*keep, *[F.col(f"_v.{c}").alias(c) for c in computed]).select(*df.columns)


def explode_terms(vec: DataFrame, column: str = "terms", alias: str = "e") -> DataFrame:
    """One row per entry of an array column, keeping the other columns.

    ``explode_outer`` plus a NULL filter instead of ``explode``: for an inner
    explode Catalyst infers ``size(array) > 0`` and pushes it below the
    projections, which would rebuild the array (tokenize, sort, count) twice.
    """
    others = [c for c in vec.columns if c != column]
    return vec.select(*others, F.explode_outer(column).alias(alias)).where(F.col(alias).isNotNull())


def doc_lengths(corpus: DataFrame, pattern: str | None = DEFAULT_PATTERN) -> DataFrame:
    """``(doc_id, orig_len, kept_len)``: length before and after the term filter."""
    if corpus_shape(corpus) == DOCUMENT_ROWS:
        return document_vectors(corpus, pattern).select("doc_id", "orig_len", "kept_len")
    return _occurrence_lengths(corpus, pattern)


def _kept(term: Column, pattern: str | None) -> Column:
    return term.isNotNull() if pattern is None else term.rlike(pattern)


def _occurrence_lengths(occ: DataFrame, pattern: str | None) -> DataFrame:
    return occ.groupBy("doc_id").agg(
        F.count("term").alias("orig_len"),
        F.count(F.when(_kept(F.col("term"), pattern), F.lit(1))).alias("kept_len"),
    )


def term_frequencies(
    corpus: DataFrame, pattern: str | None = DEFAULT_PATTERN, length: str = "filtered"
) -> DataFrame:
    """Long TF table ``(doc_id, term, n, len, tf)``, one row per (document, kept term).

    ``tf = n / len`` with ``len`` the filtered (default) or original length.
    """
    _check_length(length)
    if corpus_shape(corpus) == DOCUMENT_ROWS:
        vec = document_vectors(corpus, pattern, length)
        return explode_terms(vec).select(
            "doc_id",
            F.col("e.term").alias("term"),
            F.col("e.n").alias("n"),
            "len",
            (F.col("e.n") / F.col("len")).alias("tf"),
        )
    counts = (
        corpus.where(_kept(F.col("term"), pattern))
        .groupBy("doc_id", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    lens = _occurrence_lengths(corpus, pattern).select(
        "doc_id", F.col("kept_len" if length == "filtered" else "orig_len").alias("len")
    )
    return counts.join(lens, "doc_id").select(
        "doc_id", "term", "n", "len", (F.col("n") / F.col("len")).alias("tf")
    )


def corpus_size(corpus: DataFrame, check_ids: bool = True) -> DataFrame:
    """One-row DataFrame ``(n_docs)``: every document, also those whose terms
    were all filtered away or that have no terms.

    For document rows ids must be unique; with ``check_ids`` a repeated id
    makes the value raise an error when it is evaluated (lazily, inside the
    job that uses it). For occurrence rows it is the number of distinct ids.
    """
    if corpus_shape(corpus) == DOCUMENT_ROWS:
        if not check_ids:
            return corpus.agg(F.count(F.lit(1)).alias("n_docs"))
        counted = corpus.agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id").alias("ids")
        )
        return counted.select(
            F.when(F.col("rows") == F.col("ids"), F.col("rows"))
            .otherwise(F.raise_error(F.lit("repeated or NULL doc_id in the corpus; use on_duplicate='merge'")))
            .cast("bigint")
            .alias("n_docs")
        )
    return corpus.agg(F.count_distinct("doc_id").alias("n_docs"))
