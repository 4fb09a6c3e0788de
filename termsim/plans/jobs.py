"""End-to-end jobs: what the reference's command line does, as DataFrame plans.

``lookup_job`` is the reference's main run (corpus + query terms -> ranked
report); ``matrix_job`` its ``--table`` dump; ``check_job`` its test run
(one similarity table against another). Each returns DataFrames; the
``write_*`` helpers run them against a sink. The caller owns the session.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termsim.functions.text import DEFAULT_PATTERN
from termsim.operators.compare import TOLERANCE, similarity_diff
from termsim.operators.frequencies import corpus_size, document_vectors, explode_terms, term_frequencies
from termsim.operators.lookup import QueryInput, query_frame, similar_terms, terms_not_found
from termsim.operators.report import report_lines, write_report, write_table
from termsim.operators.similarity import matrix_axis, similarity_matrix
from termsim.operators.weights import tfidf
from termsim.plans.materialize import materialize
from termsim.sources.corpus import DOCUMENT_ROWS, corpus_shape


@dataclass
class LookupResult:
    queries: DataFrame  # (pos, query)
    ranked: DataFrame  # (query, rank, term, similarity)
    not_found: DataFrame  # (pos, query)
    report: DataFrame  # (pos, line_no, line)


def lookup_job(
    spark: SparkSession,
    corpus: DataFrame,
    queries: QueryInput,
    pattern: str | None = DEFAULT_PATTERN,
    length: str = "filtered",
    search: str | None = None,
    n: int | None = 5,
    check_ids: bool = True,
) -> LookupResult:
    """All query terms in one plan; nothing runs until a sink is called."""
    qf = query_frame(spark, queries)
    ranked = similar_terms(corpus, queries, pattern, length, search, n, check_ids)
    return LookupResult(qf, ranked, terms_not_found(qf, ranked), report_lines(qf, ranked))


def write_lookup(result: LookupResult, out_dir: str, mode: str = "overwrite") -> None:
    """Ranked table as parquet plus the text report. The ranked rows are
    written once and the report is built from the written table, so the
    similarity work runs once."""
    ranked_path = f"{out_dir}/ranked"
    write_table(result.ranked, ranked_path, mode)
    spark = result.ranked.sparkSession
    ranked = spark.read.parquet(ranked_path)
    write_report(report_lines(result.queries, ranked), f"{out_dir}/report", mode)


def matrix_job(
    corpus: DataFrame,
    pattern: str | None = DEFAULT_PATTERN,
    length: str = "filtered",
    both_orders: bool = True,
    check_ids: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(cells, axis)``: the non-zero cells and the term axis of the matrix."""
    return (
        similarity_matrix(corpus, pattern, length, both_orders, check_ids),
        matrix_axis(corpus, pattern, length, check_ids),
    )


def write_matrix(cells: DataFrame, axis: DataFrame, out_dir: str, mode: str = "overwrite") -> None:
    """Dump the matrix as two parquet tables, written in parallel by the
    executors (the reference collects it to the driver)."""
    write_table(cells, f"{out_dir}/cells", mode)
    write_table(axis, f"{out_dir}/axis", mode)


def tfidf_job(
    corpus: DataFrame,
    pattern: str | None = DEFAULT_PATTERN,
    length: str = "filtered",
    check_ids: bool = True,
    folder: str | None = None,
) -> DataFrame:
    """``(term, doc_id, tf, idf, w)`` from one scan of the text: the counted
    documents are written once, and the corpus size, the document frequencies and
    the weights are read from there (only the columns that each needs)."""
    if corpus_shape(corpus) == DOCUMENT_ROWS:
        vectors = materialize(document_vectors(corpus, pattern, length).select("doc_id", "len", "terms"), "vectors", folder)
        tf = explode_terms(vectors, "terms", "e").select(
            "doc_id", F.col("e.term").alias("term"), (F.col("e.n") / F.col("len").cast("double")).alias("tf")
        )
        return tfidf(tf, corpus_size(vectors.select("doc_id", "terms"), check_ids))
    tf = materialize(term_frequencies(corpus, pattern, length).select("doc_id", "term", "tf"), "frequencies", folder)
    return tfidf(tf, corpus_size(corpus))


def check_job(left: DataFrame, right: DataFrame, tol: float = TOLERANCE) -> DataFrame:
    """Per-term verdicts of the comparison of two similarity tables."""
    return similarity_diff(left, right, tol)


def failed_terms(verdicts: DataFrame) -> DataFrame:
    return verdicts.where(~F.col("passed"))
