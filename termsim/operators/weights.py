"""Document frequency, IDF, TF-IDF weights and term norms.

``idf = ln(N / df)`` (natural log, no smoothing). ``N`` enters as a scalar
subquery over the one-row corpus size, so it is computed once inside the same
job and never joined.

Norms use ``||w_t|| = idf_t * sqrt(sum_d tf_{t,d}^2)``: the IDF is one factor
per term, so the norm follows from per-term sums and the postings are not
joined with the IDF table to get it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def term_stats(tf: DataFrame) -> DataFrame:
    """``(term, df, sumsq)`` with ``sumsq = sum_d tf^2``; one partial+final
    aggregate keyed by term (map-side combine absorbs hot terms)."""
    return tf.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum(F.col("tf") * F.col("tf")).alias("sumsq")
    )


def document_frequency(tf: DataFrame) -> DataFrame:
    """``(term, df)``: number of documents holding the kept term."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def _idf(df_col, n_docs: DataFrame):
    return F.ln(n_docs.scalar().cast("double") / df_col.cast("double"))


def idf(tf: DataFrame, n_docs: DataFrame) -> DataFrame:
    """``(term, df, idf)``."""
    return document_frequency(tf).select("term", "df", _idf(F.col("df"), n_docs).alias("idf"))


def tfidf(tf: DataFrame, n_docs: DataFrame) -> DataFrame:
    """``(term, doc_id, tf, idf, w)`` with ``w = tf * idf``: the sparse term
    vectors over documents (the postings joined with the IDF on term)."""
    return (
        tf.join(idf(tf, n_docs), "term")
        .select("term", "doc_id", "tf", "idf", (F.col("tf") * F.col("idf")).alias("w"))
    )


def term_norms(tf: DataFrame, n_docs: DataFrame) -> DataFrame:
    """``(term, df, idf, norm)``: L2 norm of each TF-IDF term vector over all of
    its documents. A term found in every document has idf 0 and norm 0."""
    with_idf = term_stats(tf).select("term", "df", "sumsq", _idf(F.col("df"), n_docs).alias("idf"))
    return with_idf.select("term", "df", "idf", (F.col("idf") * F.sqrt("sumsq")).alias("norm"))
