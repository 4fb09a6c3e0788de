"""Sinks: the ranked text report and table writers.

The report is built as rows ``(pos, line_no, line)`` with built-in string
functions, ordered by query position and line number, and written in
parallel; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- Fixed values: report layout of the reference. ---------------------------
SEPARATOR = "=" * 128
LABEL_WIDTH = 8
TERM_WIDTH = 64
FOUND_LABEL = "FOUND"
RANK_HEADER = "RANK"
TERM_HEADER = "TERM"
SIMILARITY_HEADER = "COSINE SIMILARITY"
NOT_FOUND_TEXT = "No term similar to {} has been found."
# -----------------------------------------------------------------------------


def _pad(col, width: int, fill: str):
    """Left-aligned field of at least ``width`` characters; longer values stay
    whole (Spark's rpad would cut them)."""
    return F.when(F.length(col) < width, F.rpad(col, width, fill)).otherwise(col)


def report_lines(queries: DataFrame, ranked: DataFrame) -> DataFrame:
    """``(pos, line_no, line)`` of the ranked report.

    ``queries`` is ``(pos, query)`` (see ``query_frame``), ``ranked`` is the
    output of ``similar_terms``. Line 0 of position 0 is the separator under
    the (dropped) banner; then per query in input order either a FOUND block
    (label, column header, one line per rank) or the not-found line, each
    closed by a separator. Similarities are printed with 9 decimals.
    """
    found = ranked.groupBy("query").agg(F.max("rank").alias("_last"))
    q = queries.join(found, "query", "left")
    is_found = F.col("_last").isNotNull()
    label = F.concat(F.rpad(F.lit(FOUND_LABEL), LABEL_WIDTH, " "), F.col("query"))
    header = F.lit(
        RANK_HEADER.ljust(LABEL_WIDTH) + TERM_HEADER.ljust(TERM_WIDTH) + SIMILARITY_HEADER
    )
    not_found = F.concat(
        F.lit(NOT_FOUND_TEXT.split("{}")[0]), F.col("query"), F.lit(NOT_FOUND_TEXT.split("{}")[1])
    )
    heads = q.select(
        "pos",
        F.explode(
            F.when(
                is_found,
                F.array(
                    F.struct(F.lit(0).alias("line_no"), label.alias("line")),
                    F.struct(F.lit(1).alias("line_no"), header.alias("line")),
                    F.struct((F.col("_last") + 2).alias("line_no"), F.lit(SEPARATOR).alias("line")),
                ),
            ).otherwise(
                F.array(
                    F.struct(F.lit(0).alias("line_no"), not_found.alias("line")),
                    F.struct(F.lit(1).alias("line_no"), F.lit(SEPARATOR).alias("line")),
                )
            )
        ).alias("h"),
    ).select("pos", F.col("h.line_no").alias("line_no"), F.col("h.line").alias("line"))
    rows = ranked.join(queries, "query").select(
        "pos",
        (F.col("rank") + 1).alias("line_no"),
        F.concat(
            _pad(F.col("rank").cast("string"), LABEL_WIDTH, " "),
            _pad(F.col("term"), TERM_WIDTH, "."),
            F.format_string("%.9f", F.col("similarity")),
        ).alias("line"),
    )
    top = queries.sparkSession.range(1).select(
        F.lit(0).alias("pos"), F.lit(0).alias("line_no"), F.lit(SEPARATOR).alias("line")
    )
    return top.unionByName(heads).unionByName(rows).select(
        F.col("pos").cast("int").alias("pos"), F.col("line_no").cast("int").alias("line_no"), "line"
    )


def write_report(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the report as text files whose concatenation in part order is the
    report (a global sort range-partitions the lines)."""
    lines.orderBy("pos", "line_no").select("line").write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    """Parquet sink for any result table (similarity, ranked, weights)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
