"""Corpus sources.

A corpus comes in one of two shapes, told apart by its columns:

* **document rows** ``(doc_id, terms ARRAY<STRING>)``: one row per document,
  ids unique. Per-document work (term counts, term pairs) then happens inside
  the row, with no shuffle. Text files and text tables give this shape.
* **occurrence rows** ``(doc_id, term STRING)``: one row per term occurrence; a
  row with a NULL term only records that the document exists (it has no
  terms but still counts in the corpus size). Key/value tables such as order
  lines give this shape, and so does merging repeated document ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termsim.functions.text import has_token, tokenize

# The first token of a line: the separator class of ``WHITESPACE_RUN``, negated.
FIRST_TOKEN = r"^[\s\x1c-\x1f\x85\p{Z}]*([^\s\x1c-\x1f\x85\p{Z}]+)"

# Inputs estimated below this many bytes are spread over all tasks.
SPREAD_BYTES = 64 << 20

DOCUMENT_ROWS = "document rows"
OCCURRENCE_ROWS = "occurrence rows"


def corpus_shape(corpus: DataFrame) -> str:
    cols = set(corpus.columns)
    if {"doc_id", "terms"} <= cols:
        return DOCUMENT_ROWS
    if {"doc_id", "term"} <= cols:
        return OCCURRENCE_ROWS
    raise ValueError(
        "a corpus needs columns (doc_id, terms) or (doc_id, term); got " + ", ".join(corpus.columns)
    )


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """One line = one document: first token is the id, the rest are its terms.

    Lines are split on runs of whitespace (no trimming needed). Blank lines are
    not documents and are dropped; a line holding only an id is a document with
    no terms.
    """
    # The blank-line test runs on the raw text: a test on the token array would
    # be pushed below the projection and tokenize every line twice.
    # The id is cut from the raw line, so counting documents tokenizes nothing.
    toks = lines.where(has_token(F.col(column))).select(
        F.regexp_extract(F.col(column), FIRST_TOKEN, 1).alias("doc_id"), tokenize(F.col(column)).alias("_tokens")
    )
    return toks.select("doc_id", F.slice("_tokens", 2, F.size("_tokens") - 1).alias("terms"))


def read_corpus(
    spark: SparkSession, path: str | list[str], on_duplicate: str = "error"
) -> DataFrame:
    """Distributed scan of text files with one document per line.

    ``on_duplicate='error'`` (default) keeps document rows; a repeated id makes
    the corpus size fail when it is evaluated. ``'merge'`` returns occurrence
    rows, so lines with the same id form one document (counts and lengths add
    up, the corpus size counts the id once).
    """
    docs = parse_lines(spread(spark.read.text(path)))
    return _apply_duplicate_mode(docs, on_duplicate)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows of a small input over ``min_partitions`` tasks (default:
    the session's parallelism).

    A parquet file is split by row groups, so a small table written as one row
    group is read by one task and all per-document work (tokenize, sort, count,
    pairs) would run on one core. Small is judged by the optimizer's estimate,
    which runs no job; a large input has its own splits and is left alone (no
    shuffle of the raw text).
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:  # a Spark Connect session has no local plan: keep the scan
        return df
    size = int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= SPREAD_BYTES:
        return df
    return df.repartition(min_partitions or df.sparkSession.sparkContext.defaultParallelism)


def corpus_from_table(
    df: DataFrame,
    doc_col: str = "doc_id",
    text_col: str = "text",
    on_duplicate: str = "error",
    min_partitions: int | None = None,
) -> DataFrame:
    """Any table with a document key and a text column; the text is tokenized
    like a line of a corpus file. Only the two columns are read."""
    raw = spread(df.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("_text")), min_partitions)
    docs = raw.select("doc_id", tokenize(F.col("_text")).alias("terms"))
    return _apply_duplicate_mode(docs, on_duplicate)


def corpus_from_pairs(
    df: DataFrame, doc_col: str, term_col: str, min_partitions: int | None = None
) -> DataFrame:
    """Any table of (document, term) rows, one row per occurrence (e.g. order ->
    part). Terms are compared as strings."""
    raw = df.select(F.col(doc_col).alias("doc_id"), F.col(term_col).cast("string").alias("term"))
    return spread(raw, min_partitions)


def to_occurrences(corpus: DataFrame) -> DataFrame:
    """Occurrence rows of any corpus (narrow: one explode)."""
    if corpus_shape(corpus) == OCCURRENCE_ROWS:
        return corpus.select("doc_id", "term")
    return corpus.select("doc_id", F.explode_outer("terms").alias("term"))


def _apply_duplicate_mode(docs: DataFrame, on_duplicate: str) -> DataFrame:
    if on_duplicate == "error":
        return docs
    if on_duplicate == "merge":
        return to_occurrences(docs)
    raise ValueError(f"on_duplicate must be 'error' or 'merge', not {on_duplicate!r}")
