"""Per-row column expressions over text and term arrays.

Everything here builds a ``Column`` from built-in functions (split, filter,
transform, sort_array, ...), so it runs in the executor JVM next to the scan,
inside the same stage; there is no Python UDF. (Higher-order functions such as
``transform`` are evaluated by Spark's interpreter inside the generated code.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: these must stay equal to the reference's behaviour. -------
# A token separator is one run of the characters Python's ``str.isspace()``
# accepts: Java ``\s`` (space, \t, \n, \x0b, \f, \r), U+001C..U+001F, U+0085 and
# the Unicode separator classes Zs, Zl, Zp.
WHITESPACE_RUN = r"[\s\x1c-\x1f\x85\p{Z}]+"
# Default term pattern, found anywhere in a token: disease and gene tokens.
DEFAULT_PATTERN = ".*dis_.*_dis.*|.*gene_.*_gene.*"
# -----------------------------------------------------------------------------

TERM_COUNT_TYPE = "array<struct<term:string,n:bigint>>"


def tokenize(text: Column | str) -> Column:
    """Split on runs of whitespace; no empty tokens; case and punctuation kept.

    A NULL text gives an empty array (a document without terms).
    """
    col = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.coalesce(col, F.lit("")), WHITESPACE_RUN)
    return F.filter(parts, lambda t: t != "")


def run_starts(sorted_terms: Column | str) -> Column:
    """0-based positions where a new run of equal terms starts in a sorted array."""
    s = F.col(sorted_terms) if isinstance(sorted_terms, str) else sorted_terms
    return F.filter(
        F.transform(
            s,
            lambda x, i: F.when((i == 0) | (x != F.get(s, i - 1)), i).otherwise(F.lit(-1)),
        ),
        lambda i: i >= 0,
    )


def count_runs(sorted_terms: Column | str, starts: Column | str) -> Column:
    """Run-length count of a sorted array, given its run starts.

    Returns ``ARRAY<STRUCT<term STRING, n BIGINT>>`` with one entry per distinct
    term, in term order. Both inputs must be column references computed in an
    earlier ``select`` (sort, then starts, then this), so each step runs once
    per row and the count is O(k) per document. ``get`` is 0-based and gives
    NULL past the end, which closes the last run.
    """
    s = F.col(sorted_terms) if isinstance(sorted_terms, str) else sorted_terms
    st = F.col(starts) if isinstance(starts, str) else starts
    return F.transform(
        st,
        lambda i, r: F.struct(
            F.get(s, i).alias("term"),
            (F.coalesce(F.get(st, r + 1), F.size(s)) - i).cast("bigint").alias("n"),
        ),
    )


def has_token(text: Column | str) -> Column:
    """True when the text holds at least one token (cheap test on raw text)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col, F.lit("")).rlike(r"[^\s\x1c-\x1f\x85\p{Z}]")


def keep_matching(entries: Column, pattern: str | None) -> Column:
    """Keep term entries whose term contains a match of ``pattern`` (Java regex,
    found anywhere, like Python's ``re.search``); ``None`` keeps all."""
    if pattern is None:
        return entries
    return F.filter(entries, lambda e: e["term"].rlike(pattern))


def total_count(entries: Column) -> Column:
    """Sum of ``n`` over term entries (a document length after filtering)."""
    return F.aggregate(entries, F.lit(0).cast("bigint"), lambda acc, e: acc + e["n"])
