"""Per-row column helpers (built-in Spark functions only)."""

from termsim.functions.text import (
    DEFAULT_PATTERN,
    WHITESPACE_RUN,
    count_runs,
    has_token,
    keep_matching,
    run_starts,
    tokenize,
    total_count,
)

__all__ = [
    "DEFAULT_PATTERN",
    "WHITESPACE_RUN",
    "count_runs",
    "has_token",
    "keep_matching",
    "run_starts",
    "tokenize",
    "total_count",
]
