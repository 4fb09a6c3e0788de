"""End-to-end jobs built from the operators."""

from termsim.plans.jobs import (
    LookupResult,
    check_job,
    failed_terms,
    lookup_job,
    matrix_job,
    tfidf_job,
    write_lookup,
    write_matrix,
)
from termsim.plans.index import build_index, lookup_index, open_index, remove_old_builds, topn_index
from termsim.plans.materialize import materialize
from termsim.plans.nearest import nearest_terms

__all__ = [
    "LookupResult",
    "build_index",
    "check_job",
    "failed_terms",
    "lookup_index",
    "lookup_job",
    "materialize",
    "matrix_job",
    "nearest_terms",
    "open_index",
    "remove_old_builds",
    "tfidf_job",
    "topn_index",
    "write_lookup",
    "write_matrix",
]
