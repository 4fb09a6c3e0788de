"""The queries of the numbered operators (and their SQL where it can say them)."""

from __future__ import annotations

from termsim.llm.chat_format import OP7_SQL, op7_chat_format
from termsim.llm.decontaminate import op5_decontaminate
from termsim.llm.html_extract import op8_html_extract
from termsim.llm.merkle_manifest import OP13_SQL, op13_merkle_manifest
from termsim.llm.near_dedup import OP1_SQL, op1_near_dedup
from termsim.llm.order_fingerprint import op6_order_fingerprint
from termsim.llm.phrases import OP12_SQL, op12_phrases
from termsim.llm.quality_classifier import op10_quality_classifier
from termsim.llm.source_mixing import op2_source_mixing
from termsim.llm.substring_dedup import OP4_SQL, op4_substring_dedup
from termsim.llm.token_counts import op11_token_counts
from termsim.llm.token_store import op9_token_store
from termsim.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_order_fingerprint": op6_order_fingerprint,
    "op7_chat_format": op7_chat_format,
    "op8_html_extract": op8_html_extract,
    "op9_token_store": op9_token_store,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_token_counts": op11_token_counts,
    "op12_phrases": op12_phrases,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: DuckDB SQL by query; a query without an entry is tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_near_dedup": OP1_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op7_chat_format": OP7_SQL,
    "op12_phrases": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
