"""Registered queries of this subpackage, and SQL with the same rows where there is one."""

from __future__ import annotations

import corpus_pipeline
from lotwise.llm import (
    exact_dedup,
    fill_in_middle,
    filter_audit,
    hamming_search,
    html_extract,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    piece_sampling,
    sharding,
    simhash,
    url_filter,
)

QUERIES = {
    "op1_html_extract": html_extract.query,
    "op2_piece_sampling": piece_sampling.query,
    "op3_line_dedup": line_dedup.query,
    "op4_exact_dedup": exact_dedup.query,
    "op5_packing": packing.query,
    "op6_ngram_join": ngram_join.query,
    "op7_language_id": language_id.query,
    "op8_url_filter": url_filter.query,
    "op9_hamming_search": hamming_search.query,
    "op10_sharding": sharding.query,
    "op11_fill_in_middle": fill_in_middle.query,
    "op12_filter_audit": filter_audit.query,
    "op13_simhash": simhash.query,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
    "op9_hamming_search": hamming_search.ORACLE,
    "op11_fill_in_middle": fill_in_middle.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
}
