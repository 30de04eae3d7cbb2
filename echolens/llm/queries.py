"""One registered query per operator, with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from . import (ann, conversations, html_extract, license_scan, mixing, near_dedup, packing, quality_classifier, quality_rules,
               resample, token_counts, token_output, warc)

QUERIES = {
    "op1_license_scan": license_scan.query,
    "op2_token_counts": token_counts.query,
    "op3_quality_classifier": quality_classifier.query,
    "op4_cross_polytope_neighbors": ann.query,
    "op5_html_extraction": html_extract.query,
    "op6_best_fit_packing": packing.query,
    "op7_source_mixing": mixing.query,
    "op8_minhash_near_dedup": near_dedup.query,
    "op9_token_output": token_output.query,
    "op10_quality_rules": quality_rules.query,
    "op11_target_resampling": resample.query,
    "op12_conversation_repair": conversations.query,
    "op13_warc": warc.query,
}

ORACLES = {
    "op1_license_scan": license_scan.oracle_sql(),
    "op2_token_counts": token_counts.ORACLE,
    "op10_quality_rules": quality_rules.oracle_sql(),
    "op11_target_resampling": resample.ORACLE,
    "op12_conversation_repair": conversations.ORACLE,
    "op13_warc": warc.ORACLE,
}
