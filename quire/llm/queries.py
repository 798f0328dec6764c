"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontamination, line_dedup, maxent, packing, pii, quality_rules, simhash, toxicity, url_filter, warc

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_warc": warc.op3_warc,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_lm_scoring": maxent.op6_lm_scoring,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_pii": pii.op8_pii,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_simhash": simhash.op10_simhash,
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op5_quality_rules": quality_rules.OP5_SQL,
    "op7_url_filter": url_filter.OP7_SQL,
}
