"""Queries over the driver's tables, one per operator, and their SQL counterparts where SQL has them."""

from __future__ import annotations

from signalweave.llm import (
    decontaminate,
    filter_audit,
    lexical_search,
    line_dedup,
    packing,
    pii,
    quality_model,
    quality_rules,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    version_sketch,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.suffix_dedup_query,
    "op2_decontamination": decontaminate.decontamination_query,
    "op3_personal_data": pii.personal_data_query,
    "op4_quality_rules": quality_rules.quality_rules,
    "op5_line_dedup": line_dedup.line_dedup_query,
    "op6_packing": packing.packing_query,
    "op7_quality_model": quality_model.quality_query,
    "op8_token_counts": token_counts.token_counts_query,
    "op9_simhash": simhash.simhash_query,
    "op10_toxicity": toxicity.toxicity_query,
    "op11_lexical_search": lexical_search.search_query,
    "op12_filter_audit": filter_audit.filter_audit_query,
    "op13_version_sketch": version_sketch.version_sketch_query,
}

ORACLE: dict[str, str] = {
    "op2_decontamination": decontaminate.ORACLE,
    "op4_quality_rules": quality_rules.ORACLE,
    "op5_line_dedup": line_dedup.ORACLE,
    "op11_lexical_search": lexical_search.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
}
