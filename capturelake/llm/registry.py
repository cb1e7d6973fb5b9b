"""Queries and SQL of this subpackage, by name."""

from __future__ import annotations

from capturelake.llm import bpe, decontam, dialog, langid, lexical, neardup, pii, pseudolm, quality, rans, toxicity, urlfilter, wrapper

QUERIES = {
    "op7_url_filters": urlfilter.op7_url_filters,
    "op9_lm_scoring": pseudolm.op9_lm_scoring,
    "op5_language_id": langid.op5_language_id,
    "op3_quality_rules": quality.op3_quality_rules,
    "op1_token_ids": rans.op1_token_ids,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op6_pii": pii.op6_pii,
    "op4_decontamination": decontam.op4_decontamination,
    "op8_toxicity": toxicity.op8_toxicity,
    "op10_minhash_near_dedup": neardup.op10_minhash_near_dedup,
    "op11_html_extraction": wrapper.op11_html_extraction,
    "op12_structure_repair": dialog.op12_structure_repair,
    "op13_lexical_search": lexical.op13_lexical_search,
}
SQL: dict[str, str] = {
    "op3_quality_rules": quality.OP3_SQL,
    "op7_url_filters": urlfilter.OP7_SQL,
    "op11_html_extraction": wrapper.OP11_SQL,
    "op12_structure_repair": dialog.OP12_SQL,
    "op13_lexical_search": lexical.OP13_SQL,
}
