"""The corpus queries and their DuckDB SQL (none where SQL cannot express the operator)."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm import align, ctw, decontam, hardneg, htmltext, linededup, links, mixing, neardup, quality, rules, secrets, toxicity

MODULES = {
    "op1_minhash_neardup": neardup,
    "op2_quality_classifier": quality,
    "op3_secret_scan": secrets,
    "op5_mix_sources": mixing,
    "op6_url_filter": links,
    "op4_ctw_score": ctw,
    "op7_decontaminate": decontam,
    "op8_line_dedup": linededup,
    "op9_quality_rules": rules,
    "op10_toxicity": toxicity,
    "op11_html_text": htmltext,
    "op12_hard_negatives": hardneg,
    "op13_align_tokenizers": align,
}


def queries():
    return {name: m.query for name, m in MODULES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    sql = {name: m.SQL for name, m in MODULES.items() if getattr(m, "SQL", None)}
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
