"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from lodestream.llm import decontaminate, html_text, jaccard_join, langid, line_dedup, media, phrases, preference, sentencepieces, shard, spelling, token_counts, toxicity

_MODULES = {
    "op1_decontaminate": decontaminate, "op2_line_dedup": line_dedup, "op3_ngram_jaccard_join": jaccard_join, "op4_language_id": langid,
    "op5_sentencepieces": sentencepieces, "op6_preference_formatting": preference, "op7_media_columns": media, "op8_html_extraction": html_text,
    "op9_sharding": shard, "op10_toxicity": toxicity, "op11_collocations": phrases, "op12_token_counts": token_counts,
    "op13_spelling_variants": spelling,
}


def queries() -> dict:
    return {name: m.query for name, m in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: m.ORACLE for name, m in _MODULES.items() if m.ORACLE}
