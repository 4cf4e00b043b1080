"""The queries of this package and their DuckDB SQL (where SQL can express one)."""

from __future__ import annotations

from strata.llm import (conversation_repair, exact_dedup, lang_id, lm_score, mixing, packing, personal_data, simhash, substring_dedup,
                        suffix_dedup, topk_search, toxicity, whitening)

QUERIES = {
    "op1_lm_score": lm_score.op1_lm_score,
    "op2_simhash": simhash.op2_simhash,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_mixing": mixing.op4_mixing,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_packing": packing.op7_packing,
    "op8_personal_data": personal_data.op8_personal_data,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_topk": topk_search.op10_topk,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_language_id": lang_id.op12_language_id,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE = {
    "op9_exact_dedup": exact_dedup.ORACLE_SQL,
    "op10_topk": topk_search.ORACLE_SQL,
}
