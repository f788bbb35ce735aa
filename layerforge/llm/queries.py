"""Queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from . import (bpe, chat_format, conversation_repair, decontaminate, exact_dedup, language_id, lm_score, packing,
               quality_rules, simhash, substring_dedup, token_alignment, token_counts)

QUERIES = {
    "op1_lm_score": lm_score.op1_lm_score,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op2_simhash_near_dedup": simhash.op2_simhash_near_dedup,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op6_packing": packing.op6_packing,
    "op8_bpe": bpe.op8_bpe,
    "op9_language_id": language_id.op9_language_id,
    "op5_chat_format": chat_format.op5_chat_format,
    "op7_token_counts": token_counts.op7_token_counts,
    "op11_token_alignment": token_alignment.op11_token_alignment,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_decontaminate": decontaminate.op13_decontaminate,
}

ORACLES = {
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op5_chat_format": chat_format.OP5_SQL,
    "op13_decontaminate": decontaminate.OP13_SQL,
}
