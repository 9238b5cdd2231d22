"""The operators' queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from . import (
    chat_format,
    cross_polytope,
    exact_dedup,
    hilbert_shards,
    kk_packing,
    line_dedup,
    parity_join,
    quality_lm,
    quality_rules,
    sentencepiece_viterbi,
    structure_repair,
    suffix_dedup,
    whitening,
)


def queries() -> dict:
    return {
        "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
        "op2_cross_polytope": cross_polytope.op2_cross_polytope,
        "op3_sentencepiece": sentencepiece_viterbi.op3_sentencepiece,
        "op4_quality_lm": quality_lm.op4_quality_lm,
        "op5_chat_format": chat_format.op5_chat_format,
        "op6_parity_join": parity_join.op6_parity_join,
        "op7_kk_packing": kk_packing.op7_kk_packing,
        "op8_line_dedup": line_dedup.op8_line_dedup,
        "op9_hilbert_shards": hilbert_shards.op9_hilbert_shards,
        "op10_quality_rules": quality_rules.op10_quality_rules,
        "op11_structure_repair": structure_repair.op11_structure_repair,
        "op12_whitening": whitening.op12_whitening,
        "op13_exact_dedup": exact_dedup.op13_exact_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_chat_format": chat_format.OP5_SQL, "op8_line_dedup": line_dedup.OP8_SQL, "op13_exact_dedup": exact_dedup.OP13_SQL}
