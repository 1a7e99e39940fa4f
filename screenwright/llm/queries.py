"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from screenwright.llm import chat, decontamination, mixing, neardup, pii, quality, sharding, tokens, toxicity, warc


def queries() -> dict:
    return {
        "op1_pii": pii.op1,
        "op2_chat_rotation": chat.op2,
        "op3_quality_rules": quality.op3,
        "op4_decontamination": decontamination.op4,
        "op5_toxicity": toxicity.op5,
        "op6_token_counts": tokens.op6,
        "op7_minhash_neardup": neardup.op7,
        "op8_warc": warc.op8,
        "op9_source_mixing": mixing.op9,
        "op10_sharding": sharding.op10,
        "quality_rule_ablations": quality.op3_ablations,
    }


def oracle_sql() -> dict:
    return {
        "op2_chat_rotation": chat.SQL,
        "op3_quality_rules": quality.SQL,
        "quality_rule_ablations": quality.ABLATIONS_SQL,
        "op8_warc": warc.SQL,
        "op9_source_mixing": mixing.SQL,
    }
