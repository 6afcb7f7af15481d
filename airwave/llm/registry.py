"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from airwave.llm.bloom_lm import op5_bloom_lm
from airwave.llm.chat_hmm import op9_chat_hmm
from airwave.llm.common import read_table
from airwave.llm.conversation_repair import op11_conversation_repair
from airwave.llm.curriculum_mix import OP10_SQL, op10_curriculum_mix
from airwave.llm.decontaminate import op7_decontaminate
from airwave.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from airwave.llm.license_scan import op3_license_scan
from airwave.llm.minhash_tensor import op13_minhash_tensor
from airwave.llm.quality_rules import OP1_SQL, op1_quality_rules
from airwave.llm.secret_scan import op8_secret_scan
from airwave.llm.simhash_gray import op4_simhash_gray
from airwave.llm.suffix_dedup import op6_suffix_dedup
from airwave.llm.toxicity_mil import op2_toxicity_mil


def _on(fn, *tables):
    return lambda spark, sf_dir: fn(*(read_table(spark, sf_dir, t) for t in tables))


def queries() -> dict:
    return {
        "op1_quality_rules": _on(op1_quality_rules, "documents"),
        "op2_toxicity_mil": _on(op2_toxicity_mil, "documents", "labels"),
        "op3_license_scan": _on(op3_license_scan, "documents"),
        "op4_simhash_gray": _on(op4_simhash_gray, "documents"),
        "op5_bloom_lm": _on(op5_bloom_lm, "documents"),
        "op6_suffix_dedup": _on(op6_suffix_dedup, "documents"),
        "op7_decontaminate": _on(op7_decontaminate, "documents", "benchmark"),
        "op8_secret_scan": _on(op8_secret_scan, "documents"),
        "op9_chat_hmm": _on(op9_chat_hmm, "conversations"),
        "op10_curriculum_mix": _on(op10_curriculum_mix, "documents"),
        "op11_conversation_repair": _on(op11_conversation_repair, "conversations"),
        "op12_hard_negatives": _on(op12_hard_negatives, "embeddings"),
        "op13_minhash_tensor": _on(op13_minhash_tensor, "documents"),
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": OP1_SQL, "op10_curriculum_mix": OP10_SQL, "op12_hard_negatives": OP12_SQL}
