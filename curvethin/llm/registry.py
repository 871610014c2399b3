"""Queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from curvethin.llm import (
    op1_toxicity,
    op2_decontaminate,
    op3_exact,
    op4_substring,
    op5_mix,
    op6_pii,
    op7_ngram_join,
    op8_quality,
    op9_secrets,
    op10_chat,
    op11_bpe,
    op12_repair,
    op13_merkle,
)

QUERIES = {
    "op1_toxicity": op1_toxicity.query,
    "op2_decontaminate": op2_decontaminate.query,
    "op3_exact_dedup": op3_exact.query,
    "op4_substring_dedup": op4_substring.query,
    "op5_mix_sources": op5_mix.query,
    "op6_pii": op6_pii.query,
    "op7_ngram_join": op7_ngram_join.query,
    "op8_quality": op8_quality.query,
    "op9_secrets": op9_secrets.query,
    "op10_chat": op10_chat.query,
    "op11_bpe": op11_bpe.query,
    "op12_repair": op12_repair.query,
    "op13_merkle": op13_merkle.query,
}

ORACLES = {
    "op2_decontaminate": op2_decontaminate.ORACLE,
    "op3_exact_dedup": op3_exact.ORACLE,
    "op4_substring_dedup": op4_substring.ORACLE,
    "op5_mix_sources": op5_mix.ORACLE,
    "op7_ngram_join": op7_ngram_join.ORACLE,
    "op10_chat": op10_chat.ORACLE,
    "op12_repair": op12_repair.ORACLE,
    "op13_merkle": op13_merkle.ORACLE,
}
