"""Registered queries of the subpackage and their DuckDB twins.

The queries without a twin are tested against brute force, an exact round
trip or held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

from typing import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import bpe, html, jaccard, language, merkle, mixing, oracle, packing, quality, rules, runs, substring, tokencount, topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language.op1,
    "op2_html_text": html.op2,
    "op3_token_counts": tokencount.op3,
    "op4_exact_top_k": topk.op4,
    "op5_mix_sources": mixing.op5,
    "op6_quality_rules_score": quality.op6,
    "op7_rule_ledger": rules.op7,
    "op8_bpe_codec": bpe.op8,
    "op9_substring_dedup": substring.op9,
    "op10_ngram_jaccard": jaccard.op10,
    "op11_merkle_manifest": merkle.op11,
    "op12_best_fit_packing": packing.op12,
    "op13_periodic_runs": runs.op13,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op4_exact_top_k": oracle.OP4,
    "op7_rule_ledger": oracle.OP7,
    "op9_substring_dedup": oracle.OP9,
    "op10_ngram_jaccard": oracle.OP10,
    "op11_merkle_manifest": oracle.OP11,
}
