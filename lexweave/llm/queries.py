"""Queries of the ten operators and the pipeline, with SQL where SQL can say it."""

from __future__ import annotations

from lexweave.llm import decontaminate, jaccard, language, licenses, lines, mixing, quality, rules, sharding, substrings

QUERIES = {
    "op1_fm_index": decontaminate.op1_fm_index,
    "op2_difference_cover": substrings.op2_difference_cover,
    "op3_risk_rules": rules.op3_risk_rules,
    "op4_shard_tree": sharding.op4_shard_tree,
    "op5_diagonal_votes": licenses.op5_diagonal_votes,
    "op6_count_vector_join": jaccard.op6_count_vector_join,
    "op7_attention_mil": quality.op7_attention_mil,
    "op8_nearest_centroid": language.op8_nearest_centroid,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_perfect_hash_lines": lines.op10_perfect_hash_lines,
}
ORACLE_SQL = {
    "op1_fm_index": decontaminate.OP1_SQL,
    "op5_diagonal_votes": licenses.OP5_SQL,
    "op6_count_vector_join": jaccard.OP6_SQL,
    "op9_mix_sources": mixing.OP9_SQL,
    "op10_perfect_hash_lines": lines.OP10_SQL,
}
