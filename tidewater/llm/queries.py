"""Registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from . import bpe, chat, lexical, merkle, mixing, pieces, quality, repeats, simhash, simple8b, toxicity, vectors, winnow

QUERIES = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_cotraining_quality": quality.op2_cotraining_quality,
    "op3_perspectives": chat.op3_perspectives,
    "op4_winnowing": winnow.op4_winnowing,
    "op5_simple8b": simple8b.op5_simple8b,
    "op6_simhash_pivots": simhash.op6_simhash_pivots,
    "op7_mix_curriculum": mixing.op7_mix_curriculum,
    "op8_toxicity_weak": toxicity.op8_toxicity_weak,
    "op9_suffix_repeats": repeats.op9_suffix_repeats,
    "op10_collision_counting": vectors.op10_collision_counting,
    "op11_norm_buckets": lexical.op11_norm_buckets,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_byte_bpe": bpe.op13_byte_bpe,
}

ORACLE = {
    "op3_perspectives": chat.OP3_SQL,
    "op9_suffix_repeats": repeats.OP9_SQL,
    "op10_collision_counting": vectors.OP10_SQL,
    "op11_norm_buckets": lexical.OP11_SQL,
    "op12_merkle_manifest": merkle.OP12_SQL,
}
