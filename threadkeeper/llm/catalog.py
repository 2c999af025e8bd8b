"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import op1_mixing, op2_language, op3_minhash, op4_suffix_dedup, op5_preference, op6_toxicity, op7_fingerprint, op8_lm, op9_embeddings, op10_bpe, op11_trie, op12_quality, op13_manifest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mixing.op1_mix,
    "op2_language": op2_language.op2_language,
    "op3_near_dedup": op3_minhash.op3_near_dedup,
    "op4_suffix_dedup": op4_suffix_dedup.op4_suffix_dedup,
    "op5_preference": op5_preference.op5_preference,
    "op6_toxicity": op6_toxicity.op6_toxicity,
    "op7_fingerprint": op7_fingerprint.op7_fingerprint,
    "op8_lm": op8_lm.op8_lm,
    "op9_near_vectors": op9_embeddings.op9_near_vectors,
    "op10_bpe": op10_bpe.op10_bpe,
    "op11_trie": op11_trie.op11_trie,
    "op12_quality": op12_quality.op12_quality,
    "op13_manifest": op13_manifest.op13_manifest,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op3_near_dedup": op3_minhash.OP3_SQL,
    "op4_suffix_dedup": op4_suffix_dedup.OP4_SQL,
    "op5_preference": op5_preference.OP5_SQL,
    "op9_near_vectors": op9_embeddings.OP9_SQL,
    "op11_trie": op11_trie.OP11_SQL,
    "op12_quality": op12_quality.OP12_SQL,
    "op13_manifest": op13_manifest.OP13_SQL,
}
