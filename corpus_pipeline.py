"""Training-corpus pipeline: five stages over a table of documents.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
with ``docs`` what the stage before returned, written as Parquet and read
again.  All but the last return the columns of ``documents``:

1. language: documents without a determined language go;
2. near_dedup: one document of each group of near-duplicates stays;
3. repeats: bytes that repeat 100 bytes from earlier leave the texts;
4. mix: every document as often as the mix of its source takes it;
5. tokens: token ids of each text, with digests of ids and decoded text.

Nulls, empty texts, repeated rows and empty tables have the results that the
operators define.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadkeeper.llm import op1_mixing, op2_language, op3_minhash, op4_suffix_dedup, op10_bpe
from threadkeeper.llm.common import Scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", op2_language.stage),
    ("near_dedup", op3_minhash.stage),
    ("repeats", op4_suffix_dedup.stage),
    ("mix", op1_mixing.stage),
    ("tokens", op10_bpe.stage),
]

#: No SQL: language models, sketches and token merges aren't expressible; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over all documents; each result is written before the next stage reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES[:-1]:
        out = scratch.cut(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        docs = before = out
    return STAGES[-1][1](spark, docs, sf_dir)
