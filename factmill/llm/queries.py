"""The opN queries over the driver's tables, each a thin use of its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factmill.llm import chat, codes, decontamination, jaccard, licenses, linededup, merkle, mixing, pii, quality, sharding, topk, toxicity
from factmill.llm.scratch import table

# the columns of these queries' SQL; their operators tell more
CHATS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
PROOFS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _docs(op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: op(table(spark, sf_dir, "documents"))


def _labelled(op: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: op(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": _docs(linededup.op1),
        "op2_decontaminate": lambda spark, sf_dir: decontamination.op2(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
        "op3_quality": _labelled(quality.op3),
        "op4_pii": _docs(pii.op4),
        "op5_ngram_jaccard": _docs(jaccard.op5),
        "op6_mix": _docs(mixing.op6),
        "op7_licenses": _docs(licenses.op7),
        "op8_topk": lambda spark, sf_dir: topk.op8(table(spark, sf_dir, "embeddings")),
        "op9_toxicity": _labelled(toxicity.op9),
        "op10_shard": _docs(sharding.op10),
        "op11_codes": lambda spark, sf_dir: codes.op11(table(spark, sf_dir, "embeddings")),
        "op12_chat": lambda spark, sf_dir: chat.op12(table(spark, sf_dir, "conversations")).select(*CHATS),
        "op13_merkle": lambda spark, sf_dir: merkle.op13(table(spark, sf_dir, "documents")).select(*PROOFS),
    }
