"""The corpus pipeline: toxicity, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return the columns of documents; the last returns the shard manifest (doc_id,
source, size, text_crc32, shard, slot), which needs no text.

Defined results of the stages, beside their operators': a null or empty text is no toxic one, no copy
and holds no test item, so its row stays, and the mix takes it once; rows with null or repeated
doc_id are judged row by row, and of rows equal in doc_id and text one stays as a copy's keeper; ties go to
the smaller doc_id; extra columns, whatever their names, come through all stages but the last; empty
tables give empty ones, and without labels of both classes nothing is rejected as toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factmill.llm import decontamination, jaccard, mixing, sharding, toxicity
from factmill.llm.scratch import Scratch, table


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity classifier doesn't reject."""
    return toxicity.kept_documents(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links."""
    return jaccard.kept_documents(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontamination.kept_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document."""
    return sharding.shard(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", without_benchmarks),
    ("mixing", mixed),
    ("sharding", sharded),
]

ORACLE_SQL = None
"""SQL can't express the classifier; tests hold the stages against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
