"""Tables written to the shared checkpoint folder, to cut lineage and survive lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BROADCAST_ROWS = 300_000
"""Most rows of at most 32 bytes each that are ever broadcast; larger sides are shuffled."""


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode, where all share it (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="factmill-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Scratch:
    """A folder of intermediate Parquet tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/factmill/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows at most for what runs inside, to bound a Python worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


TEXT_ROWS = 1000
"""Most rows of an Arrow batch of whole texts."""


def bounded_texts(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Arrow batches of so many rows at most, from here on in the session.

    For functions on whole texts that run only when their result is read: a batch of the usual 10,000
    texts takes both sides of the pipe tens of megabytes, and far more where texts are long.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    spark.conf.set(key, min(now, rows) if now > 0 else rows)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within the bound, else as it is."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
