"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names for what jobs share; a temporary one only in local mode, where all share it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="factmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the folder the cluster names; to a temporary one only in local mode, where all share it."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again, for what asks them several times."""
    path = f"{shared_root(df.sparkSession)}/factmill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows by key, as they are, in as many parts as a shuffle has.

    Before a grouping of rows of which few are one group: a partial grouping of a whole file's rows saves nothing
    and holds them all, and parts that are merged by their bytes hold far more as groups.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def left_joined(rows: DataFrame, other: DataFrame, key: str, its: str) -> DataFrame:
    """A left join by one key; rows without it, which meet nothing, are spread over the tasks instead of being one's."""
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20))).otherwise(F.lit(0).cast("long"))
    # of no constant, which would make the second key a filter
    mate = other.withColumn("__mate", F.pmod(F.xxhash64(its), F.lit(1)))
    return rows.withColumn("__spread", spread).join(mate, (F.col(key) == F.col(its)) & (F.col("__spread") == F.col("__mate")), "left").drop("__spread", "__mate")
