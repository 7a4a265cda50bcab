"""Streaming ingest: files of raw documents, deduplicated by content within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factmill.functions.text import content_hash


def raw_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def first_seen(stream: DataFrame, at: str, body: str, late: str = "1 day") -> DataFrame:
    """The first row of each content within the watermark; state is bounded by it."""
    return stream.withColumn("content_hash", content_hash(F.col(body))).withWatermark(at, late).dropDuplicatesWithinWatermark(["content_hash"])


def windowed_counts(stream: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Rows per key and window; late rows up to the watermark count."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")


def written(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what is there and stops; runs again from the checkpoint."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
