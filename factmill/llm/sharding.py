"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded pseudorandom order; the row of rank r among a
source's n rows gets the fraction (r + 1/2) / n. All rows are sorted by that fraction and
cut into shards whose counts differ by at most one, so that every shard holds each source
in the proportion of the whole.

Ranks are taken in buckets (see ``ranks``): a source that holds a third of all rows is
spread over as many tasks as any other. Texts are read once and never shuffled, only their size and CRC.

Defined results: a null text has size 8 and the CRC of the empty string; a null source is
a source of its own; null or repeated doc_id values are ordinary rows, and rows equal in
every column are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factmill.llm.ranks import running, spread
from factmill.llm.scratch import Scratch, small

SHARDS = 24
SEED = 20240117


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot (gapless from 0 within the shard)."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select(
        "doc_id", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).withColumn("__h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    rows = Scratch(docs.sparkSession, "shards").table(rows, "rows")
    n = rows.count()
    buckets = spread(n)
    # the bucket is the top of the hash, so buckets in order are rows in hash order
    rows = rows.withColumn("__b", F.floor((F.shiftrightunsigned("__h", 11) / F.lit(float(1 << 53))) * buckets).cast("long"))
    unsigned = F.col("__h").bitwiseXOR(F.lit(-(1 << 63)))
    order = [unsigned, F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    sizes = rows.groupBy(F.col("source").alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
    rows = running(rows, ["source"], "__b", order, F.lit(1).cast("long"), "__rank")
    rows = rows.join(small(sizes, sizes.count()), F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s", "__b")
    rows = rows.withColumn("__f", (F.col("__rank") * 2 + 1) / (F.col("__n") * 2))
    rows = rows.withColumn("__b", F.floor(F.col("__f") * buckets).cast("long"))
    rows = running(rows, [], "__b", [F.col("__f"), F.col("source").asc_nulls_last(), *order], F.lit(1).cast("long"), "__at")
    exact = F.expr(f"cast(__at * {shards} div {max(n, 1)} as int)")
    first = F.expr(f"(shard * {max(n, 1)}L + {shards - 1}) div {shards}")
    return rows.withColumn("shard", exact).withColumn("slot", (F.col("__at") - first).cast("long")).select("doc_id", "source", "size", "text_crc32", "shard", "slot")


def op10(docs: DataFrame) -> DataFrame:
    """The contract's columns; the law that holds is ``rows``."""
    return shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source",
    )
