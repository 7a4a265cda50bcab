"""Gapless ranks over huge groups without gathering a group in one task.

Rows are cut into buckets of a bounded expected size. A count per (group, bucket) is
pre-aggregated, its running sum gives each bucket's first rank, and a window inside the
bucket gives the rest. Only the small count table is windowed by group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 2_000
"""Expected rows of a bucket at least; it grows with the root of the rows, as does the bucket table."""


def spread(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets for so many rows."""
    return max(1, -(-rows // max(per_bucket, 4 * math.isqrt(rows))))


def running(df: DataFrame, group: list[str], bucket: str, order: list[Column], amount: Column, into: str) -> DataFrame:
    """``into``: the sum of ``amount`` over all rows before this one in (group, bucket, order).

    ``amount`` must be a long. Null groups form a group of their own. The bucket table has
    one row per (group, bucket).
    """
    df = df.withColumn("__amount", amount)
    sums = df.groupBy(*group, bucket).agg(F.sum("__amount").alias("__sum"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("__start", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    names = [*group, bucket]
    starts = starts.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(names)], "__start")
    on = None
    for i, c in enumerate(names):
        same = F.col(c).eqNullSafe(F.col(f"__k{i}"))
        on = same if on is None else on & same
    inside = Window.partitionBy(*names).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("__inside", F.coalesce(F.sum("__amount").over(inside), F.lit(0)))
    return df.join(starts, on, "left").withColumn(into, F.col("__start") + F.col("__inside")).drop("__amount", "__inside", "__start", *[f"__k{i}" for i in range(len(names))])
