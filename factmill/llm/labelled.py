"""Bounded samples of labelled documents for fitting a classifier, and the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
TRAINING_ROWS = 3000
"""Most labelled rows that a classifier is fitted on."""
TRAINING_CHARS = 10_000
"""Longest text in code points among rows to fit on; scoring always reads whole texts."""


def held_out(doc_id: Column) -> Column:
    """True for rows whose doc_id, as text, has a CRC divisible by the number of folds."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAINING_ROWS) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``rows`` labelled documents outside the held-out fold.

    The documents are those of smallest hash among the labelled; both classes get up to half of
    the places. Null labels, labels other than 0 and 1, null texts and texts too long to fit on
    are left out; of several texts under one doc_id the smallest counts.
    """
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__y")).where(F.col("__y").isin(0, 1) & F.col("__id").isNotNull() & ~held_out(F.col("__id"))).distinct()
    order = F.xxhash64(F.lit(label), "__id")
    picked = None
    for y in (0, 1):
        some = known.where(F.col("__y") == y).orderBy(order, "__id").limit(rows // 2)
        picked = some if picked is None else picked.unionByName(some)
    found = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("__id")).where(F.col("text").isNotNull() & (F.length("text") <= TRAINING_CHARS))
    got = found.groupBy("__id", "__y").agg(F.min("text").alias("text")).collect()  # no more than picked
    got = sorted((r["__id"], r["text"], r["__y"]) for r in got)
    return [r[1] for r in got], [r[2] for r in got]
