"""Functions of the user's on the rows of a key, each key on its own: a failure is a row, not the end of the run.

The rows are dealt by key, sorted, and streamed past the function, so a key of a third of all
rows takes no memory, though it is one task's. Keys that fail are tried again by themselves; what
others gave is written before, so that a function that calls out isn't called for them twice
(but for tasks that Spark itself runs again).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factmill.operators.shared import shared_checkpoints

REASON_CHARS = 2000


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A semi or anti join in which null keys are equal."""
    other = right.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    rule = F.lit(True)
    for k in keys:
        rule = rule & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(other, rule, how)


def each_key(rows: DataFrame, keys: list[str], order: list[str], function: Callable[[dict, Iterator[dict]], Iterable[dict]], schema: T.StructType, tries: int = 2) -> tuple[DataFrame, DataFrame]:
    """What ``function`` makes of each key's rows, and the failures: keys, reason, attempts.

    ``function`` gets the key and an iterator of its rows as dicts, in ``order``; it may stop early, and gives dicts by the
    names of ``schema``. A key has all of its output or none. Any exception fails the key; ``tries`` counts the calls it gets.
    """
    shared_checkpoints(rows.sparkSession)
    fields = [rows.schema[k] for k in keys]
    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in fields], T.StructField("__reason", T.StringType()), *[T.StructField(f.name, f.dataType) for f in schema.fields]])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(out)
        flat = (r for b in batches for r in b.to_pylist())
        for key, own in groupby(flat, key=lambda r: tuple(r[k] for k in keys)):
            named = dict(zip(keys, key, strict=True))
            try:
                made = [named | {"__reason": None} | {n: r.get(n) for n in names} for r in function(dict(named), own)]
                made = pa.RecordBatch.from_pylist(made, shape)  # a value that doesn't fit the schema is a failure as well
            except Exception as e:
                made = pa.RecordBatch.from_pylist([named | {"__reason": f"{type(e).__name__}: {e}"[:REASON_CHARS]}], shape)
            yield made

    done, failed, left = None, None, rows
    for _ in range(max(1, tries)):
        found = left.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, out).checkpoint()
        good = found.where("__reason IS NULL").drop("__reason")
        done = good if done is None else done.unionByName(good)
        failed = found.where("__reason IS NOT NULL").select(*keys, F.col("__reason").alias("reason"))
        if not failed.take(1):
            break
        left = same_keys(rows, failed, keys, "left_semi")
    return done, failed.withColumn("attempts", F.lit(max(1, tries)))
