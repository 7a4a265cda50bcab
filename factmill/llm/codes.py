"""Vector code compression: product quantisation by Lloyd's rounds with Hamerly's bounds, in integers.

Vectors become integers and are cut into equal consecutive parts; each part position has a
codebook of its own. Beside its code, every part of every vector keeps an upper bound of its
distance to its entry and a lower bound of that to the second nearest. After a round the upper
bound grows by how far the own entry moved, the lower one shrinks by the farthest move of any
other. Only where the upper bound isn't strictly below the lower one is the distance to the own
entry worked out, and only if that fails too are all entries scanned. A part with a tie can't
pass a strict test, so ties are always settled by a scan, to the lower index: the codes are
those of plain Lloyd rounds. Bounds are rounded outwards; distances are 64-bit integers, exact.

The state (integers, codes, bounds) is a table, rewritten each round in one pass without a
shuffle; the sums that each task gathers for the new entries go into the same table as one row
of its own, which Parquet finds without reading the others' columns. Only the codebooks come to
the driver: parts * entries rows of sums.

Defined results: vectors that are null or hold null or non-finite components are dropped;
shorter vectors and lengths that don't divide are padded with zeros to the least multiple that
holds the longest; of repeated vec_ids each row is kept, the lesser vector first among the
first entries; a null vec_id comes last; with fewer rows than entries the codebooks are
shorter; an empty table gives no rows; other columns stay out. Components of 2**17 and more
in size are an error, as their distances needn't fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factmill.llm.scratch import Scratch, small

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 1 << 29
"""Integer components stay below this, so that the distance of two parts of 8 fits 64 bits."""


class Bounded(NamedTuple):
    """The state of n vectors: (n, parts) arrays; scanned tells which parts went through a full scan."""

    code: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    scanned: np.ndarray


def _outwards(upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As 32-bit floats, none nearer than it was."""
    up = np.nextafter((upper * (1 + 1e-15)).astype(np.float32), np.float32(np.inf))
    return up, np.nextafter((lower - np.abs(lower) * 1e-15).astype(np.float32), np.float32(-np.inf))


def moves(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """How far each entry moved at most, (parts, entries)."""
    d = (after - before).astype(np.float64)
    return np.sqrt((d * d).sum(-1)) * (1 + 1e-14)


def assigned(v: np.ndarray, books: np.ndarray, state: Bounded | None = None, moved: np.ndarray | None = None) -> Bounded:
    """The nearest entry (least index of equals) of each part of v (n, parts, width) and its bounds.

    With a state, ``moved`` tells how far the entries moved since; a scan is spared where the bounds allow it.
    """
    n, parts, entries = len(v), books.shape[0], books.shape[1]
    if state is None:
        code, upper, lower = np.zeros((n, parts), np.int64), np.full((n, parts), np.inf), np.full((n, parts), -np.inf)
        open_ = np.ones((n, parts), bool)
    else:
        code, at = state.code.astype(np.int64), np.arange(parts)
        far = moved.argmax(1)
        rest = moved.copy()
        rest[at, far] = -np.inf
        other = np.where(code == far, np.maximum(rest.max(1), 0), moved[at, far])
        upper, lower = state.upper.astype(np.float64) + moved[at, code], state.lower.astype(np.float64) - other
        open_ = ~(upper < lower)
        rows, cols = np.nonzero(open_)
        d = v[rows, cols] - books[cols, code[rows, cols]]
        upper[rows, cols] = np.sqrt((d * d).sum(-1).astype(np.float64)) * (1 + 1e-14)
        open_ &= ~(upper < lower)
    for p in range(parts):
        rows = np.flatnonzero(open_[:, p])
        d = v[rows, p][:, None, :] - books[p][None]
        d = (d * d).sum(-1)
        best = d.argmin(1)  # the first of equals
        code[rows, p], near = best, d[np.arange(len(rows)), best]
        upper[rows, p] = np.sqrt(near.astype(np.float64)) * (1 + 1e-14)
        if entries > 1:
            d[np.arange(len(rows)), best] = np.iinfo(np.int64).max
            lower[rows, p] = np.sqrt(d.min(1).astype(np.float64)) * (1 - 1e-14)
        else:
            lower[rows, p] = np.inf
    return Bounded(code, *_outwards(upper, lower), open_)


def errors(v: np.ndarray, books: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Squared distances of the parts to their entries, summed over parts."""
    d = v - books[np.arange(books.shape[0]), code]
    return (d * d).sum((1, 2))


def _listed(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    flat = pa.array(x.reshape(-1), kind)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), flat)


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


STATE = [
    T.StructField("code", T.ArrayType(T.ByteType())), T.StructField("upper", T.ArrayType(T.FloatType())),
    T.StructField("lower", T.ArrayType(T.FloatType())), T.StructField("scans", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType())),
]


def _round(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """rows with the codes and bounds by these codebooks, and a row of sums for each task."""
    parts, entries, width = books.shape
    carried = [f for f in rows.schema.fields if f.name in ("vec_id", "label", "v")]
    names = [f.name for f in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, kinds = np.zeros((parts, entries, width + 1), np.int64), None
        for b in batches:
            if not b.num_rows:
                continue
            kinds = [b.schema.field(n).type for n in names]
            v, state = _flat(b, "v").astype(np.int64).reshape(-1, parts, width), None
            if moved is not None:
                state = Bounded(*[_flat(b, c).reshape(-1, parts) for c in ("code", "upper", "lower")], np.empty(0))
            found = assigned(v, books, state, moved)
            for p in range(parts):
                np.add.at(sums[p, :, :width], found.code[:, p], v[:, p])
                sums[p, :, width] += np.bincount(found.code[:, p], minlength=entries)
            out = [b.column(n) for n in names]
            out += [_listed(found.code, pa.int8()), _listed(found.upper, pa.float32()), _listed(found.lower, pa.float32())]
            out += [pa.array(found.scanned.sum(1), pa.int64()), pa.nulls(len(v), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, [*names, "code", "upper", "lower", "scans", "sums"])
        if kinds:
            kinds += [pa.list_(pa.int8()), pa.list_(pa.float32()), pa.list_(pa.float32()), pa.int64()]
            out = [pa.nulls(1, k) for k in kinds] + [_listed(sums.reshape(1, -1), pa.int64())]
            yield pa.RecordBatch.from_arrays(out, [*names, "code", "upper", "lower", "scans", "sums"])

    return rows.mapInArrow(run, T.StructType(carried + STATE))


def _replaced(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The entries that the sums of a round make; unused ones stay."""
    flat = state.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
    sums = np.zeros(books.shape[0] * books.shape[1] * (books.shape[2] + 1), np.int64)
    for r in flat:
        sums[r["at"]] = r["x"]
    sums = sums.reshape(books.shape[0], books.shape[1], -1)
    count = sums[:, :, -1:]
    return np.where(count > 0, sums[:, :, :-1] // np.maximum(count, 1), books)


class Trained(NamedTuple):
    """rows (vec_id, label, v and the state by the last codebooks but one), the codebooks (parts, entries, width) and their last moves."""

    rows: DataFrame
    books: np.ndarray
    moved: np.ndarray


def _integers(embedding: Column, scale: int) -> Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def kept_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and v: the integers of vectors that aren't null and hold neither null nor non-finite components."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & fine).select("vec_id", "label", _integers(F.col("embedding"), scale).alias("v"))


def trained(scratch: Scratch, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Trained | None:
    """Codebooks after so many rounds over all vectors; None if there is no vector."""
    rows = kept_vectors(vectors, scale)
    sizes = rows.agg(F.max(F.size("v")).alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    if sizes["n"] is None:
        return None
    if (sizes["most"] or 0) >= LARGEST:
        raise ValueError(f"a component's integer is {sizes['most']}; exact distances need less than {LARGEST}")
    width = -(-sizes["n"] // parts)
    pad = F.when(F.size("v") < parts * width, F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(parts * width) - F.size("v")))).otherwise(F.col("v"))
    rows = rows.withColumn("v", pad)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    state, moved = rows, None
    for i in range(max(rounds, 1)):
        state = scratch.table(_round(state, books, moved), f"round-{i}")
        if i:
            scratch.drop(f"round-{i - 1}")
        new = _replaced(state, books) if rounds else books
        moved, books = moves(books, new), new
        state = state.where("sums IS NULL")
    return Trained(state, books, moved)


def encoded(model: Trained) -> DataFrame:
    """vec_id, label, code (an index for each part), error and scans (the parts that needed a full scan), by the final codebooks."""
    books, moved, (parts, _, width) = model.books, model.moved, model.books.shape
    fields = [f for f in model.rows.schema.fields if f.name in ("vec_id", "label")]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _flat(b, "v").astype(np.int64).reshape(-1, parts, width)
            state = Bounded(*[_flat(b, c).reshape(-1, parts) for c in ("code", "upper", "lower")], np.empty(0))
            found = assigned(v, books, state, moved)
            out = [_listed(found.code, pa.int8()), pa.array(errors(v, books, found.code), pa.int64()), pa.array(found.scanned.sum(1), pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + out, [*names, "code", "error", "scans"])

    schema = T.StructType([*fields, T.StructField("code", T.ArrayType(T.ByteType())), T.StructField("error", T.LongType()), T.StructField("scans", T.LongType())])
    return model.rows.mapInArrow(run, schema)


def books_digest(books: np.ndarray) -> str:
    """Hex SHA-256 of all components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def op11(vectors: DataFrame) -> DataFrame:
    """The contract's columns."""
    scratch = Scratch(vectors.sparkSession, "codes")
    model = trained(scratch, vectors)
    if model is None:
        kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
        return vectors.sparkSession.createDataFrame([], f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string")
    rows = scratch.table(encoded(model), "codes")
    by_label = scratch.table(rows.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error")), "labels")
    code = F.array_join(F.transform("code", lambda x: F.lower(F.lpad(F.hex(x.cast("long")), 2, "0"))), "")
    rows = rows.join(small(by_label, by_label.count()), F.col("label").eqNullSafe(F.col("__label")))
    return rows.select("vec_id", code.alias("code"), "error", "label_error", F.lit(books_digest(model.books)).alias("codebooks_sha256"))
