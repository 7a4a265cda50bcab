"""Exact top-k inner-product search with vector-approximation files.

Vectors become integers, floor(256 * x), and are packed into blocks of ``BLOCK_ROWS``. A block's
approximation file holds one byte for each component: its cell among up to 256 cells of equal
width between the block's least and greatest integer of that component. Exact vectors stay
apart, by row.

1. Query blocks meet the approximation files, and nothing else, by an equi-join on the block
   number. A scan of the cells bounds each vector's score from both sides; what lies under the
   block's kth greatest lower bound is ruled out.
2. Each query's kth greatest lower bound over all blocks rules out most of what is left.
3. Only the exact vectors of the survivors are fetched, by row. Each query reads them in the order
   of their upper bounds until its kth score exceeds the next bound; ties of score go to the
   smaller vec_id, so a vector whose bound equals the kth score is still read.

Of equal vectors only the k + 1 rows of smallest vec_id are candidates, as no other can be among
the k best of any query; so a vector that very many rows bear makes no ties to read. Nothing is
broadcast or collected, and no exact vector travels for a pair that the cells rule out. Scans are quadratic by nature: every query's cells are compared with every vector's.

Defined results: vectors that are null, or hold null or non-finite components, take no part,
nor do rows without vec_id; of vectors of different lengths the shorter counts as padded
with zeros; integers and scores are longs (components beyond 2**63 / 256 stop there, and scores
beyond 2**63 wrap); a row is never its own candidate, while other rows with its vec_id are, and
a vec_id that repeats among the queries gets its ranks for each of its rows; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factmill.llm.scratch import Scratch

K = 5
EVERY = 50
BLOCK_ROWS = 16384
QUERY_ROWS = 1024
CELLS = 256
SCAN_ROWS = 128
"""Queries that are compared with a block at once."""
READ = 64


def integers(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and v: array<long>, of the vectors that take part."""
    x = F.col(embedding)
    finite = ~F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & x.isNotNull() & finite)
    # floor of a double is a long that stops at the ends of its range
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e.cast("double") * 256)).cast("array<bigint>").alias("v"))


def _matrix(vectors, dims: int | None = None) -> np.ndarray:
    out = np.zeros((len(vectors), max(map(len, vectors), default=0) if dims is None else dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def approximated(exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of one byte, each dimension's least integer, and the width of its cells."""
    low = exact.min(axis=0, initial=0)
    high = exact.max(axis=0, initial=0)
    # in floats, as the range of longs can exceed a long; a width too large is only less sharp
    width = np.maximum(1, np.ceil((high.astype(np.float64) - low.astype(np.float64) + 1) * (1 + 2.0**-50) / CELLS)).astype(np.uint64)
    with np.errstate(over="ignore"):
        cells = ((exact.astype(np.uint64) - low.astype(np.uint64)) // width).astype(np.uint8)
    return cells, low, width


def _files(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows (block, ids, dims, cells, low, width): the approximation file of each block."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        exact = _matrix(frame["v"].to_list())
        cells, low, width = approximated(exact)
        return pd.DataFrame({
            "block": [int(frame["block"].iloc[0])], "ids": [frame["row"].to_numpy(np.int64).tobytes()], "dims": [exact.shape[1]],
            "cells": [cells.tobytes()], "low": [low.tobytes()], "width": [width.tobytes()],
        })

    rows = rows.select("row", "v", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
    return rows.groupBy("block").applyInPandas(pack, "block long, ids binary, dims int, cells binary, low binary, width binary")


def _query_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows (q_ids, q_dims, q_exact)."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        exact = _matrix(frame["v"].to_list())
        return pd.DataFrame({"q_ids": [frame["row"].to_numpy(np.int64).tobytes()], "q_dims": [exact.shape[1]], "q_exact": [exact.tobytes()]})

    rows = rows.withColumn("__b", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    return rows.groupBy("__b").applyInPandas(pack, "q_ids binary, q_dims int, q_exact binary")


def bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of each query (row) with each vector (column)."""
    dims = max(queries.shape[1], cells.shape[1])
    wide = lambda a, last: np.pad(a, [(0, 0)] * (a.ndim - 1) + [(0, dims - last)])
    q = wide(queries, queries.shape[1]).astype(np.float64)
    step, least = wide(width.astype(np.float64), cells.shape[1]), wide(low.astype(np.float64), cells.shape[1])
    room = np.maximum(step - 1, 0)
    floor = wide(cells, cells.shape[1]).astype(np.float64) * step + least
    base = q @ floor.T
    # of all roundings: each product and sum is off by no more than its terms' size, times 2**-53, times their number
    slack = (np.abs(q) @ (np.abs(floor).max(axis=0, initial=0) + room))[:, None] * (dims + 4) * 2.0**-51
    return base + (np.minimum(q, 0) @ room)[:, None] - slack, base + (np.maximum(q, 0) @ room)[:, None] + slack


def survivors(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray, k: int) -> pd.DataFrame:
    """query, row, lower, upper: of one block, the vectors that may be among a query's k best; a query's own row takes no part."""
    found = []
    for at in range(0, len(query_ids), SCAN_ROWS):
        own = query_ids[at : at + SCAN_ROWS]
        lower, upper = bounds(queries[at : at + SCAN_ROWS], cells, low, width)
        itself = own[:, None] == ids[None]
        lower[itself], upper[itself] = -np.inf, -np.inf
        if len(ids) > k:
            least = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            least = np.full(len(own), -np.inf)
        i, j = np.nonzero((upper >= least[:, None]) & ~itself)
        found.append(pd.DataFrame({"query": own[i], "row": ids[j], "lower": lower[i, j], "upper": upper[i, j]}))
    return pd.concat(found, ignore_index=True) if found else pd.DataFrame(columns=["query", "row", "lower", "upper"])


def read_in_order(query: list[int], vec_ids: np.ndarray, vectors: list, upper: np.ndarray, k: int) -> tuple[list[tuple[int, int]], int]:
    """The k best (vec_id, score), best first, and how many exact vectors were read until that was certain."""
    order = np.argsort(-upper, kind="stable")
    best: list[tuple[int, int]] = []
    for at in range(0, len(order), READ):
        if len(best) == k and upper[order[at]] < -best[-1][0]:
            return [(v, -s) for s, v in best], at
        some = order[at : at + READ]
        exact = _matrix([vectors[i] for i in some])
        own = np.zeros(exact.shape[1], np.int64)
        own[: len(query)] = query[: exact.shape[1]]
        with np.errstate(over="ignore"):
            score = (exact * own).sum(axis=1)
        best = sorted([*best, *zip((-score).tolist(), vec_ids[some].tolist(), strict=True)])[:k]
    return [(v, -s) for s, v in best], len(order)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k greatest inner products of each row of another table."""
    scratch = Scratch(vectors.sparkSession, "topk")
    rows = scratch.table(integers(vectors, vec_id, embedding).withColumn("row", F.monotonically_increasing_id()), "rows")
    asked = scratch.table(integers(queries, vec_id, embedding).withColumn("row", -1 - F.monotonically_increasing_id()), "asked")
    return _searched(scratch, rows, asked, k)


def top_k_within(vectors: DataFrame, asks, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """As ``top_k``, for those rows of ``vectors`` for which ``asks`` (a condition on vec_id) holds, against all other rows."""
    scratch = Scratch(vectors.sparkSession, "topk")
    rows = scratch.table(integers(vectors, vec_id, embedding).withColumn("row", F.monotonically_increasing_id()), "rows")
    return _searched(scratch, rows, rows.where(asks), k)


def _searched(scratch: Scratch, rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    alike = Window.partitionBy("v").orderBy("vec_id", "row")
    rows = scratch.table(rows.withColumn("__nth", F.row_number().over(alike)).where(F.col("__nth") <= k + 1).drop("__nth"), "candidates")
    n, n_asked = rows.count(), asked.count()
    blocks, groups = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_asked // QUERY_ROWS))
    files = scratch.table(_files(rows, blocks), "files")
    wanted = scratch.table(_query_blocks(asked, groups), "queries")
    asks = wanted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids, q_ids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.q_ids, np.int64)
                cells = np.frombuffer(r.cells, np.uint8).reshape(len(ids), r.dims)
                q = np.frombuffer(r.q_exact, np.int64).reshape(len(q_ids), r.q_dims)
                yield survivors(q_ids, q, ids, cells, np.frombuffer(r.low, np.int64), np.frombuffer(r.width, np.uint64), k)

    # one pair of blocks a row; dealt by a number that isn't coalesced, as each is much work for few bytes
    pairs = asks.join(files, "block").repartition(max(1, min(4000, blocks * groups)), F.col("block"), F.xxhash64("q_ids"))
    near = scratch.table(pairs.mapInPandas(scan, "query long, row long, lower double, upper double"), "near")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("lower")))
    least = near.withColumn("__nth", nth).where(F.col("__nth") == k).select("query", F.col("lower").alias("__least"))
    left = near.join(least, "query", "left").where(F.col("__least").isNull() | (F.col("upper") >= F.col("__least"))).select("query", "row", "upper")
    exact = left.join(rows.select("row", "vec_id", "v"), "row")
    own = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))

    def read(frame: pd.DataFrame) -> pd.DataFrame:
        best, _ = read_in_order(list(frame["q"].iloc[0]), frame["vec_id"].to_numpy(np.int64), frame["v"].to_list(), frame["upper"].to_numpy(), k)
        return pd.DataFrame({"query_id": int(frame["query_id"].iloc[0]), "rank": range(1, len(best) + 1), "vec_id": [v for v, _ in best], "score": [s for _, s in best]})

    # a named number of tasks isn't coalesced, as a query is some work for few bytes
    by_query = exact.join(own, "query").repartition(max(1, min(4000, n_asked // 128)), "query").groupBy("query")
    best = scratch.table(by_query.applyInPandas(read, "query_id long, rank int, vec_id long, score long"), "best")
    scratch.drop("rows", "asked", "candidates", "files", "queries", "near")
    return best


def op8(embeddings: DataFrame) -> DataFrame:
    """The contract's columns: queries are the rows whose vec_id is divisible by 50."""
    return top_k_within(embeddings, F.col("vec_id") % EVERY == 0)
