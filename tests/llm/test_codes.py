"""Vector codes with bounds against plain Lloyd rounds."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from factmill.llm import codes
from factmill.llm.scratch import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    longest = -(-max(len(r[1]) for r in kept) // 8) * 8
    v = [[int(np.floor(4096 * float(np.float32(x)))) for x in r[1]] + [0] * (longest - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, v[i]))
    v = np.array(v, np.int64).reshape(len(kept), 8, -1)
    books = [[v[i, p] for i in order[:entries]] for p in range(8)]

    def nearest():
        return [[min(range(len(books[p])), key=lambda c: (int(((x[p] - books[p][c]) ** 2).sum()), c)) for p in range(8)] for x in v]

    for _ in range(rounds):
        code = nearest()
        for p in range(8):
            for c in range(len(books[p])):
                own = [v[i, p] for i in range(len(v)) if code[i][p] == c]
                if own:
                    books[p][c] = np.array([int(s) // len(own) for s in np.sum(own, axis=0)])
    code = nearest()
    error = [sum(int(((x[p] - books[p][k[p]]) ** 2).sum()) for p in range(8)) for x, k in zip(v, code, strict=True)]
    by = {}
    for r, e in zip(kept, error, strict=True):
        by[r[2]] = by.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{c:02x}" for c in k), e, by[r[2]], digest) for r, k, e in zip(kept, code, error, strict=True)), key=str)


def told(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def made(n, dims, seed, levels=None):
    rng = np.random.default_rng(seed)
    v = rng.normal(0, 0.3, (n, dims)) if levels is None else rng.integers(0, levels, (n, dims)) / 4096
    v[n // 3 : n // 2] = v[n // 3]  # a group of copies
    return [(int(i), v[i].astype(np.float32).tolist(), None if i % 9 == 0 else int(i % 4)) for i in range(n)]


@pytest.mark.parametrize(("n", "dims", "levels"), [(400, 64, None), (300, 16, 3), (200, 24, 2), (5, 8, None), (1, 8, None)])
def test_against_plain_rounds(spark, n, dims, levels):
    """With few levels nearly every part has ties."""
    rows = made(n, dims, n + dims, levels)
    assert told(codes.op11(spark.createDataFrame(rows, SCHEMA).repartition(5))) == plain(rows)


def test_odd_rows(spark):
    rows = made(60, 12, 3)
    rows += [(70, None, 1), (71, [None] * 12, 1), (72, [float("nan")] * 12, 1), (73, [float("inf")] * 12, 1), (5, rows[5][1], 2), (5, rows[6][1], None), (None, rows[7][1], 3), (74, [0.5], 0), (75, [], 0)]
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS v", "3 AS error", "4 AS sums", "5 AS upper")
    assert told(codes.op11(vectors)) == plain(rows)
    assert told(codes.op11(vectors.limit(0))) == [] == told(codes.op11(vectors.where("vec_id IN (70, 71)")))
    with pytest.raises(ValueError, match="component"):
        codes.op11(spark.createDataFrame([(1, [1e9] * 8, 0)], SCHEMA))


def test_bounds_hold_and_spare_scans(spark):
    rng = np.random.default_rng(8)
    v = rng.integers(-4000, 4000, (3000, 4, 8))
    books = v[:16].transpose(1, 0, 2).copy()
    state, moved, spared = None, None, []
    for _ in range(8):
        state = codes.assigned(v, books, state, moved)
        d = np.sqrt(((v[:, :, None] - books[None]) ** 2).sum(-1).astype(float))
        assert (state.code == d.argmin(2)).all()
        sorted_d = np.sort(d, axis=2)
        assert (state.upper >= sorted_d[:, :, 0]).all() and (state.lower <= sorted_d[:, :, 1]).all()
        spared.append(1 - state.scanned.mean())
        new = np.stack([[v[state.code[:, p] == c, p].sum(0) // max(1, (state.code[:, p] == c).sum()) if (state.code[:, p] == c).any() else books[p, c] for c in range(16)] for p in range(4)])
        moved, books = codes.moves(books, new), new
    assert spared[0] == 0 and spared[-1] > 0.3
    # and the job's own count of scans falls
    model = codes.trained(Scratch(spark, "codes-test"), spark.createDataFrame(made(800, 64, 4), SCHEMA))
    scans = codes.encoded(model).agg(F.sum("scans")).first()[0]
    assert 0 < scans < 800 * 8
