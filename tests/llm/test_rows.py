"""Mixing, sharding, top-k search and the classifiers on small rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from factmill.llm import labelled, mixing, quality, sharding, topk, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(900):
        source = "hot" if i % 3 == 0 else [None, "a", "b", "c", "tiny"][i % 5 if i < 890 else 4]
        source = "a" if source == "tiny" and i < 895 else source
        rows.append((None if i == 7 else i, None if i == 11 else " ".join(["w"] * int(rng.integers(0, 60 if i != 20 else 4000))), "en", source, 0))
    rows += [rows[5], rows[5]]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS size", "2 AS target", "3 AS shard")


def filled(sizes, weights, cap=3.0):
    """Water filling by repeated resharing."""
    total, capped = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(cap * sizes[i] for i in capped)
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if share[i] > cap * sizes[i] + 1e-9}
        if not over:
            return [cap * sizes[i] if i in capped else share[i] for i in range(len(sizes))]
        capped |= over


def test_targets_fill_like_water(spark):
    rng = np.random.default_rng(2)
    for _ in range(6):
        sizes = [int(10 ** rng.uniform(0, 5)) for _ in range(7)]
        names = [f"s{i}" for i in range(6)] + [None]
        got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long")).collect()}
        want = filled(sizes, [(5, 2, 1)[i % 3] for i in range(7)])
        assert all(abs(got[n] - w) <= 1e-6 * max(1, w) for n, w in zip(names, want, strict=True))


def test_permutation_is_one_to_one(spark):
    for n in (1, 2, 3, 10, 97, 1000):
        got = mixing.permuted(spark.range(n), F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long"), "x")
        assert sorted(r["x"] for r in got.collect()) == list(range(n))


def test_mix(docs):
    rows = mixing.op6(docs).collect()
    assert len(rows) == 902
    by = {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        t = by.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        t[0] += r["taken"]
        t[1] += r["size"]
    for taken, size, target, told in by.values():
        assert size == told and abs(taken - target) <= 3 * mixing.BLOCK + 1
    assert sorted(map(tuple, mixing.op6(docs).collect()), key=str) == sorted(map(tuple, rows), key=str)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() > 0


def test_mixed_documents_deliver_the_targets(spark):
    rows = [(i, " ".join(["w"] * (1000 + i % 500)), "en", "abc"[i % 3], 0) for i in range(1500)]
    long = spark.createDataFrame(rows, SCHEMA)
    want = {r["source"]: r["target"] for r in mixing.op6(long).select("source", "target").distinct().collect()}
    got = {}
    for r in mixing.mixed_documents(long).selectExpr("source", "doc_id").collect():
        got.setdefault(r["source"], []).append(r["doc_id"])
    for source, target in want.items():
        words = sum(1000 + i % 500 for i in got[source])
        assert abs(words / target - 1) < 0.005, (source, words, target)
        assert max(got[source].count(i) for i in set(got[source])) <= mixing.MAX_EPOCHS


def test_shards(docs):
    rows = sharding.op10(docs).collect()
    sizes = {}
    for r in rows:
        sizes.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(v) for v in sizes.values()]
    assert len(rows) == 902 and len(sizes) == 24 and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in sizes.values())
    hot = [sum(r["source"] == "hot" for r in rows if r["shard"] == s) for s in range(24)]
    assert max(hot) - min(hot) <= 2
    null = next(r for r in rows if r["doc_id"] == 11)
    assert (null["size"], null["text_crc32"]) == (8, 0)


def test_top_k(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 0.2, (700, 16)).astype(np.float32)
    vectors[50:60] = vectors[50]
    rows = [(i, vectors[i].tolist()) for i in range(700)] + [(700, None), (750, [float("nan")] * 16), (None, [0.1] * 16), (800, [None] * 16), (850, [float("inf")] * 16)]
    got = sorted(map(tuple, topk.op8(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0))).collect()))
    whole = np.floor(256 * vectors.astype(np.float64)).astype(np.int64)
    want = []
    for q in range(0, 700, 50):
        best = sorted((-int(s), i) for i, s in enumerate(whole @ whole[q]) if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)


def texts(rng, n):
    return [" ".join("".join(chr(97 + x) for x in rng.integers(0, 26, 5)) for _ in range(int(rng.integers(20, 60)))) for _ in range(n)]


def test_classifiers_learn_and_hold_out(spark):
    rng = np.random.default_rng(4)
    base = texts(rng, 600)
    bad = [i % 3 == 0 for i in range(600)]
    rows = [(i, (t.replace(" ", " vile fool ", 3) if b else t)) for i, (t, b) in enumerate(zip(base, bad, strict=True))]
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (1001, "")], "doc_id long, text string").withColumn("score", F.lit(9))
    labels = spark.createDataFrame([(i, int(not b), int(b)) for i, b in enumerate(bad)] + [(None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    for op, truth in ((toxicity.op9, lambda i: int(bad[i])), (quality.op3, lambda i: int(not bad[i]))):
        got = op(docs, labels).collect()
        assert len(got) == 603 and all(0 <= r["score"] <= 1 for r in got)
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
        held = [r for r in got if r["held_out"] and r["doc_id"] < 600]
        assert np.mean([r["predicted"] == truth(r["doc_id"]) for r in held]) > 0.9
    kept = toxicity.kept_documents(docs, labels)
    assert kept.columns == docs.columns and {r["score"] for r in kept.collect()} == {9}


def test_a_toxic_phrase_counts_in_a_long_text():
    rng = np.random.default_rng(5)
    base = texts(rng, 300)
    y = [i % 2 for i in range(300)]
    model = toxicity.Model.fit([t + " you vile fool now" if b else t for t, b in zip(base, y, strict=True)], y)
    long = " ".join(texts(rng, 60))
    clean, dirty = model.scores([long, long[:9000] + " you vile fool now " + long[9000:]])
    assert dirty > 0.5 > clean


def test_network_gradients_match_differences():
    rng = np.random.default_rng(6)
    net = quality.Network.fresh()
    chunks, first = quality.cut([bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (40, 700, 1500)])
    y, weight = np.array([0, 1, 1], np.float32), np.ones(3, np.float32)
    net._pairs_now = net.pairs()
    grads = net.gradients(chunks, first, y, weight)

    def loss():
        p = net.combine(net.pool(chunks), first)[-1].astype(np.float64)
        return -np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name in ("b2", "w2", "w1", "bias", "taps"):
        flat, g = net.p[name].reshape(-1), np.asarray(grads[name]).reshape(-1)
        for i in rng.integers(0, len(flat), 3):
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-2 - g[i]) < 0.05 * max(1, abs(g[i]))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert labelled.training_rows(docs, labels, "toxic") == ([], [])
    assert [r["score"] for r in toxicity.op9(docs, labels).collect()] == [0.5] == [r["score"] for r in quality.op3(docs, labels).collect()]


def test_empty_tables(docs, spark):
    none = docs.limit(0)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for df in (mixing.op6(none), sharding.op10(none), topk.op8(vectors), toxicity.op9(none, labels), quality.op3(none, labels)):
        assert df.count() == 0
