"""The join of similar names and the closure of pairs, against all pairs and a simple walk."""

import random

import pytest
from pyspark.sql import functions as F

from factmill.operators import cluster, similar


def all_pairs(names, threshold=90.0):
    names = sorted(set(names))
    return {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if cluster.token_set_ratio(a, b) >= threshold}


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def got(df):
    rows = [(r["a"], r["b"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(rng, n, letters="abcd", common=("group", "holdings", "the")):
    names = []
    for _ in range(n):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 3))]
        words += [c for c in common if rng.random() < 0.3]
        if names and rng.random() < 0.4:  # a near copy of an earlier one
            words = list(rng.choice(names).split(" "))
            w = rng.randrange(len(words))
            at = rng.randint(0, len(words[w]))
            words[w] = rng.choice([words[w][:at] + rng.choice(letters) + words[w][at:], words[w][:at] + words[w][at + 1 :] or "x"])
            if rng.random() < 0.2:
                words.append(rng.choice(letters))
        rng.shuffle(words)
        names.append(" ".join(words))
    return names


@pytest.mark.parametrize(("seed", "threshold", "hot", "letters"), [(1, 90.0, 64, "abcd"), (2, 90.0, 2, "ab"), (3, 80.0, 3, "abcde"), (4, 95.0, 1, "abc"), (5, 70.0, 2, "abcdefgh")])
def test_equal_to_all_pairs(spark, seed, threshold, hot, letters):
    """With a low bound nearly every key is split, up to the last level."""
    cluster.shared_checkpoints(spark)
    names = made(random.Random(seed), 260, letters)
    want = all_pairs(names, threshold)
    met = got(similar.candidates(frame(spark, [*names, None, "", "  "]), threshold, hot))
    assert len(want) > 60 and want <= met
    if threshold == 90.0:
        assert got(cluster.similar_names(frame(spark, names))) == want


def test_candidates_grow_in_proportion_beside_a_common_token(spark):
    cluster.shared_checkpoints(spark)
    counts = {}
    for n in (1000, 4000):
        rng = random.Random(7)
        word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(6, 10)))  # noqa: E731, B023
        names = [" ".join([word(), word(), *(["group"] if i % 3 == 0 else []), *(["international"] if i % 4 == 0 else [])]) for i in range(n)] + ["group", "the group"]
        met = got(similar.candidates(frame(spark, names), 90.0))
        assert {("group", x) for x in names if "group" in x.split() and x > "group"} <= met
        counts[n] = len(met)
    assert counts[4000] < 8 * counts[1000] and counts[4000] < 4000 * 40, counts


def test_threshold_must_allow_the_filters(spark):
    with pytest.raises(ValueError, match="threshold"):
        similar.candidates(frame(spark, ["a"]), 60.0)


def walked(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root if x in {y for e in edges if e[0] != e[1] for y in e}}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed, monkeypatch):
    monkeypatch.setattr(cluster, "HUB", 3)
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(500, 500 + i) for i in range(60)]
    labels = cluster.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["label"] for r in labels.collect()} == walked(edges) and labels.count() == len(walked(edges))
    assert cluster.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_a_long_chain_and_a_star_take_few_rounds(spark):
    n = 100_000
    # the chain's ids are scattered; the star's hub is neither its least nor its greatest node
    at = lambda x: F.pmod(F.col(x) * 48_271, F.lit(2_147_483_647))
    chain = spark.range(1, n).select(at("id").alias("a"), F.pmod((F.col("id") + 1) * 48_271, F.lit(2_147_483_647)).alias("b"))
    star = spark.range(n).select((F.col("id") - 3_000_000).alias("a"), F.lit(-2_950_000).cast("long").alias("b"))
    told: dict = {}
    labels = cluster.components(chain.unionByName(star), told)
    rows = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    assert sorted(r["n"] for r in rows) == [n, n] and min(r["label"] for r in rows) == -3_000_000
    sizes = told["edges"]
    assert len(sizes) <= 16 and sizes == sorted(sizes, reverse=True) and sum(sizes) < 3 * sizes[0], sizes


def test_a_chain_in_order(spark):
    told: dict = {}
    chain = spark.range(20_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["label"] for r in cluster.components(chain, told).collect()} == {0} and len(told["edges"]) <= 16
