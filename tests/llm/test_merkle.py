"""The Merkle manifest against a tree built level by level in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from factmill.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    i, text, lang, source, n = r
    told = (i, source, lang, n if n is None else n + more, text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in told])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    """(level's own index, sibling or None) for each level but the root's."""
    return [(i >> k, nodes[(i >> k) ^ 1] if (i >> k) ^ 1 < len(nodes) else None) for k, nodes in enumerate(tree[:-1])]


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    trees = {g: levels([leaf(r) for r in own[g]]) for g in langs}
    top, out = levels([trees[g][-1][0] for g in langs]), []
    for j, g in enumerate(langs):
        for i, r in enumerate(own[g]):
            proof = path(trees[g], i) + path(top, j)
            at = leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0))
            for k, s in proof:
                at = digest(at) if s is None else digest(s, at) if k % 2 else digest(at, s)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[g][-1][0], root, digest(*[s for _, s in proof if s]), at, at == root))
    return out


def told(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def made(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "de", None, "ß", "Z", ""])
        rows.append((rng.choice([i, i * 7919, -i]), rng.choice([None, "", "é😀 \n", "some text " * (i % 9)]), lang, rng.choice([None, "", "a:b", "1:-"]), rng.choice([None, 0, i, -1])))
    return rows


@pytest.mark.parametrize("n", [1, 2, 3, 5, 257, 1400])
def test_against_brute_force(spark, n):
    rows = made(n, n)
    assert told(merkle.op13(spark.createDataFrame(rows, SCHEMA))) == sorted(brute(rows), key=str)


def test_three_steps_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = [(i, f"t{i}", "en" if i % 50 else "fr", "s", i) for i in range(300)]
    assert told(merkle.op13(spark.createDataFrame(rows, SCHEMA).repartition(7))) == sorted(brute(rows), key=str)


def test_odd_rows_and_clashing_names(spark):
    rows = [(None, None, None, None, None), (None, "x", None, "s", 1), (7, "a", "en", "s", 3), (7, "a", "en", "s", 3), (7, "b", "en", "s", 3), (9, "long " * 40000, "en", None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS leaf", "2 AS pos", "3 AS node", "4 AS root", "5 AS tampered", "6 AS items", "7 AS one")
    assert told(merkle.op13(docs)) == sorted(brute(rows), key=str)
    assert merkle.op13(docs.limit(0)).count() == 0


def test_a_manifest_proves_rows_and_rejects_changed_ones(spark):
    docs = spark.createDataFrame(made(120, 5), SCHEMA)
    rows = merkle.manifest(docs, carry={"again": merkle.leaf([F.col(f) for f in merkle.FIELDS]), "changed": merkle.leaf([F.col(f) if f != "text" else F.concat(F.coalesce("text", F.lit("")), F.lit("!")) for f in merkle.FIELDS])})
    got = rows.select((merkle.root_of(F.col("again")) == F.col("root")).alias("ok"), (merkle.root_of(F.col("changed")) == F.col("root")).alias("bad")).collect()
    assert len(got) == 120 and all(r["ok"] and not r["bad"] for r in got)
