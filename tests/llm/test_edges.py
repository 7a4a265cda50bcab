"""Odd rows, ties and limits of the training-data operators, against brute force."""

import hashlib
import itertools
import os
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from factmill.llm import decontamination, jaccard, licenses, linededup, mixing, pii, quality, topk, toxicity

DOCS = "doc_id long, text string"
STRIP = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def linked_classes(sets):
    """The number of the first member of each set's class."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i], sets[j]
        if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


# ---- n-gram Jaccard join


def test_texts_that_share_nothing(spark):
    rows = [(i, f"row {i} is unlike {i * 7} others {i * i} ok {i + 3}") for i in range(6)]
    docs = spark.createDataFrame(rows, DOCS)
    assert sorted((r["doc_id"], r["component_id"]) for r in jaccard.op5(docs).collect()) == [(i, i) for i in range(6)]
    assert jaccard.kept_documents(docs).count() == 6


def test_crowds_chains_and_shared_passages(spark):
    rng, rows = random.Random(1), []
    base = [f"b{i}" for i in range(120)]
    for _ in range(160):  # a crowd of near copies in one batch
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append(" ".join(w))
    for g in range(12):
        w = [f"g{g}_{i}" for i in range(rng.choice([1, 4, 5, 6, 8, 12, 30, 80]))]
        for _ in range(rng.choice([1, 2, 8])):  # each a change of the one before: chains whose ends aren't linked
            w = list(w)
            for _ in range(rng.randint(0, max(1, len(w) // 30))):
                w[rng.randrange(len(w))] = f"y{rng.randrange(10**6)}"
            rows.append(" ".join(w))
    passage = [f"p{i}" for i in range(60)]
    rows += [" ".join([f"r{i}_{k}" for k in range(rng.randint(0, 100))] + passage) for i in range(80)]
    first = linked_classes([shingles(t) for t in rows])
    docs = spark.createDataFrame(list(enumerate(rows)), DOCS).repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.op5(docs).collect()}
    assert got == {i: (len(shingles(t)), first[i]) for i, t in enumerate(rows)}


def test_kept_rows_with_null_and_repeated_ids(spark):
    long = [" ".join(f"{p}{i}" for i in range(60)) for p in "abcd"]
    rows = [(2, long[0]), (2, long[1]), (None, long[0]), (None, long[0] + " tail"), (None, long[2]), (None, long[2]), (3, long[1] + " tail"), (4, long[3]), (4, long[3]), (5, None), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit(1))
    kept = sorted((str(r["doc_id"]), (r["text"] or "")[:2]) for r in jaccard.kept_documents(docs).collect())
    assert kept == sorted([("2", "a0"), ("2", "b0"), ("None", "c0"), ("4", "d0"), ("5", ""), ("5", ""), ("6", "")])


def test_leaders_tell_who_is_alike():
    rng = np.random.default_rng(5)
    told = np.zeros(40, jaccard._POST)
    kinds = rng.integers(0, 2**63, (6, 2)).astype(np.uint64)
    told["bits"], told["n"] = kinds[rng.integers(0, 6, 40)], 1000
    of, node = np.repeat(np.arange(8), 5), np.concatenate([rng.permutation(40)[:5] for _ in range(8)])
    a, b = jaccard._led(of, node, told)
    for k in range(8):
        own = set(node[of == k].tolist())
        like = {x for x in own for y in own if x != y and jaccard._alike(told, np.array([x]), np.array([y]), jaccard.NEAR_BITS)[0]}
        assert like <= {*a.tolist(), *b.tolist()}


# ---- lines


def test_rows_of_one_id_lose_their_own_lines(spark):
    rows = [(1, "first shared line\nsecond shared line"), (2, "own line of this row\nfirst shared line"), (2, "second shared line\nanother own line"), (2, "second shared line\nanother own line"), (None, "another own line")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = sorted((str(r["doc_id"]), r["kept"]) for r in linededup.dedup_lines(docs).collect())
    assert got == sorted([("1", "first shared line\nsecond shared line"), ("2", "own line of this row"), ("2", ""), ("2", ""), ("None", "another own line")])


def test_lines_against_brute_force(spark):
    rng = random.Random(2)
    pool = [f"common line number {i}" for i in range(30)]
    rows = [(i // 2 if i % 7 == 0 else i, "\n".join(rng.choice(pool) if rng.random() < 0.5 else f"line {i} {k} of its own" for k in range(rng.randint(1, 9)))) for i in range(300)]
    holders = {}
    for d, text in rows:
        for line in text.split("\n"):
            holders.setdefault(line.strip(STRIP).translate(LOW), set()).add(d)
    want = []
    for d, text in rows:
        lines = text.split("\n")
        kept = [x for x in lines if len(h := holders[x.strip(STRIP).translate(LOW)]) < 2 or min(h) == d]
        want.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = [tuple(r) for r in linededup.op1(spark.createDataFrame(rows, DOCS).repartition(5)).collect()]
    assert sorted(got) == sorted(want)


def test_index_arrays_go_round():
    rng = np.random.default_rng(3)
    low, high = rng.integers(0, 1 << 63, 5000).astype(np.uint64), rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    count, least = rng.integers(1, 4, 5000), rng.integers(0, 100, 5000)
    index = linededup.LineIndex.read(**linededup.LineIndex.of(low, high, count, least).written())
    doc = rng.integers(0, 100, 5000)
    assert (index.dropped(low, high, doc) == ((count >= 2) & (doc != least))).all() and index.hash.size == 5000
    assert not index.dropped(high, low, doc).any()
    empty = linededup.LineIndex.of(low[:0], high[:0], count[:0], least[:0])
    assert not linededup.LineIndex.read(**empty.written()).dropped(low, high, doc).any()


# ---- decontamination


def test_items_of_all_sizes_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 9, 17, 40, 130])))) for i in range(60)]
    docs = []
    for i in range(120):
        own = rng.choice(items)[1].split()
        cut = own[: max(1, int(len(own) * rng.uniform(0.6, 1)))]
        docs.append((i, " ".join([f"o{rng.randrange(99)}" for _ in range(rng.randint(0, 30))] + cut + [f"o{rng.randrange(99)}" for _ in range(rng.randint(0, 30))])))
    want = set()
    for d, text in docs:
        for j, item in items:
            k = min(5, len(item.split()))
            s, w = shingles(item, k), text.split()
            t = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
            if 5 * len(s & t) >= 4 * len(s):
                want.add((d, j, len(s), len(s & t)))
    got = {tuple(r) for r in decontamination.op2(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and len(want) > 60


# ---- mixing


def test_shards_draw_counts_that_make_the_slots(spark):
    sources = spark.createDataFrame([("a", 700, 30), ("b", 40, 40), (None, 3, 9), ("none", 0, 0)], "source string, n_slots long, n_blocks long")
    counts = mixing.drawn(sources, 743, shards=8)
    rows = counts.collect()
    by = {s: sum(r["n"] for r in rows if r["source"] == s) for s in ("a", "b", None)}
    sizes = [sum(r["n"] for r in rows if r["shard"] == k) for k in range(8)]
    assert by == {"a": 700, "b": 40, None: 3} and max(sizes) - min(sizes) <= 1
    drawn = {(r["shard"], r["source"]): r["n"] for r in rows}
    assert len({drawn.get((k, "b"), 0) for k in range(8)}) > 1  # a draw, not an even split
    made = mixing.slots(counts, sources, 743).collect()
    told = {}
    for r in made:
        told.setdefault((r["shard"], r["source"]), []).append(r["block"])
    assert {k: len(v) for k, v in told.items()} == drawn
    uses = np.bincount([r["block"] for r in made if r["source"] == "a"], minlength=30)
    assert uses.max() - uses.min() <= 1 and uses.sum() == 700


def test_mixed_rows_that_repeat(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (1, "d e f g", "s"), (None, "h i", None), (None, "h i", None), (2, None, "s"), (2, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    made = {tuple(r["key"]): 0 for r in mixing.mix(docs).collect()}
    for r in mixing.mix(docs).collect():
        made[tuple(r["key"])] += r["copies"]
    assert mixing.mixed_documents(docs).count() == sum(made.values())
    assert mixing.mixed_documents(docs).where("text IS NULL").count() == 2


# ---- top-k


def brute_top(rows, k=5, every=50):
    whole = [(v, [int(np.floor(256 * float(x))) for x in e]) for v, e in rows]
    out = []
    for i, (q, a) in enumerate(whole):
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), v) for j, (v, b) in enumerate(whole) if j != i)[:k]
            out += [(q, n + 1, v, -s) for n, (s, v) in enumerate(best)]
    return sorted(out)


def test_top_k_of_repeats_lengths_and_large_values(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(0, 1, rng.integers(1, 9)).tolist()) for i in range(160)]
    rows += [(50, [1.0, 2.0]), (50, [0.5] * 8), (7, rows[50][1]), (900, [1e6, -3e5]), (950, [1e6, 2e6]), (951, []), (1000, [])]
    rows += [(2000 + i, [0.25, 0.25, 0.25]) for i in range(300)]  # ties of one vector
    got = topk.op8(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()
    assert sorted(map(tuple, got)) == brute_top(rows)


def test_bounds_hold_and_rule_out():
    rng = np.random.default_rng(8)
    exact = rng.integers(-(1 << 20), 1 << 20, (500, 24))
    cells, low, width = topk.approximated(exact)
    queries = rng.integers(-(1 << 20), 1 << 20, (20, 24))
    lower, upper = topk.bounds(queries, cells, low, width)
    score = queries.astype(object) @ exact.T.astype(object)
    assert (lower <= score.astype(float)).all() and (score.astype(float) <= upper).all() and width.min() > 1
    left = topk.survivors(np.arange(-20, 0), queries, np.arange(500), cells, low, width, 5)
    assert len(left) < 20 * 40
    order, read = topk.read_in_order(queries[0].tolist(), np.arange(500), list(exact), upper[0], 5)
    assert [v for v, _ in order] == np.argsort(-score[0].astype(float), kind="stable")[:5].tolist() and read < 500


# ---- classifiers


def test_without_labels_nothing_is_rejected(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)], DOCS)
    for rows in ([], [(1, 1, 1), (2, 0, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        assert toxicity.kept_documents(docs, labels).count() == 6


def test_very_long_texts_get_scores(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"] if i % 2 else ["rho", "sigma", "tau"]) for _ in range(40))) for i in range(200)]
    long = " ".join(["alpha beta gamma"] * 60000)
    docs = spark.createDataFrame([*rows, (900, long), (901, long)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    for op in (quality.op3, toxicity.op9):
        got = {r["doc_id"]: r["score"] for r in op(docs, labels).collect()}
        assert got[900] == got[901] > 0.5


# ---- licenses


def test_templates_from_a_table(spark):
    table = spark.createDataFrame([("acme", "May be used by friends of Acme alone"), ("acme-full", "Acme grants you\nthe right to read, copy and burn\nthis text in every weather"), (None, "x"), ("blank", " ")], "label string, text string")
    docs = spark.createDataFrame([(1, "may be used\nby FRIENDS of Acme, alone."), (2, "Acme grants you the right to read, copy\n\nand burn this text in every season"), (3, "nothing")], DOCS)
    got = {r["doc_id"]: r["scan"]["labels"] for r in licenses.scan(docs, table).collect()}
    assert got == {1: "acme", 2: "acme-full", 3: ""}


def test_base_places_against_brute_force(spark):
    rng = random.Random(9)
    words = ["mit", "license", "apache", "general", "public", "x", "é1", "MIT", "License"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", "-", "\n", ", "]) for _ in range(rng.randint(0, 25)))) for i in range(200)] + [(900, None), (901, "")]
    got = {r["doc_id"]: r for r in licenses.op7(spark.createDataFrame(rows, DOCS)).collect()}
    for d, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        at = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        want = (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at})))
        assert tuple(got[d][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == want


# ---- PII


@pytest.fixture(scope="module")
def net():
    rng = np.random.default_rng(11)
    texts = [" ".join("".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(2, 8))) for _ in range(120)) for _ in range(60)]
    return pii.Tagger.fit(pii.training_windows(texts))


@pytest.mark.parametrize("seed", [12, 13, 14, 15, 16])
def test_held_out_spans_are_found(net, seed):
    rng = np.random.default_rng(seed)
    own = ["".join(chr(97 + x) if x < 26 else " " for x in rng.integers(0, 30, 150)) for _ in range(300)]
    windows = [pii.written_window(rng, text, [k % 4, None]) for k, text in enumerate(own)]
    for kind, (precision, recall, n) in pii.scored(net, windows).items():
        assert n > 60 and recall >= 0.9 and precision >= 0.9, (kind, precision, recall)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_held_out_spans_are_found_in_documents():
    texts = [t for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist() if t]
    net, rest = pii.Tagger.fit(pii.training_windows(texts[::2])), texts[1::2]
    for seed in (1, 2, 3):
        windows = [w for w in pii.training_windows(rest, seed=seed, windows=600) if all(0 <= s and e <= len(w[0]) for _, s, e in w[1])]
        for kind, (precision, recall, n) in pii.scored(net, windows).items():
            assert n > 60 and recall >= 0.9 and precision >= 0.9, (seed, kind, precision, recall, n)


def test_written_spans_pass_their_own_check():
    rng = np.random.default_rng(13)
    for _ in range(400):
        kind, text = pii.written(rng)
        assert kind < 0 or pii._plausible(pii.KINDS[kind], text), (kind, text)


def test_paths_are_the_best(net):
    rng = np.random.default_rng(14)
    move = net.p["t"].astype(float)
    for n in (1, 2, 3, 4):
        e = rng.normal(0, 2, (n, pii.TAGS))
        score = lambda path: sum(e[i, k] for i, k in enumerate(path)) + sum(move[a, b] for a, b in zip((0, *path), (*path, 0)))  # noqa: E731, B023
        best = max(itertools.product(range(pii.TAGS), repeat=n), key=score)
        assert tuple(net.best_paths(e, np.array([0]), np.array([n]))[0]) == best


def test_settled_places_dont_change_the_path(net):
    rng = np.random.default_rng(15)
    text = pii.written_window(rng, "plain words stand here " * 30, [0, 1, 2, 3, -1, 3])[0]
    codes = pii.symbols(text)
    e = rng.normal(0, 2, (len(codes), pii.TAGS))
    e[:, 0] += 6
    whole = net.best_paths(e, np.array([0]), np.array([len(e)]))[0]
    at = np.flatnonzero(~net.settled(e, np.ones(len(e), bool)))
    breaks = np.flatnonzero(np.diff(at) > 1) + 1
    starts, ends = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(at)]])
    split = np.zeros(len(e), np.int8)
    for lo, hi, path in zip(starts, ends, net.best_paths(e[at], starts, ends), strict=True):
        split[at[lo:hi]] = path
    assert 0 < len(at) < len(e) and (split == whole).all()


def test_tagger_gradients_match_differences():
    rng = np.random.default_rng(16)
    net = pii.Tagger.fresh()
    for v in net.p.values():
        v *= 0.3
    codes, tags = rng.integers(0, 128, (9, 3)).astype(np.uint8), rng.integers(0, pii.TAGS, (9, 3))
    grads = net.gradients(codes, tags)

    def loss():
        e, move, total = net.emissions(codes).astype(np.float64), net.p["t"].astype(np.float64), 0.0
        for i in range(3):
            alpha = e[0, :, i]
            for t in range(1, 9):
                alpha = e[t, :, i] + np.log(np.exp(alpha[:, None] + move).sum(axis=0))
            own = e[np.arange(9), tags[:, i], i].sum() + move[tags[:-1, i], tags[1:, i]].sum()
            total += np.log(np.exp(alpha).sum()) - own
        return total / 3

    for name in ("t", "b", "w", "uf", "xb"):
        flat, g = net.p[name].reshape(-1), np.asarray(grads[name]).reshape(-1)
        for i in np.argsort(-np.abs(g))[:4]:
            old, step = flat[i], 1e-2
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * step) - g[i]) < 0.05 * max(0.2, abs(g[i])), name


def test_touching_spans_and_long_texts(net, spark):
    tags = np.zeros(40, np.int8)
    tags[0:12] = [7, *[8] * 11]
    tags[13:25] = [7, *[8] * 11]
    text = "555-123-4567 555-123-4568 and then words"
    assert pii.decoded(text, tags) == [(3, 0, 12), (3, 13, 25)]
    tags[12] = 8
    assert pii.decoded(text, tags) == [(3, 0, 12), (3, 13, 25)]
    long = "word " * 20000
    docs = spark.createDataFrame([(1, long + "a.b@c.org " + long), (2, long + "a.b@c.org " + long), (3, None)], DOCS)
    got = {r["doc_id"]: r["found"] for r in pii.find(docs, net).collect()}
    assert got[1] == got[2] and got[1]["n_email"] == 1 and "email:100000:100009" in got[1]["spans"]
    assert got[1]["base_sha256"] == hashlib.sha256(b"email:100000:100009").hexdigest() and got[3]["spans"] == ""


# ---- whole rows of the contract


def test_every_column_of_pii_rows(net, spark):
    rng = random.Random(21)
    pieces = ["a.b1@c-d.org", "x@y", "10.0.0.255", "10.0.0.256", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+12", "words", "é", "12 34", "+49 30 1234567"]
    rows = [(i, rng.choice([" ", "", ", "]).join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))) for i in range(150)] + [(900, None)]
    got = {r["doc_id"]: r["found"] for r in pii.find(spark.createDataFrame(rows, DOCS), net).collect()}
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def fits(k, s):
        d = re.sub("[^0-9]", "", s)
        luhn = sum((x := int(c) * (1 + i % 2)) - 9 * (x > 9) for i, c in enumerate(reversed(d))) % 10 == 0
        return [True, k == 1 and all(int(p) <= 255 for p in s.split(".")), 13 <= len(d) <= 19 and luhn, 9 <= len(d) <= 15][k]

    for d, text in rows:
        base = [(k, *m.span()) for k, p in enumerate(patterns) for m in re.finditer(p, text or "") if fits(k, m[0])]
        told = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert [got[d][f"n_{k}"] for k in pii.KINDS] == [sum(k == j for k, *_ in base) for j in range(4)]
        assert got[d]["base_sha256"] == hashlib.sha256(told.encode()).hexdigest() and set(told.split(",")) - {""} <= set(got[d]["spans"].split(","))


def test_every_column_of_mix_and_shard_rows(spark):
    import zlib

    from factmill.llm import sharding

    rng = random.Random(22)
    rows = [(i if i % 50 else None, rng.choice([None, "", "é x", " ".join(["w"] * rng.randint(1, 90))]), rng.choice(["a", "b", None, "c"])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("rank", F.lit(0))
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    totals = {s: sum(words(t) for _, t, x in rows if x == s) for s in ("a", "b", "c", None)}
    got = mixing.op6(docs).collect()
    assert sorted((str(r["doc_id"]), str(r["source"]), r["size"], r["source_size"]) for r in got) == sorted((str(d), str(s), words(t), totals[s]) for d, t, s in rows)
    shards = sharding.op10(docs).collect()
    want = sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "rows") for d, t, _ in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"], r["law"]) for r in shards) == want and {r["grown_shard"] for r in shards} == {None}
    assert [(r["shard"], r["slot"]) for r in sorted(shards, key=lambda r: (r["shard"], r["slot"]))] == [(s, k) for s in range(24) for k in range(sum(x["shard"] == s for x in shards))]
