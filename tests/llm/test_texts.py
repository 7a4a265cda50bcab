"""Line dedup, decontamination, Jaccard join, licenses and PII against brute force on small rows."""

import hashlib
import re

import numpy as np
import pytest

from factmill.llm import decontamination, jaccard, licenses, linededup, pii

LONG = " ".join(f"w{i}" for i in range(3000))
NEAR = [f"n{i}" for i in range(200)]
DOCS = [
    (1, "a shared line here\nonly mine is this one\nshort", "en", "s"),
    (2, "A Shared Line here \nsomething else entirely\nshort", "en", "s"),
    (3, None, None, None),
    (4, "", "en", None),
    (None, "a shared line here", "en", "s"),
    (5, LONG, "en", "s"), (6, LONG + " tail", "en", "s"), (6, LONG + " tail", "en", "s"),
    (7, " ".join(NEAR), "en", "t"), (8, " ".join(["x", *NEAR[1:]]), "en", "t"), (9, " ".join([*NEAR[:150], *[f"z{i}" for i in range(50)]]), "en", "t"),
    (10, "one two", "en", "t"), (11, "ONE  two", "en", "t"), (12, " \n\t ", "en", "t"),
    (13, "Mail bob.1@example.com or 10.0.0.7 or 999.1.1.1, card 4111 1111 1111 1111, +1 (377) 555-0271.\nReleased under the MIT License.", "en", "t"),
    (14, "the apache license and the MIT-license, apache\nlicense", "en", "t"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).selectExpr("*", "'x' AS score", "0 AS node", "1 AS block")


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def test_lines(docs):
    strip = " \t\n\x0b\x0c\r"
    holders = {}
    for d, text, *_ in DOCS:
        for line in (text or "").split("\n"):
            key = line.strip(strip).translate(_LOW)
            if len(key) >= 10:
                holders.setdefault(key, set()).add(-(1 << 63) if d is None else d)
    want = []
    for d, text, *_ in DOCS:
        lines = (text or "").split("\n")
        own = -(1 << 63) if d is None else d
        kept = [x for x in lines if len(h := holders.get(x.strip(strip).translate(_LOW), ())) < 2 or min(h) == own]
        want.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    assert rows(linededup.op1(docs)) == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    keys = np.unique(keys)
    index = linededup.PerfectHash.of(keys)
    assert sorted(index.index(keys)) == list(range(len(keys))) and index.size == len(keys)


def test_jaccard(docs):
    sets = [(d, shingles(t)) for d, t, *_ in DOCS]
    comp = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    least = {c: min((sets[i][0] for i in range(len(sets)) if comp[i] == c and sets[i][0] is not None), default=None) for c in comp}
    want = [(d, len(s), least[comp[i]] if s else d) for i, (d, s) in enumerate(sets)]
    assert rows(jaccard.op5(docs)) == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))
    kept = [r["doc_id"] for r in jaccard.kept_documents(docs).collect()]
    assert sorted(x for x in kept if x) == [1, 2, 3, 4, 5, 7, 9, 10, 12, 13, 14] and None in kept


def test_divide_skip():
    rng = np.random.default_rng(2)
    base = [np.unique(rng.integers(0, 4000, 120)).astype(np.uint64) for _ in range(30)]
    sets = [np.unique(np.concatenate([b[: len(b) - k], rng.integers(0, 4000, k).astype(np.uint64)])) for b in base for k in (0, 3, 10, 16, 30)]
    lists = jaccard.Lists(sets)
    for q in sets[::4]:
        want = [i for i, s in enumerate(sets) if jaccard.linked(len(q), len(s), len(np.intersect1d(q, s)))]
        assert sorted(lists.search(q)) == want


def test_signatures_lose_no_link():
    rng = np.random.default_rng(3)
    none = np.zeros(1 << jaccard.SKETCH_BITS, bool)
    for n in [1, 2, 3, 4, 5, 6, 8, 9, 12, 17, 40, 99, 250, 800]:
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 48, n).astype(np.uint64))
            drop = int(rng.integers(0, n // 5 + 1))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 48, int(rng.integers(0, n // 4 + 1))).astype(np.uint64)]))
            heavy = none if rng.random() < 0.5 else none.copy()
            if heavy is not none:
                heavy[(a[: int(rng.integers(0, n + 1))] & np.uint64((1 << jaccard.SKETCH_BITS) - 1)).astype(np.int64)] = True
            if len(b) and jaccard.linked(len(a), len(b), len(np.intersect1d(a, b))):
                assert len(np.intersect1d(jaccard.signatures(a, heavy), jaccard.signatures(b, heavy)))


def test_decontamination(spark):
    item = " ".join(f"q{i}" for i in range(24))
    most = " ".join([f"q{i}" for i in range(20)])
    few = " ".join([f"q{i}" for i in range(15)])
    docs = spark.createDataFrame([(1, f"{LONG} {item} {LONG}"), (2, LONG + " " + most), (3, few), (4, None), (5, "tiny Item"), (None, item), (6, item), (6, few)], "doc_id long, text string").selectExpr("*", "1 AS __c", "2 AS item_id")
    bench = spark.createDataFrame([(1, item.upper()), (2, "tiny item"), (3, None), (4, ""), (None, most)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_shingles"], r["n_shared"]) for r in decontamination.op2(docs, bench).collect()}
    assert got == {
        (1, 1): (20, 20), (1, None): (16, 16), (2, 1): (20, 16), (2, None): (16, 16), (5, 2): (1, 1),
        (None, 1): (20, 20), (None, None): (16, 16), (6, 1): (20, 20), (6, None): (16, 16),
    }
    left = decontamination.kept_documents(docs, bench)
    # rows are judged one by one: of doc 6 the row without an item stays
    assert left.columns == docs.columns and sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == [(3, few), (4, ""), (6, few)]
    assert decontamination.op2(docs, bench.limit(0)).count() == 0 and decontamination.op2(docs.limit(0), bench).count() == 0


def test_licenses(docs):
    got = {r["doc_id"]: r for r in licenses.op7(docs).collect()}
    assert (got[14]["n_base"], got[14]["first_word"], got[14]["last_word"], got[14]["base_labels"]) == (3, 1, 7, "apache,mit")
    assert (got[13]["labels"], got[13]["score"], got[3]["n_words"], got[3]["first_word"], got[3]["score"]) == ("mit", 1.0, 0, None, 0.0)


def test_license_join_is_exact():
    counts = {w: i % 7 for i, w in enumerate(licenses.vocabulary())}
    index, rng = licenses.Index(counts), np.random.default_rng(4)
    for _ in range(400):
        label, unit, text = licenses.TEMPLATES[rng.integers(len(licenses.TEMPLATES))]
        own = sorted(set(licenses.words(text.encode())))
        block = [w for w in own if rng.random() < 0.83] + [b"other", b"words"]
        want = []
        for name, kind, other in licenses.TEMPLATES:
            t = set(licenses.words(other.encode()))
            if kind == unit and 5 * len(t & set(block)) >= 4 * len(t):
                want.append((name, len(t & set(block)) / len(t)))
        assert sorted(index.found(unit, block)) == sorted(want)


def test_wrapped_and_spaced_notices(spark):
    texts = {
        "mpl": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */",
        "cc-by": "some prose\nThis work is licensed under a Creative Commons\nAttribution 4.0 International License.\nmore prose",
        "bsd": "Redistribution and use in source and binary forms, with or without modification,\nare permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice,\n\n   this list of conditions and the following disclaimer.",
        "apache": "you may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.example.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "": "Mozilla Public\n" + "\nfiller words\n" * 40 + "\nThis Source Code Form is subject to\n" + "\nfiller words\n" * 40 + "\nthe terms of the License, v. 2.0.",
    }
    frame = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.op7(frame).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts)


def test_runs_against_all_runs():
    index, rng = licenses.Index({w: i % 7 for i, w in enumerate(licenses.vocabulary())}), np.random.default_rng(8)
    for _ in range(200):
        _, _, text = licenses.TEMPLATES[rng.integers(len(licenses.TEMPLATES))]
        tokens = [w for w in licenses.words(text.encode()) if rng.random() < 0.9]
        for _ in range(rng.integers(0, 60)):
            tokens.insert(rng.integers(len(tokens) + 1), b"x")
        cuts = [0, *sorted(rng.integers(0, len(tokens), 6)), len(tokens)]
        lines = [tokens[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]
        want = []
        for label, _, other in licenses.TEMPLATES:
            t, length = set(licenses.words(other.encode())), len(licenses.words(other.encode()))
            runs = [lines[a : b + 1] for a in range(len(lines)) for b in range(a, len(lines)) if sum(map(len, lines[a + 1 : b])) <= length]
            best = max(len(t & {w for line in run for w in line}) for run in runs)
            if 5 * best >= 4 * len(t):
                want.append((label, best / len(t)))
        assert sorted(index.found_in_runs(lines)) == sorted(want)


@pytest.fixture(scope="module")
def tagger():
    rng = np.random.default_rng(6)
    texts = [" ".join("".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(2, 8))) for _ in range(120)) for _ in range(40)]
    return pii.Tagger.fit(pii.training_windows(texts)[:800])


def test_base_spans_follow_the_patterns():
    patterns = {
        0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        2: r"[0-9]([\x20-]?[0-9])+", 3: r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    rng = np.random.default_rng(5)
    for _ in range(800):
        text = "".join(rng.choice(list("a.@-+0123 (%)4é")) for _ in range(60))
        want = [(k, *m.span()) for k, p in patterns.items() for m in re.finditer(p, text) if pii._checked(pii.KINDS[k], m[0])]
        assert pii.base_spans(text) == want


def test_pii(spark, docs, tagger):
    got = {r["doc_id"]: r["found"] for r in pii.find(docs.where("doc_id IN (3, 4, 13)"), tagger).collect()}
    assert [got[13][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1] and got[3]["spans"] == "" and got[4]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert set(pii.told(pii.base_spans(DOCS[14][1])).split(",")) <= set(got[13]["spans"].split(","))


def test_windows_are_reconciled(tagger):
    rng = np.random.default_rng(8)
    hits = 0
    for at in range(100, 160, 3):  # across a window's border
        text = "word " * 60
        text = text[:at] + " jane.doe77@mail.example.org " + text[at:]
        hits += any(t in (1, 2) for t in tagger.tagged([text])[0][at + 1 : at + 20])
    assert hits >= 18 and rng is not None


def test_empty_tables(spark, docs, tagger):
    none = docs.limit(0)
    for df in (linededup.op1(none), jaccard.op5(none), licenses.op7(none), pii.find(none, tagger)):
        assert df.count() == 0
