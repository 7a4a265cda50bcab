"""Exact n-gram Jaccard join: all links of 0.8 or more, as connected components.

Search by T-occurrence: a text that links with a query of n shingles must occur at least T
times in the query's inverted lists. As in DivideSkip, the longest lists are set aside, the
short ones are heap-merged with skips, and what occurs often enough in them is looked up in
the long lists by binary search. It runs in blocks of bounded size.

What meets in a block is chosen without loss, by a prefix filter: in an order common to all
texts, two linked sets share one of the first n - ceil(0.8 n) + 1 shingles of each. Shingles
that stand out in a count over all documents (a sketch of fixed size) come last in that order, the
others by hash, so a passage that very many documents share brings none of them together, and a
list that isn't of such shingles has few members.

Each posting carries its text's size and a sketch of 128 bits, by which false candidates are
dropped where they meet, before any pair is written; a link is lost to it with a probability under
1 in 10**9. What a shard tells of a list is each member's pair with the first member like it,
so no more pairs than members however many texts are alike. A posting is as large at any size
of the corpus, and the sets themselves move only for texts that are like some other.

Round one searches each text's links with one such leader, and contracts components; near
copies, however many, so end up in one component without their pairs being formed. Round two
takes the candidates that are left in different components (only texts that are like some
other can be); the regions that they connect are searched as a whole, in blocks of sets and
queries that all meet. Leaders with many texts are spread over blocks.

Copies are one node: the 128-bit hash of the shingle set. Inside round one a node goes by 64
of these bits; two sets that share them are told apart by size and sketch and both searched.

Defined results: null, empty and blank texts are linked with nothing and are their own
component; a null doc_id is never a component's smallest id unless all its ids are null;
repeated rows are copies; rows with one doc_id and different texts are texts of their own; an
empty table gives no rows; texts that share nothing give no pairs. Within a pair of sets
shingles are compared by 48-bit hashes.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factmill.llm.components import components
from factmill.llm.scratch import Scratch, arrow_rows, small
from factmill.llm.textkit import chunks, mixed, shingles

WORDS = 5
SKETCH_BITS = 20
FAN = 64
SHARD_POSTINGS = 600_000
BATCH_SETS = 2000
NEAR_BITS, BITS = 128, 512
BLOCK_SETS, BLOCK_QUERIES = 256, 512
BLOCK_PAIRS = 256
DENSE = 1 << 15
PROBES = 64
CROWD = 16
"""Members of one list alike within a batch beyond which only their leader goes on."""
_NULL_ID = -(1 << 63)
_LOW48 = np.uint64((1 << 48) - 1)


def _tail(bits: int) -> int:
    """The least t that a binomial of so many bits at one in ten exceeds with a chance under 1e-10."""
    above, term = 1.0, 0.9**bits
    for t in range(bits):
        above -= term
        if above < 1e-10:
            return t
        term *= (bits - t) / (t + 1) / 9
    return bits


_MOST = {bits: _tail(bits) for bits in (NEAR_BITS, BITS)}


def most_bits(total: np.ndarray, bits: int = BITS) -> np.ndarray:
    """In how many of the sketch's bits two linked sets of so many shingles together can differ.

    They differ in d <= total / 9 shingles, each of which flips a bit with probability one half
    at most; of full sketches a tenth of the bits differs at similarity 0.8. Both bounds leave
    out less than 1 in 10**9, and nothing where d is the bound.
    """
    d = np.asarray(total) // 9
    return np.minimum(np.minimum(d, d / 2 + 3.4 * np.sqrt(d)), _MOST[bits])


def linked(n: int, m: int, shared: int) -> bool:
    """Jaccard similarity of 0.8 or more, in whole numbers."""
    return 100 * shared >= 80 * (n + m - shared)


# ---- sets of shingles


def _pack(values: np.ndarray) -> bytes:
    """48-bit numbers in 6 bytes each."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _sketched(hashes: np.ndarray, owner: np.ndarray, rows: int, bits: int) -> np.ndarray:
    """One bit of each of so many bins' smallest hash, in words of 64, per set (one-permutation MinHash)."""
    h = mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))
    cell = owner * bits + (h >> np.uint64(55)).astype(np.int64) % bits
    low = (h & np.uint64((1 << 55) - 1)).astype(np.int64)
    least = np.full(rows * bits, 1 << 60, np.int64)
    order = np.argsort(-low)  # so that the last one written, the smallest, stays
    least[cell[order]] = low[order]
    return np.packbits((least & 1).astype(bool).reshape(rows, bits), axis=1).view("<u8")


_SETS = "kind int, doc_id long, row binary, n long, key binary, handle long, blob binary"


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of documents (kind 0), each new set once in a partition, and its count sketch (kind 1)."""
    cells = 1 << SKETCH_BITS
    sketch, seen = np.zeros(cells, np.int64), set()
    for batch in batches:
        at_row = 0
        for run in chunks(batch["text"]):
            hashes, at = shingles(run, WORDS)
            owner = np.repeat(np.arange(len(run)), np.diff(at))
            hashes &= _LOW48
            order = np.lexsort((hashes, owner))
            hashes = hashes[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            hashes, owner = hashes[new], owner[new]
            at = np.searchsorted(owner, np.arange(len(run) + 1))
            packed = _pack(hashes)
            keys, blobs, fresh = [], [], np.zeros(len(run), bool)
            for i in range(len(run)):
                blob = packed[6 * at[i] : 6 * at[i + 1]]
                key = xxhash.xxh3_128_digest(blob) if blob else None
                fresh[i] = key is not None and key not in seen
                if fresh[i]:
                    seen.add(key)
                keys.append(key)
                blobs.append(blob if fresh[i] else None)
            once = hashes[fresh[owner]] & np.uint64(cells - 1)
            cell, n = np.unique(once, return_counts=True)
            sketch[cell.astype(np.int64)] += n
            handles = pd.array([None if k is None else int.from_bytes(k[:8], "little", signed=True) for k in keys], "Int64")
            own = batch.iloc[at_row : at_row + len(run)]
            yield pd.DataFrame({"kind": 0, "doc_id": own["doc_id"].to_numpy(), "row": own["row"].to_numpy(), "n": np.diff(at), "key": keys, "handle": handles, "blob": blobs})
            at_row += len(run)
    part = 1 << 16
    rows = [(i, _counts_told(sketch[i * part : (i + 1) * part])) for i in range(cells // part) if sketch[i * part : (i + 1) * part].any()]
    if rows:
        slot, blob = zip(*rows, strict=True)
        yield pd.DataFrame({"kind": 1, "doc_id": slot, "row": None, "n": TaskContext.get().partitionId(), "key": None, "handle": pd.array([None] * len(rows), "Int64"), "blob": blob})


def _counts_told(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the greatest needs, told by the length."""
    return counts.astype(f"<u{next(k for k in (1, 2, 4, 8) if counts.max() < 256**k)}").tobytes()


def _counts_read(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) >> 16}").astype(np.int64)


def _heavy(table: DataFrame) -> np.ndarray:
    """Which sketch cells stand far above the mean; the sketch has a fixed size."""
    rows = table.where("kind = 1").select("doc_id", "n", "blob")

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(map(_counts_read, frame["blob"]))
        return pd.DataFrame({"doc_id": [int(frame["doc_id"].iloc[0])], "n": [int(frame["n"].iloc[0])], "blob": [_counts_told(total)]})

    # summed as a tree, so that no task adds up more than FAN pieces
    groups = int(rows.agg(F.max("n")).first()[0] or 0) + 1
    while groups > 1:
        groups = -(-groups // FAN)
        rows = rows.withColumn("n", F.floor(F.col("n") / FAN).cast("long")).groupBy("doc_id", "n").applyInPandas(add, "doc_id long, n long, blob binary")
    parts = rows.select(F.col("doc_id").alias("part"), "blob").collect()
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in parts:
        sketch[r["part"] << 16 : (r["part"] + 1) << 16] = _counts_read(r["blob"])
    mean = sketch.mean()
    return sketch > mean + 5 * np.sqrt(mean) + 16


# ---- postings: candidates without loss


def signatures(own: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The prefix of a set, mixed: two linked sets have one of these hashes at least in common.

    ``own`` is in order of hash; shingles of heavy cells come after all others.
    """
    n = len(own)
    common = heavy[(own & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
    first = n + 80 * n // -100 + 1
    out = own[~common][:first]
    return mixed(out if len(out) == first else np.concatenate([out, own[common][: first - len(out)]]))


def _cut(frame: pd.DataFrame, rows: int) -> Iterator[pd.DataFrame]:
    return (frame.iloc[i : i + rows] for i in range(0, len(frame), rows))


_TOLD = [("n", "<u2"), ("bits", "<u8", NEAR_BITS // 64)]
_POST = np.dtype([("sig", "<u4"), ("id", "<i8"), *_TOLD])
"""A posting: its signature within the shard, the node's handle, size and sketch. Sizes stop at
``LARGE``, which only lets more pairs pass; the bit above marks the leader of a crowd."""
LARGE, LEADS = (1 << 15) - 1, 1 << 15
_PAIR = np.dtype([("a", "<i8"), ("b", "<i8"), ("n", "<i8")])
_NODE = np.dtype([("n", "<u2"), ("label", "<i8"), ("bits", "<u8", BITS // 64)])


def _sketches(blobs, bits: int) -> np.ndarray:
    out = np.zeros((len(blobs), bits // 64), "<u8")
    for lo in range(0, len(blobs), 64):  # a few sets at a time, as some are long
        sets = [_unpack(b) for b in blobs[lo : lo + 64]]
        out[lo : lo + 64] = _sketched(np.concatenate(sets), np.repeat(np.arange(len(sets)), list(map(len, sets))), len(sets), bits)
    return out


def _alike(told: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Which of the nodes numbered a and b may be linked, by size and sketch."""
    n, m = (told["n"][a] & LARGE).astype(np.int64), (told["n"][b] & LARGE).astype(np.int64)
    out = 100 * np.minimum(n, m) >= 80 * np.maximum(n, m)
    at = np.flatnonzero(out)
    differ = np.bitwise_count(told["bits"][a[at]] ^ told["bits"][b[at]]).sum(axis=1, dtype=np.int64)
    out[at] = differ <= most_bits(n[at] + m[at], bits)
    return out


def _led(of: np.ndarray, node: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (leader, member) of lists: each member with the first one alike, if any.

    ``of`` numbers the lists in order, ``node`` their members. Step by step the first member
    of each list that has no leader yet leads those without one that are alike. A leader that
    leads none has its pair with a member that another leads, if these are alike. So a node
    is in some pair of a list if, and only if, any member is alike.
    """
    found_a, found_b = [], []
    free = np.ones(len(of), bool)
    while len(of):
        at = np.flatnonzero(free)
        first = at[np.concatenate([[True], of[at][1:] != of[at][:-1]])]
        leads = np.zeros(int(of[-1]) + 1, np.int64)
        leads[of[first]] = node[first]
        rest = np.ones(len(of), bool)
        rest[first] = False
        of, node, free = of[rest], node[rest], free[rest]
        if not len(of):
            break
        leader = leads[of]
        like = _alike(told, leader, node, NEAR_BITS)
        own = like & free
        found_a.append(leader[own])
        found_b.append(node[own])
        with_some = np.zeros(len(leads), bool)
        with_some[of[own]] = True
        other = np.flatnonzero(like & ~free & ~with_some[of])
        if len(other):
            other = other[np.concatenate([[True], of[other][1:] != of[other][:-1]])]
            found_a.append(node[other])
            found_b.append(leader[other])
        free &= ~like
        n_free = np.bincount(of[free], minlength=len(leads))
        n_led = np.bincount(of[~free], minlength=len(leads))
        go = (n_free > 1) | ((n_free > 0) & (n_led > 0))
        stay = go[of]
        of, node, free = of[stay], node[stay], free[stay]
        if len(of):  # lists that are done leave their numbers
            of = np.cumsum(np.concatenate([[0], (of[1:] != of[:-1]).astype(np.int64)]))
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _counted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of node numbers, and how often each occurs."""
    pairs, n = np.unique((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64), return_counts=True)
    return (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64), n


def _numbered(values: np.ndarray) -> np.ndarray:
    """0, 0, 1, 2, 2, ... for sorted values."""
    return np.cumsum(np.concatenate([[0], (values[1:] != values[:-1]).astype(np.int64)])) if len(values) else np.zeros(0, np.int64)


def _postings(shards: int, heavy):
    """Postings packed by shard.

    Where more than CROWD nodes of a batch are alike in one list, only their leader goes on in
    it, marked, and their pairs with it are told at once (shard below 0). So a list that a great
    many near copies share has a few nodes of each batch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = np.unpackbits(np.frombuffer(heavy.value, np.uint8)).astype(bool)
        for batch in (part for whole in batches for part in _cut(whole, BATCH_SETS)):
            if not len(batch):
                continue
            told = np.zeros(len(batch), _POST)
            told["id"], told["n"] = batch["handle"].to_numpy(np.int64), np.minimum(batch["n"].to_numpy(np.int64), LARGE)
            told["bits"] = _sketches(batch["blob"].to_list(), NEAR_BITS)
            sigs = [signatures(_unpack(b), mask) for b in batch["blob"]]
            node = np.repeat(np.arange(len(sigs)), list(map(len, sigs)))
            sig = np.concatenate(sigs)
            order = np.argsort(sig, kind="stable")
            sig, node = sig[order], node[order]
            rows, marked = [], np.zeros(len(sig), bool)
            of = _numbered(sig)
            crowded = (np.bincount(of) > CROWD)[of]
            if crowded.any():
                place = np.flatnonzero(crowded)
                # members by their places, as a pair must say of which list it is
                a, b = _led(_numbered(of[crowded]), np.arange(len(place)), told[node[place]])
                leads, n = np.unique(a, return_counts=True)
                led = np.isin(a, leads[n > CROWD]) & ~np.isin(b, leads)
                a, b = place[a[led]], place[b[led]]
                marked[a] = True
                x, y, n = _counted(node[a], node[b])
                if len(x):
                    pairs = np.zeros(len(x), _PAIR)
                    pairs["a"], pairs["b"], pairs["n"] = told["id"][x], told["id"][y], n
                    rows.append((-1 - int(abs(int(told["id"][x[0]])) % shards), pairs.tobytes()))
                stay = np.ones(len(sig), bool)
                stay[b] = False
                sig, node, marked = sig[stay], node[stay], marked[stay]
            posts = told[node]
            posts["sig"] = (sig & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            posts["n"] |= np.where(marked, LEADS, 0).astype(np.uint16)
            shard = ((sig >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            own, at = np.unique(shard[order], return_index=True)
            posts = posts[order]
            rows += [(int(s), posts[lo:hi].tobytes()) for s, lo, hi in zip(own, at, [*at[1:], len(posts)], strict=True)]
            yield pd.DataFrame(rows, columns=["shard", "posts"])

    return run


def _leader_pairs(frame: pd.DataFrame) -> pd.DataFrame:
    """Each list's pairs of a leader and a member alike, by handle; in lists with a marked leader,
    whose followers aren't there, the pairs of all others with it."""
    if int(frame["shard"].iloc[0]) < 0:
        told = np.frombuffer(b"".join(frame["posts"]), _PAIR)
        return pd.DataFrame({"a": told["a"], "b": told["b"], "n": told["n"]})
    posts = np.frombuffer(b"".join(frame["posts"]), _POST)
    order = np.argsort(posts["sig"], kind="stable")
    of = _numbered(posts["sig"][order])
    posts = posts[order[(np.bincount(of) > 1)[of]]] if len(of) else posts
    # a node's postings from several batches are one; two nodes with one handle aren't
    raw = posts[["id", "n", "bits"]]
    order = np.lexsort((posts["bits"][:, 0], posts["n"], posts["id"]))
    same = np.ones(max(len(posts) - 1, 0), bool)
    for field in ("id", "n"):
        same &= raw[field][order][1:] == raw[field][order][:-1]
    same &= (raw["bits"][order][1:] == raw["bits"][order][:-1]).all(axis=1)
    number = np.empty(len(posts), np.int64)
    number[order] = np.cumsum(np.concatenate([[0], (~same).astype(np.int64)]))[: len(posts)]
    told = np.zeros(int(number.max(initial=-1)) + 1, _POST)
    told[number] = posts
    pairs = np.unique((posts["sig"].astype(np.uint64) << np.uint64(32)) | number.astype(np.uint64))
    of, node = _numbered(pairs >> np.uint64(32)), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    a, b = _led(of, node, told)
    at = np.flatnonzero(told["n"][node] >= LEADS)
    if len(at):
        first = at[np.concatenate([[True], of[at][1:] != of[at][:-1]])]
        leads = np.full(int(of[-1]) + 1, -1)
        leads[of[first]] = node[first]
        met = (leads[of] >= 0) & (leads[of] != node)
        a, b = np.concatenate([a, leads[of][met]]), np.concatenate([b, node[met]])
    a, b, n = _counted(a, b)
    a, b = told["id"][a], told["id"][b]
    other = a != b
    return pd.DataFrame({"a": a[other], "b": b[other], "n": n[other]})


def _told_postings(heavy):
    """Rows (sig, node, label) of every signature, for round two."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = np.unpackbits(np.frombuffer(heavy.value, np.uint8)).astype(bool)
        for batch in (part for whole in batches for part in _cut(whole, BATCH_SETS)):
            sigs = [signatures(_unpack(b), mask) for b in batch["blob"]]
            if sigs:
                count = list(map(len, sigs))
                yield pd.DataFrame({"sig": np.concatenate(sigs).view(np.int64), "node": np.repeat(batch["node"].to_numpy(), count), "label": np.repeat(batch["label"].to_numpy(), count)})

    return run


def _told_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each node's sketch of BITS bits."""
    for batch in (part for whole in batches for part in _cut(whole, BATCH_SETS)):
        yield pd.DataFrame({"node": batch["node"], "n": batch["n"], "bits": [row.tobytes() for row in _sketches(batch["blob"].to_list(), BITS)]})


def _likely_forest(frame: pd.DataFrame) -> pd.DataFrame:
    """Which nodes of a block's lists may be linked though their components differ, as a forest.

    Queries and nodes of one list are compared by label, size and sketch; of the pairs that
    pass, only those that join two trees go on, fewer than the block has nodes.
    """
    ids, first, node = np.unique(frame["node"].to_numpy(np.int64), return_index=True, return_inverse=True)
    told = np.zeros(len(ids), _NODE)
    told["n"], told["label"] = np.minimum(frame["n"].to_numpy()[first], LARGE), frame["label"].to_numpy()[first]
    told["bits"] = np.frombuffer(b"".join(frame["bits"].iloc[first]), "<u8").reshape(len(ids), -1)
    root, found = np.arange(len(ids)), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    order = np.argsort(frame["group"].to_numpy(np.int64), kind="stable")
    group, node, query = frame["group"].to_numpy(np.int64)[order], node[order], frame["query"].to_numpy(bool)[order]
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    for lo, hi in zip(starts, [*starts[1:], len(group)], strict=True):
        asked, held = node[lo:hi][query[lo:hi]], node[lo:hi][~query[lo:hi]]
        labels, trees = told["label"][held], np.array([find(x) for x in held])
        for q in asked:
            rest = np.flatnonzero((labels != told["label"][q]) & (trees != find(q)))
            for k in rest[_alike(told, np.full(len(rest), q), held[rest], BITS)]:
                x, y = find(q), find(held[k])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    found.append((ids[x], ids[y]))
                    trees[(trees == x) | (trees == y)] = min(x, y)
    return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


# ---- T-occurrence search


class Lists:
    """Inverted lists of a block of sets: for each shingle, the sorted numbers of the sets that hold it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        of = np.repeat(np.arange(len(sets)), self.sizes)
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.lexsort((of, values))
        values, self.holders = values[order], of[order]
        self.shingles, self.starts = np.unique(values, return_index=True)
        self.ends = np.append(self.starts[1:], len(values))

    def search(self, query: np.ndarray) -> list[int]:
        """Numbers of the sets linked with the query, by DivideSkip."""
        if not len(self.shingles):
            return []
        n = len(query)
        at = np.searchsorted(self.shingles, query)
        at = np.minimum(at, len(self.shingles) - 1)
        at = at[self.shingles[at] == query]
        lengths = self.ends[at] - self.starts[at]
        # the least overlap with any linked set: 0.8 of the query's own size
        t = -(-80 * n // 100)
        if len(at) < t:
            return []
        order = np.argsort(-lengths, kind="stable")
        at = at[order]
        n_long = min(int(t / (0.0085 * np.log2(max(2, lengths.max())) + 1)), t - 1)
        long, short = at[:n_long], at[n_long:]
        pieces = [self.holders[self.starts[i] : self.ends[i]] for i in short]
        if sum(map(len, pieces)) <= DENSE:
            counts = self._merged([x.tolist() for x in pieces], t - n_long)
        else:  # so many in one block are merged by sorting, with the same numbers
            holders, n_times = np.unique(np.concatenate(pieces), return_counts=True)
            counts = dict(zip(holders[n_times >= t - n_long].tolist(), n_times[n_times >= t - n_long].tolist(), strict=True))
        found = np.fromiter(counts, np.int64, len(counts))
        if not len(found):
            return []
        shared = np.fromiter(counts.values(), np.int64, len(counts))
        for lo in range(0, len(found), PROBES):
            shared[lo : lo + PROBES] += self._probe(found[lo : lo + PROBES], self.starts[long], self.ends[long])
        return [int(h) for h, k in zip(found, shared, strict=True) if linked(n, self.sizes[h], int(k))]

    def _probe(self, holders: np.ndarray, lo: np.ndarray, end: np.ndarray) -> np.ndarray:
        """In how many of the lists each holder is, by binary searches in step."""
        wanted = holders[:, None]
        lo, hi = np.tile(lo, (len(holders), 1)), np.tile(end, (len(holders), 1))
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            less = open_ & (self.holders[np.minimum(mid, len(self.holders) - 1)] < wanted)
            hi = np.where(open_ & ~less, mid, hi)
            lo = np.where(less, mid + 1, lo)
        return ((lo < end) & (self.holders[np.minimum(lo, len(self.holders) - 1)] == wanted)).sum(axis=1)

    @staticmethod
    def _merged(lists: list[list[int]], t: int) -> dict[int, int]:
        """Numbers that occur in at least t of the sorted lists, with their counts: a heap merge that skips."""
        heap = [(own[0], k, 0) for k, own in enumerate(lists)]
        heapq.heapify(heap)
        found = {}
        while len(heap) >= t:
            least, popped = heap[0][0], []
            while heap and heap[0][0] == least:
                popped.append(heapq.heappop(heap))
            if len(popped) >= t:
                found[least] = len(popped)
                target = least + 1
            else:  # no number below the t-th smallest head can occur t times
                while heap and len(popped) < t - 1:
                    popped.append(heapq.heappop(heap))
                if not heap:
                    break
                target = max(heap[0][0], least + 1) if t > 1 else least + 1
            for _, k, at in popped:
                at = bisect_left(lists[k], target, at)
                if at < len(lists[k]):
                    heapq.heappush(heap, (lists[k][at], k, at))
        return found


def _search_block(frame: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) between a block's queries and its sets."""
    asked, held = frame[frame["query"]].drop_duplicates("node"), frame[~frame["query"]].drop_duplicates("node").sort_values("node")
    ids = held["node"].to_numpy(np.int64)
    lists = Lists([_unpack(b) for b in held["blob"]])
    links = [(int(a), int(ids[i])) for a, blob in zip(asked["node"], asked["blob"], strict=True) for i in lists.search(_unpack(blob)) if ids[i] != a]
    return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)


def _tasks(rows: int) -> int:
    """Tasks for so many rows in blocks: a named number isn't coalesced, as blocks are much work for few bytes."""
    return max(1, min(4096, rows // BLOCK_PAIRS))


def _searched(blocks: DataFrame, rows: int, sets: DataFrame) -> DataFrame:
    """Links found in so many rows (block, node, query)."""
    met = small(blocks.select("block", "node", "query"), rows).join(sets.select("node", "blob"), "node")
    return met.repartition(_tasks(rows), "block").groupBy("block").applyInPandas(_search_block, "a long, b long")


def _leader_blocks(near: DataFrame, rows: int) -> DataFrame:
    """Each node b with its leader a, in blocks; a leader with very many nodes is spread over several."""
    blocks = max(1, -(-rows // BLOCK_PAIRS))
    fan = near.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK_PAIRS).cast("long").alias("fan")).where("fan > 1")
    near = near.join(fan, "a", "left").withColumn("block", F.pmod(F.xxhash64("a", F.pmod(F.xxhash64("b"), F.coalesce("fan", F.lit(1)))), F.lit(blocks)))
    return near.select("block", F.col("b").alias("node"), F.lit(False).alias("query")).unionByName(near.select("block", F.col("a").alias("node"), F.lit(True).alias("query")).distinct())


def _group_blocks(rows: DataFrame, counts: DataFrame, n_rows: int) -> DataFrame:
    """Rows (group, node, label) in blocks: all are sets, and those outside a group's largest
    component are queries. Small groups share blocks; a large one is cut into blocks of sets
    and blocks of queries that all meet. ``counts``: group, size, most (its largest label), n_most."""
    rows = rows.join(counts, "group").withColumn("query", F.col("label") != F.col("most"))
    shared = max(1, n_rows // BLOCK_PAIRS)
    rows = rows.withColumn("n_set", F.ceil(F.col("size") / BLOCK_SETS).cast("long")).withColumn("n_ask", F.greatest(F.ceil((F.col("size") - F.col("n_most")) / BLOCK_QUERIES), F.lit(1)).cast("long"))
    own = lambda n: F.array(F.pmod(F.xxhash64("node", F.lit(7)), n))
    every = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    kept = ["group", "node", "label", "size"]
    sets = rows.select(*kept, F.explode(own(F.col("n_set"))).alias("i"), "n_ask").select(*kept, "i", F.explode(every(F.col("n_ask"))).alias("j"), F.lit(False).alias("query"))
    asked = rows.where("query").select(*kept, F.explode(own(F.col("n_ask"))).alias("j"), "n_set").select(*kept, F.explode(every(F.col("n_set"))).alias("i"), "j", F.lit(True).alias("query"))
    block = F.when(F.col("size") > BLOCK_SETS, F.xxhash64("group", "i", "j")).otherwise(F.pmod(F.xxhash64("group"), F.lit(shared)))
    return sets.unionByName(asked).select("group", "node", "label", "query", block.alias("block"))


def _counts(rows: DataFrame) -> DataFrame:
    """Of groups that hold more than one label: size, largest label and its count. Of groups of
    the very same members (told by their count and two hashes of 64 bits) only one is given."""
    by_label = rows.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    groups = by_label.groupBy("group").agg(F.sum("n").alias("size"), F.max_by("label", F.struct("n", "label")).alias("most"), F.max("n").alias("n_most"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    return groups.where("size > n_most").groupBy("x", "y", "size").agg(F.min_by(F.struct("group", "most", "n_most"), "group").alias("g")).select("g.*", "size")


def _likely(scratch: Scratch, sets: DataFrame, labels: DataFrame, heavy) -> DataFrame:
    """A forest of pairs of nodes of different components that may be linked.

    Only lists that hold several components count; these are compared in blocks, so that no
    list, however long, is in one task.
    """
    known = sets.join(labels, "node", "left").select("node", "n", "blob", F.coalesce("label", "node").alias("label"))
    posted = known.mapInPandas(_told_postings(heavy), "sig long, node long, label long").withColumnRenamed("sig", "group")
    counts = scratch.table(_counts(posted), "lists")
    n_lists = counts.count()
    if not n_lists:
        return scratch.table(labels.limit(0).select(F.col("node").alias("a"), F.col("label").alias("b")), "forest")
    n_rows = int(counts.agg(F.sum("size")).first()[0])
    blocks = _group_blocks(posted, small(counts, n_lists), n_rows)
    bits = scratch.table(sets.mapInPandas(_told_bits, "node long, n long, bits binary"), "bits")
    met = blocks.join(bits, "node").repartition(_tasks(n_rows // 4), "block").groupBy("block").applyInPandas(_likely_forest, "a long, b long")
    return scratch.table(met, "forest")


def _regions(scratch: Scratch, forest: DataFrame, labels: DataFrame) -> DataFrame:
    """Blocks of the nodes that likely pairs connect."""
    nodes = components(scratch, forest, "regions").select(F.col("node").alias("__n"), F.col("label").alias("group"))
    nodes = nodes.join(labels, F.col("__n") == F.col("node"), "left").select(F.col("__n").alias("node"), "group", F.coalesce("label", "__n").alias("label"))
    nodes = scratch.table(nodes, "region-nodes")
    return _group_blocks(nodes, _counts(nodes), nodes.count())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    return grouped(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, row (md5 of the text), n, group (binary; null where the text has no words), component_id."""
    with arrow_rows(docs.sparkSession, BATCH_SETS):
        return _grouped(docs)


def _grouped(docs: DataFrame) -> DataFrame:
    """All that runs Python is written to tables in here; what is returned only joins them."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    sets = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc_id"), F.unhex(F.md5("text")).alias("row"), "text").mapInPandas(_sets, _SETS)
    sets = scratch.table(sets, "sets")
    rows = scratch.table(sets.where("kind = 0").select(F.nullif("doc_id", F.lit(_NULL_ID)).alias("doc_id"), "row", "n", "key"), "rows")
    every = sets.where("kind = 0 AND blob IS NOT NULL").select("handle", "n", "key", "blob")
    labels = _labels(scratch, sets, every)
    scratch.drop("sets", "wanted-sets", "bits", "region-nodes")
    if labels is None:
        found = rows.where("key IS NOT NULL").groupBy(F.col("key").alias("__key")).agg(F.min("doc_id").alias("component_id")).withColumn("group", F.col("__key"))
    else:
        nodes = rows.where("key IS NOT NULL").groupBy(F.col("key").alias("__key")).agg(F.min("doc_id").alias("least")).join(labels, F.col("__key") == F.col("key"), "left")
        nodes = scratch.table(nodes.select("__key", "least", "label"), "nodes")
        most = nodes.where("label IS NOT NULL").groupBy("label").agg(F.min("least").alias("component_id"), F.min("__key").alias("group"))
        found = nodes.where("label IS NOT NULL").join(most, "label").select("__key", "component_id", "group")
        found = found.unionByName(nodes.where("label IS NULL").select("__key", F.col("least").alias("component_id"), F.col("__key").alias("group")))
    out = rows.join(found, F.col("key") == F.col("__key"), "left")
    return out.select("doc_id", "row", "n", "group", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _labels(scratch: Scratch, made: DataFrame, every: DataFrame) -> DataFrame | None:
    """key, label of the sets that are like some other; nothing if none is."""
    total = int(every.agg(F.sum("n")).first()[0] or 0)
    if not total:
        return None
    heavy = scratch.spark.sparkContext.broadcast(np.packbits(_heavy(made)).tobytes())
    shards = max(12, total // 5 // SHARD_POSTINGS)
    pairs = every.mapInPandas(_postings(shards, heavy), "shard long, posts binary").groupBy("shard").applyInPandas(_leader_pairs, "a long, b long, n long")
    pairs = scratch.table(pairs.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    wanted = scratch.table(pairs.select(F.col("a").alias("handle")).union(pairs.select("b")).distinct(), "wanted")
    n_wanted = wanted.count()
    if not n_wanted:
        return None
    sets = every.join(small(wanted, n_wanted), "handle").groupBy("key").agg(F.first("handle").alias("handle"), F.first("n").alias("n"), F.first("blob").alias("blob"))
    sets = scratch.table(sets.withColumn("node", F.monotonically_increasing_id()), "wanted-sets")
    scratch.drop("sets", "wanted")
    of = sets.select("handle", "node")
    near = pairs.join(of.select(F.col("handle").alias("a"), F.col("node").alias("x")), "a").join(of.select(F.col("handle").alias("b"), F.col("node").alias("y")), "b")
    near = scratch.table(near.groupBy(F.col("y").alias("b")).agg(F.max_by("x", F.struct("n", "x")).alias("a")), "near")
    n_near = near.count()
    links = scratch.table(_searched(_leader_blocks(near, n_near), 2 * n_near, sets), "links")
    labels = components(scratch, links, "leaders")
    forest = _likely(scratch, sets, labels, heavy)
    if forest.take(1):
        blocks = scratch.table(_regions(scratch, forest, labels), "blocks")
        more = scratch.table(_searched(blocks, blocks.count(), sets), "more-links")
        if more.take(1):
            labels = components(scratch, links.unionByName(more), "all")
    keyed = sets.select("key", "node").join(labels, "node", "left").select("key", F.coalesce("label", "node").alias("label"))
    return scratch.table(keyed, "labels")


def op5(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return near_duplicates(docs)


def kept_documents(docs: DataFrame) -> DataFrame:
    """One row of each group that links: that of the smallest doc_id (null ids last), and of its
    smallest text hash among rows of that id; of repeated rows one. Texts without words are
    linked with nothing, so all their rows stay."""
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    rows = grouped(docs).groupBy("group", "doc_id", "row").agg(F.count(F.lit(1)).alias("n"))
    rows = scratch.table(rows, "rows")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    keep = rows.where("group IS NOT NULL").groupBy("group").agg(F.min_by(F.struct("doc_id", "row", "n"), first).alias("kept")).select("kept.*")
    keep = keep.unionByName(rows.where("group IS NULL").select("doc_id", "row", F.lit(1).cast("long").alias("n")))
    keep = scratch.table(keep.select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), F.col("n").alias("__n")), "keep")
    scratch.drop("rows")
    text = F.unhex(F.md5("text"))
    own = docs.join(small(keep, keep.count()), F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & text.eqNullSafe(F.col("__row")))
    plain = [f.name for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    repeated = own.where("__n > 1").groupBy("__id", "__row").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("__doc")).select("__doc.*")
    return own.where("__n = 1").select(*docs.columns).unionByName(repeated)
