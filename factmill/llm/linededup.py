"""Line dedup by a sharded minimal perfect hash over distinct line hashes.

1. One pass over the texts gives, for each line long enough, a 128-bit hash of its key. A batch
   tells two things of it, dealt to shards by hash and packed: for the index, once for each
   distinct line, how many documents of the batch hold it and the smallest of them; for
   probing, the lines of that smallest document with their places.
2. Each shard adds up the first and builds a minimal perfect hash over its distinct line hashes
   (levels of bits with sampled ranks, as in BBHash) that indexes an array of fingerprints, an
   array of document counts (one byte, as it need only tell 2 from 1) and an array of first
   holders. These arrays are written, one row for each shard.
3. The documents' line hashes probe the arrays of their shard; what comes out is only the
   lines to drop, packed by document. They are joined to the texts, and the rest is joined up.

Lines are never joined to lines, and all distinct lines are indexed, so that no line outside the
index is ever taken for one inside. A very common line would gather in one shard, so each batch
settles what it can: of its holders in the batch only the smallest document can keep it, and the
others' lines are dropped at once.

Defined results: null and empty texts are one empty line; rows of one doc_id are one
document for counting and holding, and each loses the lines of its own text that another, smaller
document holds; a null doc_id is ordered before all others and counts as one document; repeated
rows give equal results; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factmill.llm.scratch import Scratch, bounded_texts
from factmill.llm.textkit import mixed

MIN_CODE_POINTS = 10
SHARD_LINES = 1_000_000
"""Expected lines that a shard gets; shards grow with the input."""
LINES_PER_BYTE = 1 / 60
_STRIP = b" \t\n\x0b\x0c\r"
_NULL_ID = -(1 << 63)


def keyed_lines(text: str | None) -> tuple[list[int], list[bytes]]:
    """Places and keys of the lines long enough to be deduplicated."""
    places, keys = [], []
    for i, line in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")):
        key = line.strip(_STRIP).lower()
        if len(key) >= MIN_CODE_POINTS and (len(key) >= 4 * MIN_CODE_POINTS or len(key.decode("utf-8", "surrogatepass")) >= MIN_CODE_POINTS):
            places.append(i)
            keys.append(key)
    return places, keys


SAMPLE = 512
"""Bits between two sampled ranks."""


class Bits:
    """Packed bits, with the number of set bits before each position."""

    def __init__(self, packed: np.ndarray, size: int):
        self.packed, self.size = packed, size
        words = np.zeros(-(-size // SAMPLE) * SAMPLE // 64, "<u8")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        per = np.bitwise_count(words).reshape(-1, SAMPLE // 64).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(per.sum(axis=1))])

    def held(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        out = self.before[at // SAMPLE]
        for k in range(SAMPLE // 64):  # whole words between the sample and the position's own
            i = at // SAMPLE * (SAMPLE // 64) + k
            out = out + np.where(i < word, np.bitwise_count(self.words[np.minimum(i, len(self.words) - 1)]), 0)
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return out + np.bitwise_count(self.words[word] & below)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: levels of bits, one for each round of placing."""

    def __init__(self, levels: list[Bits]):
        self.levels = levels
        self.starts = np.concatenate([[0], np.cumsum([int(b.before[-1]) for b in levels])]).astype(np.int64)
        self.size = int(self.starts[-1])

    @classmethod
    def of(cls, keys: np.ndarray, room: float = 1.7) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(64, int(len(keys) * room))
            at = cls._place(keys, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(Bits(np.packbits(alone, bitorder="little"), size))
            keys = keys[~alone[at]]
        return cls(levels)

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mixed(keys + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(size)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """0 .. size-1, one to one on the keys it was built from; -1 or any for others."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, start) in enumerate(zip(self.levels, self.starts, strict=False)):
            at = self._place(keys[todo], level, bits.size)
            hit = bits.held(at)
            out[todo[hit]] = bits.rank(at[hit]) + start
            todo = todo[~hit]
        return out


_MANY = 2


class LineIndex:
    """Fingerprints, document counts and first holders of a shard's distinct lines."""

    def __init__(self, hash_: PerfectHash, prints: np.ndarray, counts: np.ndarray, holders: np.ndarray):
        self.hash, self.prints, self.counts, self.holders = hash_, prints, counts, holders

    @classmethod
    def of(cls, low: np.ndarray, high: np.ndarray, count: np.ndarray, least: np.ndarray) -> LineIndex:
        """From what the batches tell: lines, each with its documents' count and the smallest of them."""
        key = cls.joined(low, high)
        # of two lines whose joined halves agree (1 in 2**64) the first is indexed
        order = np.lexsort((least, high, key))
        key, high, count, least = key[order], high[order], count[order], least[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
        total = np.minimum(np.add.reduceat(count.astype(np.int64), starts), _MANY) if len(starts) else starts
        hash_ = PerfectHash.of(key[starts])
        at = hash_.index(key[starts])
        out = cls(hash_, np.zeros(len(starts), "<u4"), np.zeros(len(starts), "<u1"), np.zeros(len(starts), "<i8"))
        out.prints[at], out.counts[at] = high[starts] >> np.uint64(32), total
        out.holders[at] = np.minimum.reduceat(least, starts) if len(starts) else starts
        return out

    def written(self) -> dict[str, object]:
        levels = self.hash.levels
        return {"sizes": np.array([b.size for b in levels], "<i8").tobytes(), "bits": b"".join(b.packed.tobytes() for b in levels), "prints": self.prints.tobytes(), "counts": self.counts.tobytes(), "holders": self.holders.tobytes()}

    @classmethod
    def read(cls, sizes: bytes, bits: bytes, prints: bytes, counts: bytes, holders: bytes) -> LineIndex:
        levels, at = [], 0
        for size in np.frombuffer(sizes, "<i8").tolist():
            levels.append(Bits(np.frombuffer(bits, np.uint8)[at : at + -(-size // 8)], size))
            at += -(-size // 8)
        return cls(PerfectHash(levels), np.frombuffer(prints, "<u4"), np.frombuffer(counts, "<u1"), np.frombuffer(holders, "<i8"))

    @staticmethod
    def joined(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """One 64-bit key of both halves."""
        with np.errstate(over="ignore"):
            return mixed(low ^ mixed(high))

    def dropped(self, low: np.ndarray, high: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Whether each line is held by two documents at least and this one isn't its first holder."""
        if not len(low) or not self.hash.size:
            return np.zeros(len(low), bool)
        at = self.hash.index(self.joined(low, high))
        known = (at >= 0) & (self.prints[at] == (high >> np.uint64(32)).astype(np.uint32))
        return known & (self.counts[at] >= _MANY) & (self.holders[at] != doc)


def _whole_id():
    """doc_id as a long that is never null, as Arrow batches need."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc_id")


_INDEX, _PROBES, _SETTLED = 0, 1, 2
_LINES = "kind int, shard long, low binary, high binary, doc binary, row binary, number binary"


def _line_batches(shards: int):
    """Rows for the index (number: documents), for probing and settled (number: places), by shard."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            low, high, doc, row, place = [], [], [], [], []
            for doc_id, text_hash, text in zip(batch["doc_id"], batch["row"], batch["text"], strict=True):
                places, keys = keyed_lines(text)
                for key in keys:
                    h = xxhash.xxh3_128_intdigest(key)
                    low.append(h & 0xFFFFFFFFFFFFFFFF)
                    high.append(h >> 64)
                place += places
                doc += [doc_id] * len(places)
                row += [text_hash] * len(places)
            if not low:
                continue
            low, high = np.array(low, np.uint64), np.array(high, np.uint64)
            doc, row, place = np.array(doc, np.int64), np.array(row, np.int64), np.array(place, np.int64)
            order = np.lexsort((doc, high, low))
            low, high, doc, row, place = low[order], high[order], doc[order], row[order], place[order]
            new = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
            run, first = np.cumsum(new) - 1, np.flatnonzero(new)
            beaten = doc != doc[first][run]
            documents = np.add.reduceat((new | np.concatenate([[True], doc[1:] != doc[:-1]])).astype(np.int64), first)
            shard = ((low >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)
            rows = []
            for s in np.unique(shard):
                own = (shard == s) & ~beaten
                head = own & new
                rows.append((_INDEX, int(s), low[head].tobytes(), high[head].tobytes(), doc[head].tobytes(), b"", documents[run[head]].tobytes()))
                rows.append((_PROBES, int(s), low[own].tobytes(), high[own].tobytes(), doc[own].tobytes(), row[own].tobytes(), place[own].tobytes()))
            if beaten.any():
                rows.append((_SETTLED, 0, b"", b"", doc[beaten].tobytes(), row[beaten].tobytes(), place[beaten].tobytes()))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _LINES.split(", ")])

    return lines


_DROPS = "drop_id long, drop_row long, places binary"


def _drops(doc: np.ndarray, row: np.ndarray, place: np.ndarray) -> pd.DataFrame:
    order = np.lexsort((place, row, doc))
    doc, row, place = doc[order], row[order], place[order]
    at = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])])[: len(doc)])
    return pd.DataFrame({"drop_id": doc[at], "drop_row": row[at], "places": [p.astype(np.int32).tobytes() for p in np.split(place, at[1:])] if len(at) else []})


def _read(frame: pd.DataFrame, column: str, kind=np.int64) -> np.ndarray:
    return np.frombuffer(b"".join(frame[column]), kind)


def _built(frame: pd.DataFrame) -> pd.DataFrame:
    index = LineIndex.of(_read(frame, "low", np.uint64), _read(frame, "high", np.uint64), _read(frame, "number"), _read(frame, "doc"))
    return pd.DataFrame([{"shard": int(frame["shard"].iloc[0]), **index.written()}])


def _probed(lines: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    if not len(lines) or not len(index):
        return _drops(*[np.zeros(0, np.int64)] * 3)
    arrays = index.iloc[0]
    low, high, doc = _read(lines, "low", np.uint64), _read(lines, "high", np.uint64), _read(lines, "doc")
    gone = LineIndex.read(*[arrays[c] for c in ("sizes", "bits", "prints", "counts", "holders")]).dropped(low, high, doc)
    return _drops(doc[gone], _read(lines, "row")[gone], _read(lines, "number")[gone])


def _settled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield _drops(_read(batch, "doc"), _read(batch, "row"), _read(batch, "number"))


def dropped_lines(docs: DataFrame) -> DataFrame:
    """drop_id, drop_row, places: packed 32-bit places of lines to drop; several rows for a document."""
    bounded_texts(docs.sparkSession, 4000)
    scratch = Scratch(docs.sparkSession, "lines")
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(16, int(size * LINES_PER_BYTE / SHARD_LINES))
    lines = docs.select(_whole_id(), _row(), "text").mapInPandas(_line_batches(shards), _LINES)
    lines = scratch.table(lines, "lines")
    index = lines.where(F.col("kind") == _INDEX).groupBy("shard").applyInPandas(_built, "shard long, sizes binary, bits binary, prints binary, counts binary, holders binary")
    index = scratch.table(index, "index")
    probes = lines.where(F.col("kind") == _PROBES).groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_probed, _DROPS)
    settled = lines.where(F.col("kind") == _SETTLED).mapInPandas(_settled, _DROPS)
    drops = scratch.table(probes.unionByName(settled), "drops")
    scratch.drop("lines", "index")
    return drops


def _row():
    """Tells a row from others with its doc_id."""
    return F.xxhash64("text").alias("row")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, kept (the text that is left), n_lines, n_dropped."""
    drops = dropped_lines(docs).groupBy("drop_id", "drop_row").agg(F.collect_list("places").alias("places"))
    same = (F.col("doc_id") == F.col("drop_id")) & (F.col("row") == F.col("drop_row"))
    joined = docs.select(_whole_id(), _row(), "text").join(drops, same, "left").select("doc_id", "text", "places")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept, n, gone = [], [], []
            for text, places in zip(batch["text"], batch["places"], strict=True):
                lines = (text or "").split("\n")
                n.append(len(lines))
                if places is not None and len(places):
                    out = set(np.frombuffer(b"".join(places), np.int32).tolist())
                    lines = [line for i, line in enumerate(lines) if i not in out]
                    kept.append("\n".join(lines))
                else:
                    kept.append(text or "")
                gone.append(n[-1] - len(lines))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "kept": kept, "n_lines": n, "n_dropped": gone})

    out = joined.mapInPandas(cut, "doc_id long, kept string, n_lines long, n_dropped long")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_NULL_ID)))


def op1(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
