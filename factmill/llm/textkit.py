"""Vectorised work on batches of texts, shared by the operators that run in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

CHUNK_BYTES = 256 << 10
"""Bytes of text worked on at once; a longer text is worked on alone."""

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = mixed(np.arange(1001, 1033, dtype=np.uint64)) | np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as asked for."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            more = np.uint64(pow(_BASE, len(cls.up), 1 << 64))
            less = np.uint64(pow(_BASE, -len(cls.up), 1 << 64))
            cls.up, cls.down = np.concatenate([cls.up, cls.up * more]), np.concatenate([cls.down, cls.down * less])
        return cls.up[:n], cls.down[:n]


def chunks(texts: Iterable[str | None], limit: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """The texts as UTF-8 in runs of about ``limit`` bytes; null is empty."""
    run, size = [], 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        if run and size + len(raw) > limit:
            yield run
            run, size = [], 0
        run.append(raw)
        size += len(raw) + 1
    if run:
        yield run


def shingles(run: list[bytes], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all word shingles of each text, and each text's first position.

    Words are split at ASCII white space, A-Z lower-cased. A text of fewer words has its
    whole sequence as its only shingle; one without words has none.
    """
    with np.errstate(over="ignore"):
        data = _LOWER[np.frombuffer(b" ".join(run) + b" ", np.uint8)]
        lengths = np.fromiter(map(len, run), np.int64, len(run)) + 1
        begins = np.concatenate([[0], np.cumsum(lengths)])
        space = _SPACE[data]
        up, down = _Powers.get(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(np.where(space, np.uint64(0), _BYTE[data] * up), out=sums[1:])
        start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        end = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
        word = mixed((sums[end] - sums[start]) * down[start])
        first = np.searchsorted(start, begins)  # index of each text's first word
        count = np.diff(first)
        full = np.zeros(max(0, len(word) - words + 1), np.uint64)
        for k in range(words):
            full += word[k : k + len(full)] * _PLACE[k]
        full = mixed(full)
        n = np.where(count >= words, count - words + 1, np.minimum(count, 1))
        at = np.concatenate([[0], np.cumsum(n)])
        out = np.empty(at[-1], np.uint64)
        long = count >= words
        if long.any():
            src = np.repeat(first[:-1][long] - at[:-1][long], n[long]) + np.flatnonzero(np.repeat(long, n))
            out[np.repeat(long, n)] = full[src]
        for i in np.flatnonzero((count > 0) & ~long):
            own = word[first[i] : first[i] + count[i]]
            out[at[i]] = mixed(np.array([(own * _PLACE[: len(own)]).sum() + np.uint64(len(own)) * _PLACE[20]], np.uint64))[0]
        return out, at
