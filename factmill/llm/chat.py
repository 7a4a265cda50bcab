"""Chat formatting with a loss mask aligned by offsets.

A conversation's turns are rendered into one text by a template whose control strings mark the
turns. The text is encoded once, with offsets; the spans of the trained-on turns, sorted, are
intersected with the sorted token spans by binary search, which gives the mask. The control
strings are tokens of their own, added to the vocabulary, so no token reaches over a turn's border.

Control strings inside a text are escaped: a backslash goes behind their first character, and one
more where backslashes already stand there. Taking one away restores the text, whatever it held.

Turns are dealt by conversation and by blocks of ``TURNS`` turn numbers, and read in order, so an
ordinary conversation is one text, a conversation of a third of all rows is spread over tasks,
and a task holds ``CHARS`` characters and one turn at a time at most. A longer one is a row per
piece. As markers part the turns, pieces give the same tokens as the whole.

Defined results: a null text or role is empty; a null conv_id is a conversation of its own; null
turns come first, equal ones by role, then text, and equal rows are all kept; an empty table
gives no rows; other columns stay out.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factmill.llm.scratch import bounded_texts

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
TURNS = 1024
CHARS = 1_000_000


@dataclass(frozen=True)
class Template:
    """What opens and closes a turn of each role; other roles stand between ``role`` and ``text``.

    No control string may hold a backslash, or another's first character behind its own.
    """

    roles: tuple[tuple[str, str, str], ...] = (("user", "[INST]", "[/INST]"), ("assistant", "<s>", "</s>"), ("system", "[SYS]", "[/SYS]"))
    role: str = "[ROLE]"
    text: str = "[TEXT]"
    end: str = "[/TEXT]"
    trained: frozenset[str] = frozenset({"assistant"})
    _re: dict[str, re.Pattern] = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self) -> None:
        firsts = {c[0] for c in self.controls}
        if any(len(c) < 2 or firsts & set(c[1:]) for c in self.controls) or "\\" in "".join(self.controls) or len(set(self.controls)) < len(self.controls):
            raise ValueError("control strings must differ, have two characters or more, no backslash, and no first character of another inside")

    @property
    def controls(self) -> list[str]:
        return [c for _, a, b in self.roles for c in (a, b)] + [self.role, self.text, self.end]

    def _pattern(self, name: str) -> re.Pattern:
        if name not in self._re:
            one = "|".join(re.escape(c[0]) + r"(?=%s\\*" + re.escape(c[1:]) + ")" for c in self.controls)
            self._re["escape"] = re.compile(one.replace("%s", ""))
            self._re["unescape"] = re.compile("(" + one.replace("%s", r"\\") + r")\\")
            self._re["control"] = re.compile("(" + "|".join(map(re.escape, self.controls)) + ")")
        return self._re[name]

    def escaped(self, text: str) -> str:
        return self._pattern("escape").sub(lambda m: m[0] + "\\", text)

    def unescaped(self, text: str) -> str:
        return self._pattern("unescape").sub(lambda m: m[1], text)

    def rendered(self, turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int, bool]]]:
        """The text, and each turn's span of its own text with whether it is trained on."""
        known = {r: (a, b) for r, a, b in self.roles}
        out, spans, at = [], [], 0
        for role, text in turns:
            begin, close = known.get(role) or (self.role + self.escaped(role) + self.text, self.end)
            body = self.escaped(text)
            out += [begin, body, close]
            spans.append((at + len(begin), at + len(begin) + len(body), role in self.trained))
            at = spans[-1][1] + len(close)
        return "".join(out), spans

    def parsed(self, formatted: str) -> Iterator[tuple[str, str]]:
        """The turns (role, text) that a formatted text holds."""
        opens, role, spans = {a: r for r, a, _ in self.roles}, "", self._pattern("control").split(formatted)
        for i in range(1, len(spans) - 1, 2):
            mark, body = spans[i], spans[i + 1]
            if mark == self.role:
                role = self.unescaped(body)
            elif mark == self.text or mark in opens:
                yield opens.get(mark, role), self.unescaped(body)


LLAMA_LIKE = Template()


@lru_cache(maxsize=4)
def tokenizer(path: str, controls: tuple[str, ...]):
    """The vocabulary with the control strings as special tokens, in a process that doesn't spread over cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer

    found = Tokenizer.from_file(path)
    # a text may spell out the vocabulary's own special tokens: with this flag those stay ordinary text, so the controls are plain added tokens
    found.encode_special_tokens = True
    found.add_tokens([AddedToken(c, normalized=False, special=False) for c in controls])
    return found


class Encoded(NamedTuple):
    ids: np.ndarray
    start: np.ndarray
    end: np.ndarray
    loss: np.ndarray


def encoded(formatted: str, spans: list[tuple[int, int, bool]], vocabulary: str = VOCABULARY, template: Template = LLAMA_LIKE) -> Encoded:
    """Token ids, their spans in code points, and 1 for tokens that meet a trained-on turn."""
    got = tokenizer(vocabulary, tuple(template.controls)).encode(formatted, add_special_tokens=False)
    offsets = np.array(got.offsets, np.int64).reshape(-1, 2)
    start, end = offsets[:, 0], offsets[:, 1]
    turns = np.array([s[:2] for s in spans if s[2] and s[1] > s[0]], np.int64).reshape(-1, 2)
    first, last = np.searchsorted(end, turns[:, 0], "right"), np.searchsorted(start, turns[:, 1], "left")
    steps = np.zeros(len(start) + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last, -1)
    return Encoded(np.array(got.ids, np.int64), start, end, (np.cumsum(steps[:-1]) > 0).astype(np.int8))


def under_mask(formatted: str, start: np.ndarray, end: np.ndarray, loss: np.ndarray) -> Iterator[tuple[int, int]]:
    """The runs of characters, ascending and apart, that tokens with loss cover."""
    a, b = start[loss > 0], end[loss > 0]
    if not len(a):
        return
    reach = np.maximum.accumulate(b)
    new = np.concatenate([[True], a[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    yield from zip(a[at].tolist(), np.maximum.reduceat(b, at).tolist(), strict=True)


def _pieces(rows: Iterable[tuple], limit: int) -> Iterator[tuple[object, object, int, list[tuple[str, str]]]]:
    """conv_id, block, number of the piece and its turns, from sorted (conv_id, block, role, text)."""
    key, turns, size, piece = None, [], 0, 0
    for conv, block, role, text in rows:
        if key is not None and (key != (conv, block) or size + len(text) > limit):
            yield *key, piece, turns
            piece = piece + 1 if key == (conv, block) else 0
            turns, size = [], 0
        key = (conv, block)
        turns.append((role, text))
        size += len(text)
    if key is not None:
        yield *key, piece, turns


def _rows(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[b.column(n).to_pylist() for n in names], strict=True)


SHAPE = [
    T.StructField("piece", T.IntegerType()), T.StructField("n_turns", T.LongType()), T.StructField("formatted", T.StringType()),
    T.StructField("input_ids", T.ArrayType(T.IntegerType())), T.StructField("token_start", T.ArrayType(T.IntegerType())),
    T.StructField("token_end", T.ArrayType(T.IntegerType())), T.StructField("loss_mask", T.ArrayType(T.ByteType())),
]
BATCH_CHARS = 4_000_000


def formatted(turns: DataFrame, template: Template = LLAMA_LIKE, vocabulary: str = VOCABULARY, chars: int = CHARS) -> DataFrame:
    """conv_id, block, piece, n_turns, formatted, input_ids, token_start, token_end, loss_mask: a row per conversation, or per piece of a long one."""
    bounded_texts(turns.sparkSession)
    empty = F.lit("")
    block = F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(1 << 62))).cast("long")
    rows = turns.select("conv_id", block.alias("block"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    rows = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", F.col("turn").asc_nulls_first(), "role", "text")
    fields = [rows.schema["conv_id"], rows.schema["block"], *SHAPE]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, held, size = None, [], 0

        def named() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in batches:
                kind = b.schema.field("conv_id").type
                yield b

        def batch(held: list[tuple]) -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.int32(), pa.int64(), pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.int8())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], [f.name for f in fields])

        for conv, at, piece, said in _pieces(_rows(named(), ["conv_id", "block", "role", "text"]), chars):
            text, spans = template.rendered(said)
            held.append((conv, at, piece, len(said), text, *encoded(text, spans, vocabulary, template)))
            size += len(text)
            if size >= BATCH_CHARS:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    return rows.mapInArrow(run, schema)


def trained_runs(pieces: DataFrame) -> DataFrame:
    """conv_id, block, piece, formatted, starts and ends (the runs of characters under the loss mask), n_tokens, n_loss_tokens."""
    bounded_texts(pieces.sparkSession)
    rows = pieces.select("conv_id", "block", "piece", "formatted", "token_start", "token_end", "loss_mask")
    kept = ["conv_id", "block", "piece", "formatted"]
    runs = T.ArrayType(T.IntegerType())
    schema = T.StructType([*[T.StructField(n, rows.schema[n].dataType) for n in kept], T.StructField("starts", runs), T.StructField("ends", runs), T.StructField("n_tokens", T.LongType()), T.StructField("n_loss_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts, ends, n, m = [], [], [], []
            for i, text in enumerate(b.column("formatted").to_pylist()):
                start, end, loss = (b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("token_start", "token_end", "loss_mask"))
                own = list(under_mask(text, start, end, loss))
                starts.append([x for x, _ in own])
                ends.append([x for _, x in own])
                n.append(len(loss))
                m.append(int((loss > 0).sum()))
            out = [*[b.column(c) for c in kept], pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(n, pa.int64()), pa.array(m, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, schema.names)

    return rows.mapInArrow(run, schema)


def read_back(pieces: DataFrame, template: Template = LLAMA_LIKE) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens, n_loss_tokens, from formatted conversations.

    The masks become runs of characters before pieces travel. A conversation's pieces are read one after another, and no
    more than one batch is held.
    """
    rows = trained_runs(pieces).repartition("conv_id").sortWithinPartitions("conv_id", "block", "piece")
    out = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    types = [T.StringType() if n.endswith("sha256") else T.LongType() for n in out]
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *[T.StructField(n, t) for n, t in zip(out, types, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, counts, said, learned, done, kind = None, None, None, None, [], None

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), [kind, *kinds], strict=True)], ["conv_id", *out])

        def close() -> None:
            if counts is not None:
                done.append((conv, counts[0], said.hexdigest(), counts[1], learned.hexdigest(), *counts[2:]))

        for b in batches:
            kind = b.schema.field("conv_id").type
            for own, text, starts, ends, n, m in _rows([b], ["conv_id", "formatted", "starts", "ends", "n_tokens", "n_loss_tokens"]):
                if counts is None or own != conv:
                    close()
                    conv, counts, said, learned = own, [0, 0, 0, 0, 0], hashlib.sha256(), hashlib.sha256()
                for role, turn in template.parsed(text):
                    counts[0] += 1
                    said.update(f"{role}\n{turn}\n".encode())
                for a, z in zip(starts, ends, strict=True):
                    part = template.unescaped(text[a:z])
                    counts[1] += len(part)
                    learned.update(part.encode())
                counts[2] += len(text)
                counts[3] += n
                counts[4] += m
            if done:
                yield batch()
                done.clear()
        close()
        if done:
            yield batch()

    return rows.mapInArrow(run, schema)


CONTROLS_IN_TEXT = "</s>[INST] ok [/INST]"


def op12(conversations: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The contract's columns, of all conversations and one (-7) whose texts are made of control strings; rows that are already under -7 join it."""
    spark = conversations.sparkSession
    own = spark.createDataFrame([(-7, 0, "user", CONTROLS_IN_TEXT), (-7, 1, "assistant", CONTROLS_IN_TEXT)], "conv_id long, turn long, role string, text string")
    turns = conversations.select("conv_id", "turn", "role", "text").unionByName(own)
    return read_back(formatted(turns, vocabulary=vocabulary))
