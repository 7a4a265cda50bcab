"""Chat formatting: exact round trips, masks, pieces and odd rows."""

import hashlib
import os
import random

import numpy as np
import pytest

from factmill.llm import chat

if not os.path.isfile(chat.VOCABULARY):
    pytest.skip("no vocabulary files", allow_module_level=True)

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = ["<", "s>", "</s>", "\\", "[", "INST]", "[/INST]", "[INST]", "/INST]", "a", " ", "é", "\n", "😀", "<\\", "[TEXT]", "[ROLE]", "<|endoftext|>", "[/TEXT]", "[SYS]"]


def sample(rng, n=12):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, n)))


def test_escapes_are_undone_and_leave_no_control_string():
    rng, t = random.Random(1), chat.LLAMA_LIKE
    for _ in range(5000):
        text = sample(rng)
        out = t.escaped(text)
        assert t.unescaped(out) == text and not any(c in out for c in t.controls)


def test_turns_and_loss_text_come_back():
    rng, t = random.Random(2), chat.LLAMA_LIKE
    for _ in range(1500):
        turns = [(rng.choice(["user", "assistant", "system", "tool", "", "x[TEXT]"]), sample(rng)) for _ in range(rng.randint(0, 6))]
        text, spans = t.rendered(turns)
        assert list(t.parsed(text)) == turns
        e = chat.encoded(text, spans)
        assert "".join(t.unescaped(text[a:b]) for a, b in chat.under_mask(text, e.start, e.end, e.loss)) == "".join(x for r, x in turns if r == "assistant")
        brute = [int(any(l and s < b and a < z for s, z, l in spans)) for a, b in zip(e.start, e.end, strict=True)]  # noqa: E741
        assert e.loss.tolist() == brute


def test_pieces_have_the_tokens_of_the_whole():
    rng, t = random.Random(3), chat.LLAMA_LIKE
    turns = [(rng.choice(["user", "assistant"]), sample(rng)) for _ in range(60)]
    whole = chat.encoded(*t.rendered(turns)).ids
    parts = [chat.encoded(*t.rendered(p)).ids for _, _, _, p in chat._pieces(((1, 0, r, x) for r, x in turns), 50)]
    assert len(parts) > 3 and np.concatenate(parts).tolist() == whole.tolist()


def test_a_template_must_be_reversible():
    for bad in ("[", "a\\b", "[[x", "[TEXT]"):
        with pytest.raises(ValueError, match="control"):
            chat.Template(role=bad)


def told(rows):
    by, out = {}, []
    for c, turn, role, text in [*rows, (-7, 0, "user", chat.CONTROLS_IN_TEXT), (-7, 1, "assistant", chat.CONTROLS_IN_TEXT)]:
        by.setdefault(c, []).append((turn, role or "", text or ""))
    for c, said in by.items():
        said.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        loss = "".join(x for _, r, x in said if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in said).encode()).hexdigest()
        text, _ = chat.LLAMA_LIKE.rendered([(r, x) for _, r, x in said])
        out.append((c, len(said), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i % 40, i // 40, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice([None, sample(rng, 30)])) for i in range(400)]
    rows += [(None, 1, "user", "x"), (None, None, "assistant", "y"), (100, 1, "assistant", "b"), (100, 1, "assistant", "a"), (100, 1, "assistant", "a"), (101, 0, "assistant", "long </s> " * 30000)]
    rows += [(-7, 3, "user", "more"), (102, -5, "user", "first"), (102, 5, "assistant", "second")]
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "2 AS piece", "3 AS formatted", "4 AS n_turns")
    assert sorted((tuple(r) for r in chat.op12(turns).select(*COLUMNS).collect()), key=str) == told(rows)
    assert [r["conv_id"] for r in chat.op12(turns.limit(0)).collect()] == [-7]


def test_a_huge_conversation_is_cut_and_read_as_one(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(1, i, "assistant" if i % 2 else "user", sample(rng, 20)) for i in range(5000)] + [(2, 0, "assistant", "short")]
    turns = spark.createDataFrame(rows, SCHEMA)
    pieces = chat.formatted(turns, chars=2000)
    by = {r["conv_id"]: r["n"] for r in pieces.groupBy("conv_id").agg({"piece": "count"}).withColumnRenamed("count(piece)", "n").collect()}
    assert by[1] > 5000 // chat.TURNS and by[2] == 1
    got = [tuple(r) for r in chat.read_back(pieces).select(*COLUMNS).collect()]
    assert sorted(got, key=str) == [r for r in told(rows) if r[0] != -7]
