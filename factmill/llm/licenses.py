"""License scans: an exact set-similarity join of text blocks with license templates.

A template is found in a block of text if the block holds at least ``SHARE`` of the
template's distinct words. Words are ordered by how many documents hold them, rarest first,
counted over all documents. In that order a block that qualifies must hold one of a
template's first n - ceil(SHARE * n) + 1 words (prefix filter), must have enough words
(length filter), and from the first word met on both sides must have enough words left
(positional filter); what passes is counted exactly. Every template is sought in lines, in paragraphs (lines up
to a blank one) and in runs of neighbouring lines, blank ones skipped, over the whole text.
A run may hold as many words between its first and its last line as the template has, so
notices are found however they are wrapped or spaced out.

Templates are a parameter: a list as in ``notices``, which holds public notices in full, or a table.
The counts are kept for their vocabulary alone, so its size is fixed by the templates, and so is
all that goes to the executors.

Beside the join, base phrases are sought word by word, as whole consecutive words.

Defined results: null and empty texts have no words, no labels, no places and score 0; a
text with a base phrase scores 1, any other the greatest share of a template found in one of
its blocks or runs that passes the filters, else 0; repeated rows get equal results; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factmill.llm.notices import TEMPLATES
from factmill.llm.scratch import bounded_texts

SHARE_NUM, SHARE_DEN = 4, 5

# Base phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

MOST_TEMPLATES = 10_000
"""Templates that a table may hold: they and their vocabulary go to every executor."""

_TO_WORDS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(raw: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of all other code points from U+0080 on."""
    return raw.translate(_TO_WORDS).split()


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def places(tokens: list[bytes], phrase: tuple[bytes, ...]) -> list[int]:
    """Where the phrase's words stand one after the other."""
    found, at, n = [], -1, len(phrase)
    try:
        while True:
            at = tokens.index(phrase[0], at + 1)
            if tuple(tokens[at : at + n]) == phrase:
                found.append(at)
    except ValueError:
        return found


def from_table(table: DataFrame) -> list[tuple[str, str, str]]:
    """Templates from a table of (label, text), whole notices; rows without label or words are left out.

    Each is told as a line or a paragraph by whether it has a line break or over 30 words. More
    than ``MOST_TEMPLATES`` are an error, as every executor holds them.
    """
    rows = table.where("label IS NOT NULL AND text IS NOT NULL").select("label", "text").distinct().limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    rows = sorted((r["label"], r["text"]) for r in rows if words(_raw(r["text"])))
    return [(label, "paragraph" if "\n" in text.strip() or len(words(_raw(text))) > 30 else "line", text) for label, text in rows]


def vocabulary(templates=TEMPLATES) -> list[bytes]:
    return sorted({w for _, _, text in templates for w in words(_raw(text))})


class Index:
    """The templates in frequency order, with their prefix words."""

    def __init__(self, counts: dict[bytes, int], templates=TEMPLATES):
        order = sorted(vocabulary(templates), key=lambda w: (counts.get(w, 0), w))
        self.place = {w: i for i, w in enumerate(order)}
        self.lengths, self.prefixes = [], []
        self.templates, self.prefix = [], {"line": {}, "paragraph": {}}
        for label, unit, text in templates:
            own = sorted(self.place[w] for w in set(words(_raw(text))))
            need = -(-SHARE_NUM * len(own) // SHARE_DEN)
            k = len(self.templates)
            self.templates.append((label, frozenset(own), len(own), need))
            self.lengths.append(len(words(_raw(text))))
            self.prefixes.append(frozenset(own[: len(own) - need + 1]))
            for i, w in enumerate(own[: len(own) - need + 1]):
                self.prefix[unit].setdefault(w, []).append((k, i))
        self.any_prefix = {order[w] for unit in self.prefix.values() for w in unit}

    def found(self, unit: str, tokens: list[bytes]) -> list[tuple[str, float]]:
        """Labels and shares of the templates that a block of so many tokens contains."""
        block = sorted({self.place[w] for w in tokens if w in self.place})
        met, tried = [], set()
        for j, w in enumerate(block):
            for k, i in self.prefix[unit].get(w, ()):
                label, own, n, need = self.templates[k]
                if k in tried:
                    continue
                tried.add(k)
                # this is the first word met on both sides in the common order
                if len(block) < need or 1 + min(n - i - 1, len(block) - j - 1) < need:
                    continue
                shared = len(own.intersection(block))
                if shared >= need:
                    met.append((label, shared / n))
        return met

    def found_in_runs(self, lines: list[list[bytes]]) -> list[tuple[str, float]]:
        """Labels and greatest shares of the templates that runs of these neighbouring lines contain.

        The longest run from each line is enough, as all others from there are parts of it.
        """
        held = [{self.place[w] for w in line if w in self.place} for line in lines]
        known = set().union(*held)
        before = [0, *accumulate(map(len, lines))]
        met = []
        for (label, own, n, need), prefix, length in zip(self.templates, self.prefixes, self.lengths, strict=True):
            if prefix.isdisjoint(known) or len(own & known) < need:
                continue
            marked = [(i, own & h) for i, h in enumerate(held) if not own.isdisjoint(h)]
            counts: Counter[int] = Counter()
            best = end = 0
            for first, out in marked:
                while end < len(marked) and before[marked[end][0]] - before[first + 1] <= length:
                    counts.update(marked[end][1])
                    end += 1
                best = max(best, len(counts))
                for w in out:
                    counts[w] -= 1
                    if not counts[w]:
                        del counts[w]
            if best >= need:
                met.append((label, best / n))
        return met


def blocks(raw: bytes) -> Iterator[tuple[str, list[bytes]]]:
    """All lines, and all paragraphs of the text, as words."""
    paragraph: list[bytes] = []
    for line in raw.split(b"\n"):
        own = words(line)
        if own:
            yield "line", own
        if line.strip():
            paragraph += own
        elif paragraph:
            yield "paragraph", paragraph
            paragraph = []
    if paragraph:
        yield "paragraph", paragraph


def document_counts(docs: DataFrame, vocab: list[bytes]) -> dict[bytes, int]:
    """In how many documents each vocabulary word occurs: a table of the vocabulary's size."""
    known = set(vocab)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                total.update(known.intersection(words(_raw(text))))
        yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    rows = docs.select("text").mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["word"]): r["n"] for r in rows}


_SCAN = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``docs`` with a struct column ``scan``; ``templates`` as in ``notices`` or a table of (label, text)."""
    if isinstance(templates, DataFrame):
        templates = from_table(templates)
    bounded_texts(docs.sparkSession)
    index = Index(document_counts(docs, vocabulary(templates)), templates)
    phrases = [(tuple(p.encode().split()), label) for p, label in PHRASES.items()]

    def one(text: str | None) -> tuple:
        raw = _raw(text)
        tokens = words(raw)
        base = [(at, label) for phrase, label in phrases for at in places(tokens, phrase)]
        labels = {label for _, label in base}
        joined = []
        if not index.any_prefix.isdisjoint(tokens):
            made = list(blocks(raw))
            joined = [x for _, own in made for unit in index.prefix for x in index.found(unit, own)]
            joined += index.found_in_runs([own for unit, own in made if unit == "line"])
        starts = [at for at, _ in base]
        return (
            len(tokens), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {label for label, _ in joined})), 1.0 if base else max((s for _, s in joined), default=0.0),
        )

    @F.pandas_udf(_SCAN)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            made = pd.DataFrame([one(t) for t in texts], columns=[c.split()[0] for c in _SCAN.split(", ")])
            for c in ("n_words", "n_base", "first_word", "last_word"):
                made[c] = made[c].astype("Int64")
            yield made

    return docs.withColumn("scan", scanned("text"))


def op7(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return scan(docs.select("doc_id", "text")).select("doc_id", "scan.*")
