"""Texts of web pages: a table of nodes, selectors on it, and the densest block where no selector finds anything.

``nodes`` reads each page once and gives a row per element and text, with its place and the place where its
contents end, so that "inside" is a comparison of numbers: the rest are joins and aggregates on the page's id. Nothing
is cut off; a page that never closes its elements is read as far as it goes. ``kept`` writes the table, so that what asks
it several times doesn't read the pages as often, and deals pages first, as a file of few parts would be few tasks'.

An element that has no contents (br, img, ...) closes at once; p, li, dt, dd, tr, td, th and option close where the next such
element or an outer block begins; an end tag closes everything inside its element and is ignored without one.
script, style, noscript, svg and template are no text. Null and empty pages have no nodes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factmill.functions import signals
from factmill.operators.shared import dealt, written

# HTML's elements without contents, those whose contents aren't shown, and what ends an open paragraph.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HIDDEN = {"script", "style", "noscript", "svg", "template"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
    "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul",
}
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}}
KEEPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "p": {"td", "th", "button", "table"}}
"""What an open element isn't closed across."""


class _Walker(HTMLParser):
    """Rows [node, end, parent, tag, attributes, text] of one page, in order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[int] = []

    def _add(self, tag: str, attrs: dict | None, text: str | None) -> int:
        node = len(self.rows)
        self.rows.append([node, node + 1, self.open[-1] if self.open else -1, tag, attrs, text])
        return node

    def _close(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.rows[node][1] = len(self.rows)
        del self.open[depth:]

    def handle_starttag(self, tag, attrs) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            own = self.rows[self.open[depth]][3]
            if tag in CLOSED_BY.get(own, ()):
                self._close(depth)
                break
            if any(own in KEEPS[e] for e in CLOSED_BY if tag in CLOSED_BY[e]):
                break
        node = self._add(tag, {k: v or "" for k, v in reversed(attrs)}, None)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[depth]][3] == tag:
                self._close(depth)
                return

    def handle_data(self, data) -> None:
        if text := data.strip():
            self._add("#text", None, text)


def walked(html: str | None) -> list[list]:
    walker = _Walker()
    walker.feed(html or "")
    walker.close()
    walker._close(0)
    return walker.rows


_NODE = [
    T.StructField("node", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("parent", T.IntegerType()),
    T.StructField("tag", T.StringType()), T.StructField("attrs", T.MapType(T.StringType(), T.StringType())), T.StructField("text", T.StringType()),
]


def nodes(pages: DataFrame, id_column: str = "page_id", html: str = "html") -> DataFrame:
    """id, node, end (of its contents, exclusive), parent (-1 for none), tag (#text for text), attrs, text."""
    schema = T.StructType([pages.schema[id_column], *_NODE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]
        for b in batches:
            for key, page in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                rows = walked(page)
                if rows:
                    columns = list(zip(*rows, strict=True))
                    columns[4] = [None if a is None else list(a.items()) for a in columns[4]]
                    own = pa.array([key.as_py()] * len(rows), b.schema.field(0).type)
                    yield pa.RecordBatch.from_arrays([own, *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], schema.names)

    return pages.select(id_column, html).mapInArrow(run, schema)


def kept(pages: DataFrame, id_column: str = "page_id", html: str = "html") -> DataFrame:
    """``nodes``, written to the shared folder and read again."""
    return written(nodes(dealt(pages.select(id_column, html), id_column), id_column, html), "nodes")


def shown(table: DataFrame, id_column: str = "page_id") -> DataFrame:
    """The nodes that aren't inside what isn't shown; few are inside, so each page's hidden places are one short list."""
    hidden = table.where(F.col("tag").isin(*HIDDEN)).groupBy(id_column).agg(F.collect_list(F.struct("node", "end")).alias("__h"))
    rows = table.join(hidden, id_column, "left")
    inside = F.exists(F.coalesce("__h", F.array().cast("array<struct<node:int,end:int>>")), lambda h: (F.col("node") >= h["node"]) & (F.col("node") < h["end"]))
    return rows.where(~inside).drop("__h")


def _compound(part: str) -> Column:
    """Whether a node is what a selector without spaces says: a tag, .class, #id and [attribute='value'], together."""
    rest, rules = part, []
    if m := re.match(r"[A-Za-z][A-Za-z0-9-]*|\*", rest):
        rest = rest[m.end() :]
        rules += [] if m[0] == "*" else [F.col("tag") == m[0].lower()]
    while rest:
        if m := re.match(r"\.([\w-]+)", rest):
            rules.append(F.array_contains(F.split(F.coalesce(F.col("attrs")["class"], F.lit("")), r"\s+"), m[1]))
        elif m := re.match(r"#([\w-]+)", rest):
            rules.append(F.col("attrs")["id"] == m[1])
        elif m := re.match(r"\[([\w-]+)(?:=(?:'([^']*)'|\"([^\"]*)\"|([\w-]+)))?\]", rest):
            value = next((v for v in m.groups()[1:] if v is not None), None)
            own = F.col("attrs")[m[1].lower()]
            rules.append(own.isNotNull() if value is None else own == value)
        else:
            raise ValueError(f"not a selector: {part}")
        rest = rest[m.end() :]
    return reduce(lambda a, b: a & b, [F.coalesce(r, F.lit(False)) for r in rules], F.col("tag") != "#text")


def selected(table: DataFrame, selector: str, id_column: str = "page_id") -> DataFrame:
    """id, node, end of the elements that a selector names: compounds, parted by spaces for "inside"."""
    found = None
    for part in selector.split():
        own = table.where(_compound(part)).select(id_column, "node", "end")
        if found is not None:
            outer = found.select(F.col(id_column).alias("__id"), F.col("node").alias("__from"), F.col("end").alias("__to"))
            own = own.join(outer, (F.col(id_column) == F.col("__id")) & (F.col("node") > F.col("__from")) & (F.col("node") < F.col("__to")), "left_semi")
        found = own
    if found is None:
        raise ValueError("an empty selector")
    return found


def texts(table: DataFrame, elements: DataFrame, id_column: str = "page_id", into: str = "text") -> DataFrame:
    """id, ``into``: the texts inside the elements, line by line; elements are parted by a blank line."""
    own = elements.select(F.col(id_column).alias("__id"), F.col("node").alias("__from"), F.col("end").alias("__to"))
    inside = table.where("tag = '#text'").join(own, (F.col(id_column) == F.col("__id")) & (F.col("node") >= F.col("__from")) & (F.col("node") < F.col("__to")))
    each = inside.groupBy(id_column, "__from").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "text"))), lambda x: x["text"]), "\n").alias("t"))
    return each.groupBy(id_column).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__from", "t"))), lambda x: x["t"]), "\n\n").alias(into))


def densest(table: DataFrame, id_column: str = "page_id") -> DataFrame:
    """id, node, end of each page's element whose own paragraphs hold most text outside links; the first of equals."""
    links = table.where("tag = 'a'").select(F.col(id_column).alias("__id"), F.col("node").alias("__from"), F.col("end").alias("__to"))
    words = table.where("tag = '#text'").select(id_column, "node", F.length("text").alias("n"))
    plain = words.join(links, (F.col(id_column) == F.col("__id")) & (F.col("node") > F.col("__from")) & (F.col("node") < F.col("__to")), "left_anti")
    paragraphs = table.where(F.col("tag").isin("p", "pre", "blockquote")).select(F.col(id_column).alias("__id"), F.col("node").alias("__from"), F.col("end").alias("__to"), "parent")
    held = plain.join(paragraphs, (F.col(id_column) == F.col("__id")) & (F.col("node") > F.col("__from")) & (F.col("node") < F.col("__to"))).groupBy(id_column, "parent").agg(F.sum("n").alias("n"))
    best = held.where("parent >= 0").groupBy(id_column).agg(F.max(F.struct("n", (-F.col("parent")).alias("at"))).alias("b")).select(F.col(id_column).alias("__id"), (-F.col("b.at")).alias("__node"))
    return table.join(best, (F.col(id_column) == F.col("__id")) & (F.col("node") == F.col("__node"))).select(id_column, "node", "end")


def page_texts(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """id, text, extractor, suspect, of every page: the longest of what its site's selectors and the densest block give; see ``signals.best_text``.

    Without either, or under a fifth of the whole page's text, the text is suspect.
    """
    table = shown(kept(pages, id_column, html), id_column)
    sites = pages.select(id_column, F.explode(signals.site_rules(F.col(url))).alias("selector"))
    wanted = sorted({s for rules in signals.SITE_RULES.values() for s in rules})
    found = texts(table, densest(table, id_column), id_column).select(id_column, F.lit("densest block").alias("extractor"), "text")
    for selector in wanted:
        of_site = table.join(sites.where(F.col("selector") == selector).select(id_column), id_column, "left_semi")
        found = found.unionByName(texts(of_site, selected(of_site, selector, id_column), id_column).select(id_column, F.lit(f"site:{selector}").alias("extractor"), "text"))
    offered = found.groupBy(id_column).agg(F.array_sort(F.collect_list(F.struct("extractor", "text"))).alias("candidates"))
    body = table.where("tag = 'body'").groupBy(id_column).agg(F.min(F.struct("node", "end")).alias("b")).select(id_column, "b.*")
    rootless = table.where("parent = -1").join(body.select(id_column), id_column, "left_anti").select(id_column, "node", "end")
    whole = texts(table, body, id_column, "whole").unionByName(texts(table, rootless, id_column, "whole"))
    none = F.array().cast("array<struct<extractor:string,text:string>>")
    rows = pages.select(id_column).join(offered, id_column, "left").join(whole, id_column, "left")
    best = signals.best_text(F.coalesce("candidates", none), F.col("whole"))
    return rows.select(id_column, best.alias("best")).select(id_column, "best.text", "best.extractor", "best.suspect")
