"""Nodes, selectors and texts of pages, against a tree walked in Python."""

import os
import random

import pytest

from factmill.functions import signals
from factmill.sources import pages

RELEASE = (
    "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><nav><a href='/x'>Home</a></nav>"
    "<div class='col-lg-10 wide'><div class='release-body'><p>First <b>bold</b> words<br>here<p>Second &amp; last</div></div>"
    "<div itemprop='articleBody'>By item</div><div id=main-body-container>" + "Main text. " * 40 + "</div><ul><li>one<li>two <ul><li>in</ul></ul><footer>end</footer></body></html>"
)


class Tree:
    """The element tree that the rows tell, walked top down."""

    def __init__(self, html):
        self.rows = pages.walked(html)
        self.children = {}
        for r in self.rows:
            self.children.setdefault(r[2], []).append(r[0])

    def inside(self, node):
        return [x for c in self.children.get(node, []) for x in [c, *self.inside(c)]]

    def text(self, node):
        if self.rows[node][3] in pages.HIDDEN:
            return []
        return [self.rows[node][5]] if self.rows[node][3] == "#text" else [t for c in self.children.get(node, []) for t in self.text(c)]


def test_places_tell_the_tree():
    rng = random.Random(1)
    bits = ["<div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<li>", "<ul>", "</ul>", "<br>", "<img src=x>", "text ", " ", "<td>", "<tr>", "<table>", "</table>", "<a href='q'>", "</a>", "&lt;", "<!-- c -->", "</x>", "<", "<p"]
    for _ in range(600):
        tree = Tree("".join(rng.choice(bits) for _ in range(rng.randint(0, 40))))
        for r in tree.rows:
            assert sorted(tree.inside(r[0])) == list(range(r[0] + 1, r[1]))


def test_implied_ends():
    tree = Tree(RELEASE)
    named = [(r[3], tree.text(r[0])) for r in tree.rows if r[3] in ("p", "li")]
    assert named == [("p", ["First", "bold", "words", "here"]), ("p", ["Second & last"]), ("li", ["one"]), ("li", ["two", "in"]), ("li", ["in"])]


def test_selectors(spark):
    docs = spark.createDataFrame([(1, RELEASE), (2, "<p>no body"), (3, ""), (4, None)], "page_id long, html string")
    table = pages.shown(pages.nodes(docs))
    got = lambda s: {r["page_id"]: r["text"] for r in pages.texts(table, pages.selected(table, s)).collect()}
    first = "First\nbold\nwords\nhere\nSecond & last"
    assert got(".release-body") == got(".col-lg-10 .release-body") == got("div.col-lg-10 div") == {1: first}
    assert got("[itemprop='articleBody']") == {1: "By item"} and got("#main-body-container")[1].startswith("Main text.")
    assert got(".release-body .col-lg-10") == {} and got("p") == {1: "First\nbold\nwords\nhere\n\nSecond & last", 2: "no body"}
    assert got("script") == {} and got("a[href]") == {1: "Home"}
    with pytest.raises(ValueError, match="selector"):
        pages.selected(table, "a > b")


def expected(html, url, rules):
    """Text, extractor and suspect by a walk of the tree."""
    tree = Tree(html)
    hidden = {x for r in tree.rows if r[3] in pages.HIDDEN for x in [r[0], *tree.inside(r[0])]}
    live = [r for r in tree.rows if r[0] not in hidden]
    linked = {x for r in live if r[3] == "a" for x in tree.inside(r[0])}
    offers = []
    score = {}
    for r in live:
        if r[3] in ("p", "pre", "blockquote") and r[2] >= 0:
            score[r[2]] = score.get(r[2], 0) + sum(len(tree.rows[x][5]) for x in tree.inside(r[0]) if tree.rows[x][3] == "#text" and x not in hidden and x not in linked)
    score = {k: n for k, n in score.items() if n}
    if score:
        best = min(score, key=lambda k: (-score[k], k))
        offers.append(("densest block", "\n".join(tree.text(best))))
    host = url.split("/")[2] if "//" in url else ""
    for domain, own in rules.items():
        if host == domain or host.endswith("." + domain):
            for s in own:
                if s.startswith("#"):
                    hits = [r[0] for r in live if (r[4] or {}).get("id") == s[1:]]
                elif s.startswith("["):
                    hits = [r[0] for r in live if (r[4] or {}).get("itemprop") == "articleBody"]
                else:
                    *outer, name = [p[1:] for p in s.split()]
                    is_ = lambda r, n: n in ((r[4] or {}).get("class") or "").split()
                    hits = [r[0] for r in live if is_(r, name) and all(any(is_(o, p) and r[0] in tree.inside(o[0]) for o in live) for p in outer)]
                if parts := [t for h in hits if (t := "\n".join(tree.text(h)))]:
                    offers.append((f"site:{s}", "\n\n".join(parts)))
    body = next((r[0] for r in live if r[3] == "body"), None)
    whole = "\n".join(tree.text(body)) if body is not None else "\n\n".join(t for r in live if r[2] == -1 and (t := "\n".join(tree.text(r[0]))))
    offers = [(e, t) for e, t in sorted(offers) if len(t) > 200]
    if offers:
        e, t = max(offers, key=lambda x: len(x[1]))
        return t, e, len(whole) * 0.2 > len(t)
    return whole or None, "raw_body" if whole else None, True


def test_texts_of_whole_pages(spark):
    rows = [(10_000, "https://www.prnewswire.com/a", RELEASE), (10_001, "https://ir.globenewswire.com/a", RELEASE), (10_002, "https://x.example/", None), (10_003, "https://x.example/", "<td>loose"), (10_004, "broken", RELEASE)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    if os.path.isdir("/root/testdata/sf0.001"):
        docs = docs.unionByName(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html"))
    got = {r["page_id"]: (r["text"], r["extractor"], r["suspect"]) for r in pages.page_texts(docs).collect()}
    want = {r["page_id"]: expected(r["html"], r["url"], signals.SITE_RULES) for r in docs.collect()}
    assert got == want and got[10_000][1] == "raw_body" and got[10_001][1] == "site:#main-body-container"


def test_pages_are_read_once_and_in_parts(spark):
    docs = spark.createDataFrame([(i, "https://x.example/", RELEASE) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    plan = pages.page_texts(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan  # the walk is done by then; the table that it gave is read instead
    table = pages.kept(docs)
    assert len(table.inputFiles()) == 4 and sorted(map(tuple, table.drop("attrs").collect()), key=str) == sorted(map(tuple, pages.nodes(docs).drop("attrs").collect()), key=str)
    assert pages.page_texts(docs.limit(0)).collect() == []
