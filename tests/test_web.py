"""Fetching by host and streams of listings, with a transport that writes down what it is asked."""

import json
import os
import time

import pytest

from factmill.sources import web


@pytest.fixture
def asked(tmp_path):
    """A transport that logs (url, time) to a file per host, and the reader of these logs."""
    root = str(tmp_path / "log")
    os.makedirs(root)

    def transport(url):
        host = url.split("/")[2]
        with open(f"{root}/{host}", "a") as out:
            out.write(json.dumps([url, time.time()]) + "\n")
        if url.endswith("robots.txt"):
            return (200, "User-agent: *\nDisallow: /private\n") if host == "b.example" else (404, "")
        if host == "busy.example":
            return 429, ""
        if host == "broken.example":
            raise ValueError("no route")
        return 200, f"<p>{url}</p>"

    def log(host):
        path = f"{root}/{host}"
        return [json.loads(x) for x in open(path)] if os.path.exists(path) else []

    return transport, log


def test_each_host_keeps_its_delay_and_breaker(spark, asked):
    transport, log = asked
    urls = [f"https://a.example/{i}" for i in range(6)] + ["https://b.example/x", "https://b.example/private/y", "https://b.example/z"]
    urls += [f"https://busy.example/{i}" for i in range(6)] + ["https://broken.example/1", "no url", None, "https://a.example/0"]
    pause = 0.15
    wait = lambda s: time.sleep(min(s, 0.15))
    rows = web.fetched(spark.createDataFrame([(u,) for u in urls], "url string"), transport, between=pause, limit=3, wait=wait).collect()
    got = {r["url"]: r for r in rows}
    assert len(rows) == len(got) == len({u for u in urls if u})
    assert all(got[f"https://a.example/{i}"]["body"] == f"<p>https://a.example/{i}</p>" for i in range(6))
    assert got["https://b.example/private/y"]["reason"] == "robots" and got["https://b.example/z"]["status"] == 200
    assert got["https://broken.example/1"]["reason"] == "ValueError: no route" and got["no url"]["reason"] == "no host"
    busy = [r for r in rows if r["host"] == "busy.example"]
    assert {r["reason"] for r in busy if r["reason"]} == {"stopped"} and len(log("busy.example")) - 1 == 3  # and its rules
    times = [t for u, t in log("a.example") if "robots" not in u]
    assert len(times) == 6 and all(b - a >= pause * 0.9 for a, b in zip(times, times[1:], strict=False))


def test_listings_resume_and_give_no_page_twice(spark, asked, tmp_path):
    transport, log = asked
    templates = {"news": "https://a.example/news?page={page}", "deals": "https://a.example/deals?page={page}", "other": "https://c.example/p/{page}"}
    have = str(tmp_path / "have.json")

    def published(**counts):
        with open(have, "w") as out:
            json.dump(counts, out)

    def count(listing):
        return json.load(open(have)).get(listing, 0)

    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    wait = lambda s: None

    def run():
        spark.dataSource.register(web.listings("paged", templates, transport, count, pages_a_batch=2, wait=wait))
        query = spark.readStream.format("paged").load().writeStream.format("parquet").option("path", out).option("checkpointLocation", check).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
            query.awaitTermination()
        return sorted((r["listing"], r["page"]) for r in spark.read.parquet(out).collect())

    published(news=3, deals=1)
    first = [("deals", 1), ("news", 1), ("news", 2), ("news", 3)]
    assert run() == first
    published(news=4, deals=1, other=5)
    assert run() == sorted([*first, ("news", 4), *[("other", p) for p in range(1, 6)]])
    assert run() == sorted([*first, ("news", 4), *[("other", p) for p in range(1, 6)]])
    pages = [u for h in ("a.example", "c.example") for u, _ in log(h)]
    assert len(pages) == len(set(pages)) == 10
    last = max((f for f in os.listdir(f"{check}/offsets") if f.isdigit()), key=int)
    assert web.offsets(open(f"{check}/offsets/{last}").read().splitlines()[-1]) == {"news": 5, "deals": 2, "other": 6}
