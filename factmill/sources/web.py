"""Pages and paged listings from hosts, politely: URLs dealt by host, and a stream of listings' pages with offsets.

The transport is the user's: a function of a URL that gives (status, body). ``fetched`` reads a table of URLs. All of a
host's URLs go to one task, which keeps the host's delay, its robots rules and its breaker, while
hosts run side by side; a host that refuses too often fails its remaining URLs, not others'. ``listings`` makes a
streaming source of listings whose pages are numbered: an offset is the next page of each listing, so a
restart goes on where the last committed batch ended, and no page is read for two batches.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from factmill.sources.fetch import Politeness, Stopped, Transport

FETCHED = "url string, host string, status int, body string, reason string"


def _robots(transport: Transport, host: str) -> str:
    """A host's rules; none if it has none or they can't be read."""
    try:
        status, body = transport(f"https://{host}/robots.txt")
    except OSError:
        return ""
    return body if status == 200 else ""


def fetched(urls: DataFrame, transport: Transport, between: float = 1.0, limit: int = 5, robots: bool = True, wait: Callable[[float], None] = time.sleep, order: str | None = None) -> DataFrame:
    """url, host, status, body, reason for each distinct URL, in ``order`` within its host.

    reason tells why a URL wasn't read: a wrong URL, ``robots``, ``stopped`` after ``limit`` refusals in a row, or what the transport raised.
    A result is read from the transport whenever the frame is worked out: write it before it is used twice.
    """
    at = F.lower(F.try_parse_url("url", F.lit("AUTHORITY")))
    first = F.min(order) if order else F.lit(0)
    rows = urls.where("url IS NOT NULL").groupBy("url").agg(first.alias("__order")).withColumn("host", F.coalesce(at, F.lit("")))
    rows = rows.repartition("host").sortWithinPartitions("host", "__order", "url").select("url", "host")

    def told(host: str, own: Iterator[dict]) -> Iterator[tuple]:
        polite = Politeness(transport, wait=wait, between=between, limit=limit, robots={host: _robots(transport, host)} if robots and host else {})
        stopped = False
        for r in own:
            if not host:
                yield r["url"], host, None, None, "no host"
                continue
            if stopped:
                yield r["url"], host, None, None, "stopped"
                continue
            try:
                status, body = polite.get(r["url"])
                yield r["url"], host, status, body, "robots" if (status, body) == (403, "") else None
            except Stopped:
                stopped = True
                yield r["url"], host, 429, None, "stopped"
            except Exception as e:
                yield r["url"], host, None, None, f"{type(e).__name__}: {e}"[:500]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FETCHED.split(", ")]
        shape = pa.schema([(n, pa.int32() if n == "status" else pa.string()) for n in names])
        flat = (r for b in batches for r in b.to_pylist())
        for host, own in groupby(flat, key=lambda r: r["host"]):
            for row in told(host, own):
                yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], shape)

    return rows.mapInArrow(run, FETCHED)


@dataclass
class Pages(InputPartition):
    """Pages of one host's listings, in order."""

    host: str
    wanted: list[tuple[str, int]]


PAGE = "listing string, page int, status int, body string, reason string"


def listings(name: str, templates: dict[str, str], transport: Transport, count: Callable[[str], int], pages_a_batch: int = 10, first: int = 1, between: float = 1.0, limit: int = 5, wait: Callable[[float], None] = time.sleep) -> type[DataSource]:
    """A streaming source to register: rows (listing, page, status, body, reason) of listings' pages.

    ``templates`` gives each listing's URL with ``{page}`` in it; ``count`` tells how many pages a listing has now, and is asked once a
    batch. A batch takes at most ``pages_a_batch`` pages of each listing; a host's pages are one task's. A page that
    couldn't be read is a row with its reason.
    """
    from urllib.parse import urlsplit

    class Reader(DataSourceStreamReader):
        def __init__(self) -> None:
            self.last: dict[str, int] | None = None

        def initialOffset(self) -> dict:
            return {k: first for k in templates}

        def latestOffset(self) -> dict:
            known = self.last or self.initialOffset()
            ends = {k: min(first + max(count(k), 0), known.get(k, first) + pages_a_batch) for k in templates}
            self.last = {k: max(known.get(k, first), ends[k]) for k in templates}
            return dict(self.last)

        def partitions(self, start: dict, end: dict) -> list[Pages]:
            self.last = {k: max(end.get(k, first), (self.last or {}).get(k, first)) for k in templates}
            by: dict[str, list[tuple[str, int]]] = {}
            for k in sorted(templates):
                by.setdefault(urlsplit(templates[k]).netloc, []).extend((k, p) for p in range(start.get(k, first), end.get(k, first)))
            return [Pages(host, wanted) for host, wanted in sorted(by.items()) if wanted]

        def read(self, partition: Pages) -> Iterator[tuple]:
            polite = Politeness(transport, wait=wait, between=between, limit=limit)
            stopped = False
            for listing, page in partition.wanted:
                try:
                    if stopped:
                        raise Stopped(listing)
                    status, body = polite.get(templates[listing].replace("{page}", str(page)))
                    yield listing, page, status, body, None
                except Stopped:
                    stopped = True
                    yield listing, page, 429, None, "stopped"
                except Exception as e:
                    yield listing, page, None, None, f"{type(e).__name__}: {e}"[:500]

        def commit(self, end: dict) -> None:
            return None

    class Listings(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return PAGE

        def streamReader(self, schema) -> Reader:
            return Reader()

    return Listings


def offsets(text: str) -> dict[str, int]:
    """The next page of each listing, as a checkpoint tells it."""
    return json.loads(text)
