"""Readers of the ingest formats. Each gives a DataFrame; nothing is fetched from the network."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factmill.functions.text import content_hash, html_title
from factmill.functions.vocab import symbol
from factmill.operators.relational import first_by

INVESTOR_FIRST = ["invests_into"]
MIN_BODY = 100


def _blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """CSV of URLs: headers in any case, a BOM dropped, blanks null, rows without URL dropped."""
    raw = spark.read.option("header", True).option("multiLine", True).csv(path)
    by_name = {c.lstrip("﻿").strip().lower(): c for c in raw.columns}
    pick = lambda *names: F.coalesce(*[_blank(F.col(f"`{by_name[n]}`")) for n in names if n in by_name], F.lit(None).cast("string"))
    rows = raw.select(pick("url").alias("url"), pick("source").alias("source"), pick("target").alias("target"), pick("acquirer").alias("acquirer"), pick("headline", "title").alias("title"), pick("story date", "published_date").alias("published_date"))
    return rows.where(F.col("url").isNotNull())


def ingested(new: DataFrame, known: DataFrame) -> DataFrame:
    """New sources by URL, then by content; the body of a repeated text is null, with the reason."""
    fresh = first_by(new.join(known.select("url"), "url", "left_anti"), ["url"], ["seq"]).withColumn("content_hash", content_hash(F.col("body")))
    nth = first_by(fresh.where(F.col("content_hash").isNotNull()), ["content_hash"], ["seq"]).select("url").withColumn("__first", F.lit(True))
    rows = fresh.join(nth, "url", "left").join(known.select("content_hash", F.lit(True).alias("__known")).distinct(), "content_hash", "left")
    dupe = F.col("content_hash").isNotNull() & (F.col("__known").isNotNull() | F.col("__first").isNull())
    return rows.select("url", "seq", "content_hash", F.when(~dupe, F.col("body")).alias("body"), F.when(dupe, "duplicate_body").alias("reason"))


def event_feed(spark: SparkSession, path: str) -> DataFrame:
    """TSV event feed: short bodies and rows without URL dropped, the first of each URL and body kept, roles by category."""
    raw = spark.read.option("header", True).option("sep", "\t").csv(path).withColumn("__seq", F.monotonically_increasing_id())
    swap = F.col("category").isin(INVESTOR_FIRST)
    rows = raw.where(_blank(F.col("source_url")).isNotNull() & (F.length(F.trim("source_body_lite")) >= MIN_BODY))
    rows = first_by(rows.withColumn("__url", F.trim("source_url")), ["__url"], ["__seq"])
    rows = first_by(rows.withColumn("__hash", content_hash(F.col("source_body_lite"))), ["__hash"], ["__seq"])
    return rows.select(
        "id", "category", F.trim("source_url").alias("url"), F.col("source_title").alias("title"), F.col("source_body_lite").alias("body"),
        F.when(swap, F.trim("company2_name")).otherwise(F.trim("company1_name")).alias("recipient"), F.when(swap, F.trim("company1_name")).otherwise(F.trim("company2_name")).alias("investor"),
        F.substring("source_published_at", 1, 10).alias("published_date"),
    )


def chosen(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of an ordered id list (id, position), and the ids that aren't there."""
    return ids.join(rows, "id").orderBy("position"), ids.join(rows.select("id"), "id", "left_anti")


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows that parse, and the lines that don't; blank lines are skipped."""
    text = spark.read.text(path).where(F.trim("value") != "")
    parsed = text.withColumn("row", F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    return parsed.where("row._bad IS NULL").select("row.*").drop("_bad"), parsed.where("row._bad IS NOT NULL").select("value")


def captures(spark: SparkSession, root: str) -> DataFrame:
    """Page captures (meta.json, page.txt, page.html in a folder each) with the reasons of unhealthy ones."""
    files = spark.read.option("recursiveFileLookup", True).option("wholetext", True).text(root).select("value", F.col("_metadata.file_path").alias("path"))
    files = files.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("capture"), F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "value")
    got = files.groupBy("capture").agg(*[F.max(F.when(F.col("file") == f, F.col("value"))).alias(a) for f, a in (("meta.json", "meta"), ("page.txt", "body"), ("page.html", "html"))])
    meta = F.from_json("meta", "url string, ok boolean, suspect boolean, blocked boolean, block_reason string, via string, title string, published string")
    reason = F.concat_ws(",", F.when(F.col("m").isNull() | F.col("m.url").isNull(), "no_meta"), F.when(~F.coalesce("m.ok", F.lit(False)), "not_ok"), F.when(F.col("m.blocked"), F.concat(F.lit("blocked:"), F.coalesce("m.block_reason", F.lit("")))), F.when(F.col("m.suspect"), "suspect"), F.when(F.coalesce(F.length(F.trim("body")), F.lit(0)) < MIN_BODY, "short_body"))
    return got.withColumn("m", meta).select("capture", "m.url", F.coalesce("m.title", html_title(F.col("html"))).alias("title"), "m.published", "body", F.nullif(reason, F.lit("")).alias("quarantined"))


def _sheet(raw: bytes) -> list[list[str]]:
    book = zipfile.ZipFile(io.BytesIO(raw))
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    names = book.namelist()
    shared = ["".join(t.text or "" for t in s.iter(f"{ns}t")) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
    rows = []
    for row in ElementTree.fromstring(book.read(min(n for n in names if n.startswith("xl/worksheets/sheet")))).iter(f"{ns}row"):
        cells: dict[int, str] = {}
        for k, cell in enumerate(row.iter(f"{ns}c")):
            col = 0
            for ch in re.sub("[^A-Z]", "", cell.get("r", "")):
                col = col * 26 + ord(ch) - 64
            value = cell.find(f"{ns}v")
            text = "".join(t.text or "" for t in cell.iter(f"{ns}t")) if cell.get("t") == "inlineStr" else value.text if value is not None else ""
            cells[col - 1 if col else k] = shared[int(text)] if cell.get("t") == "s" and text else text or ""
        rows.append([cells.get(i, "") for i in range(max(cells, default=-1) + 1)])
    return rows


def sheet_urls(rows: list[list[str]]) -> list[str]:
    """The URL column: one whose header says so, else the one that is mostly http values."""
    if not rows:
        return []
    width = max(map(len, rows))
    column = lambda i, own: [r[i].strip() if i < len(r) else "" for r in own]
    for i, head in enumerate(rows[0]):
        if head.strip().lower() in ("url", "link", "source url", "source_url"):
            return [v for v in column(i, rows[1:]) if v]
    for i in range(width):
        values = [v for v in column(i, rows) if v]
        if values and sum(v.startswith("http") for v in values) * 2 > len(values):
            return [v for v in values if v.startswith("http")]
    return []


def workbooks(spark: SparkSession, path: str) -> DataFrame:
    """path, position, url of the first sheet of each workbook."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(p, i, u) for p, raw in zip(batch["path"], batch["content"], strict=True) for i, u in enumerate(sheet_urls(_sheet(raw)))], columns=["path", "position", "url"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, position int, url string")


def listing(pages: DataFrame, html: str = "html") -> DataFrame:
    """(title, url, day) of the cards of listing pages: an anchor with its heading and small date."""
    card = F.explode(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<a\s[^>]*href=.*?</a>"), F.lit(0)))
    rows = pages.select(card.alias("card"))
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))
    stamp = plain(F.regexp_extract("card", r"(?is)<small[^>]*>(.*?)</small>", 1))
    day = F.coalesce(*[F.try_to_date(F.regexp_extract(stamp, r"([A-Za-z]{3,9} [0-9]{1,2}, [0-9]{4})", 1), f) for f in ("MMM dd, yyyy", "MMM d, yyyy", "MMMM d, yyyy")], F.try_to_date(F.substring(stamp, 1, 10), "yyyy-MM-dd"))
    title = plain(F.regexp_replace(F.col("card"), r"(?is)<small[^>]*>.*?</small>", " "))
    return rows.select(title.alias("title"), F.regexp_extract("card", "href=[\"']([^\"']+)", 1).alias("url"), day.alias("day")).where("title <> '' AND url <> ''")


# Days that a filing may lie before and after a deal's day, and further ahead for some forms.
BEFORE, AFTER, FORM_AFTER = 30, 7, 180
FILINGS = 10


def filings_near(deals: DataFrame, filings: DataFrame, forms: list[str] | None = None) -> DataFrame:
    """Filings that may tell of a deal: by ticker if the deal has one, else by company name, near its day.

    ``deals`` has deal, ticker, company and day; ``filings`` has filing, ticker, company, form and filed. Days
    are cut into buckets as wide as the window, so that key and bucket are an equi-join and a company
    of many filings is spread by time. Each deal's latest ten count.
    """
    after = AFTER if forms is None else FORM_AFTER
    width = BEFORE + after
    bucket = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01")) / width).cast("long")
    own = symbol(F.upper("ticker"))
    rows = deals.withColumn("__key", F.when(F.coalesce(own, F.lit("")) != "", F.concat(F.lit("t:"), own)).otherwise(F.concat(F.lit("c:"), F.col("company"))))
    rows = rows.withColumn("__b", F.explode(F.sequence(bucket(F.date_sub("day", BEFORE)), bucket(F.date_add("day", after)))))
    kept = filings if forms is None else filings.where(F.col("form").isin(forms))
    keyed = kept.select("filing", "form", "filed", F.explode(F.array(F.concat(F.lit("t:"), F.upper("ticker")), F.concat(F.lit("c:"), F.col("company")))).alias("__key")).where("__key IS NOT NULL").withColumn("__b", bucket(F.col("filed")))
    met = rows.join(keyed, ["__key", "__b"]).where(F.col("filed").between(F.date_sub("day", BEFORE), F.date_add("day", after)))
    nth = F.row_number().over(Window.partitionBy("deal").orderBy(F.desc("filed"), "filing"))
    return met.withColumn("position", nth).where(F.col("position") <= FILINGS).select("deal", "position", "filing", "form", "filed")


def filed_documents(spark: SparkSession, path: str, least: int = MIN_BODY, extractors: dict[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """path, kind, status (FETCHED, SKIP, UNREADABLE), body of documents in a folder.

    HTML and text are read natively; other kinds need an extractor by extension, given by the
    user, and are UNREADABLE without one or if it fails. Texts shorter than ``least`` are skipped.
    """
    raw = spark.read.format("binaryFile").load(path).select("path", F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("kind"), "content")
    text = F.decode("content", "UTF-8")
    shown = F.regexp_replace(F.regexp_replace(text, r"(?is)<(script|style)[^>]*>.*?</\1>", " "), "(?s)<[^>]+>", " ")
    body = F.when(F.col("kind").isin("htm", "html"), F.trim(F.regexp_replace(shown, r"[ \t\x0B\f\r]+", " "))).when(F.col("kind").isin("txt", "text", ""), text)
    if extractors:
        @F.pandas_udf("string")
        def extracted(kinds: pd.Series, contents: pd.Series) -> pd.Series:
            def one(kind: str, content: bytes) -> str | None:
                try:
                    return extractors[kind](bytes(content)) if kind in extractors else None
                except Exception:
                    return None

            return pd.Series([one(k, x) for k, x in zip(kinds, contents, strict=True)])

        body = F.coalesce(body, extracted("kind", "content"))
    rows = raw.withColumn("body", body)
    status = F.when(F.col("body").isNull(), "UNREADABLE").when(F.length(F.trim("body")) < least, "SKIP").otherwise("FETCHED")
    return rows.select("path", "kind", status.alias("status"), F.when(status == "FETCHED", F.col("body")).alias("body"))
