"""Further queries, with their SQL beside them: vocabulary, filings, securities, sinks' orders."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from factmill.functions import scanners, vocab
from factmill.operators import ledger, relational
from factmill.plans.domain import DEALS, deals, view
from factmill.plans.oracles import SQL
from factmill.plans.queries import query

c = F.col

WORDS = """
SELECT o_orderkey AS id,
  CASE o_orderkey % 5 WHEN 0 THEN 'ANNOUNCED' WHEN 1 THEN NULL WHEN 2 THEN 'odd' ELSE NULL END AS history,
  CASE o_custkey % 5 WHEN 0 THEN 'CLOSE' WHEN 1 THEN 'AMENDMENT' WHEN 2 THEN 'CLOSED' WHEN 3 THEN 'what' ELSE NULL END AS old_history,
  CASE o_orderkey % 6 WHEN 0 THEN 'FY' WHEN 1 THEN 'TTM' WHEN 2 THEN 'QUARTER' WHEN 3 THEN 'UNKNOWN' WHEN 4 THEN 'NTM' ELSE NULL END AS period,
  CASE o_custkey % 4 WHEN 0 THEN 'ASSETS' WHEN 1 THEN 'subsidiary' WHEN 2 THEN 'BUSINESS_UNIT' ELSE NULL END AS target,
  CASE o_orderkey % 4 WHEN 0 THEN 'consortium' WHEN 1 THEN 'strategic' ELSE NULL END AS buyer,
  CASE o_orderkey % 3 WHEN 0 THEN 'SPIN_SPLIT' WHEN 1 THEN 'ACQUISITION' ELSE 'bad' END AS old_type,
  CASE WHEN o_custkey % 2 = 0 THEN 'EXCHANGE_OFFER' END AS mechanism,
  CASE o_orderkey % 4 WHEN 0 THEN 'NYSE: ABC' WHEN 1 THEN 'XYZ' WHEN 2 THEN 'OTC:Q:R' ELSE NULL END AS ticker,
  CASE o_custkey % 5 WHEN 0 THEN 'FIRST_PARTY_ANNOUNCEMENT' WHEN 1 THEN 'original_reporting' WHEN 2 THEN 'nonsense' ELSE NULL END AS character,
  CASE WHEN o_custkey % 7 = 0 THEN 'T1' END AS known_tier,
  'Item 1.01: Entry, Item ' || CAST(2 + o_orderkey % 7 AS VARCHAR(3)) || '.0' || CAST(1 + o_custkey % 3 AS VARCHAR(3)) || ': Other, Item 1.01' AS items,
  CASE o_orderkey % 6 WHEN 0 THEN 'EX-2.1' WHEN 1 THEN 'EX-21' WHEN 2 THEN 'Exhibit 99.1 Press' WHEN 3 THEN 'EX-99.2' WHEN 4 THEN '2.1 Plan' ELSE 'other' END AS label,
  o_totalprice AS price,
  'Agreement dated as of March ' || CAST(1 + o_orderkey % 28 AS VARCHAR(3)) || ', 2024 by' || CASE WHEN o_custkey % 3 = 0 THEN ' and dated as of May 1, 2023' ELSE '' END AS head
FROM orders
"""


def words(spark, sf_dir):
    return spark.sql(WORDS.replace("FROM orders", "FROM {orders}"), orders=view(spark, sf_dir, "orders"))


@query
def vocabulary_maps(spark, sf_dir):
    return words(spark, sf_dir).select(
        "id", vocab.lifecycle(c("history"), c("old_history")).alias("history"), vocab.period(c("period")).alias("period"), vocab.mapped(c("target"), vocab.TARGET_TYPES).alias("target"),
        vocab.mapped(c("buyer"), vocab.RETIRED_BUYERS).alias("buyer"), vocab.event_type(F.lit(None).cast("string"), c("old_type"), c("mechanism"), ["ACQUISITION", "MERGER"]).alias("event"),
        vocab.symbol(c("ticker")).alias("symbol"), scanners.authority_tier(c("known_tier"), c("character")).alias("tier"),
    )


SQL["vocabulary_maps"] = f"""
SELECT id, CASE WHEN history = 'ANNOUNCED' THEN history WHEN old_history IN ('CLOSE', 'CLOSED') THEN 'CLOSED' WHEN old_history = 'AMENDMENT' THEN 'AMENDED' ELSE history END AS history,
  CASE period WHEN 'FY' THEN 'ANNUAL' WHEN 'TTM' THEN 'LTM' WHEN 'QUARTER' THEN 'QUARTERLY' WHEN 'UNKNOWN' THEN NULL ELSE period END AS period,
  lower(target) AS target, CASE buyer WHEN 'consortium' THEN 'unknown' ELSE buyer END AS buyer,
  CASE old_type WHEN 'SPIN_SPLIT' THEN CASE WHEN mechanism IS NULL THEN 'SPIN_OFF' ELSE 'SPLIT_OFF' END WHEN 'ACQUISITION' THEN old_type END AS event,
  trim(string_split(ticker, ':')[-1]) AS symbol,
  coalesce(known_tier, CASE upper(character) WHEN 'FIRST_PARTY_ANNOUNCEMENT' THEN 'T2' WHEN 'ORIGINAL_REPORTING' THEN 'T3' ELSE 'T4' END) AS tier
FROM ({WORDS})
"""


@query
def filing_labels(spark, sf_dir):
    return words(spark, sf_dir).select("id", F.array_join(scanners.item_codes(c("items")), ",").alias("items"), scanners.exhibit_kind(c("label")).alias("exhibit"), scanners.dated_as_of(c("head")).cast("string").alias("dated"))


SQL["filing_labels"] = f"""
SELECT id, CASE WHEN split_part(items, 'Item ', 3)[1:4] = '1.01' THEN '1.01' ELSE '1.01,' || split_part(items, 'Item ', 3)[1:4] END AS items,
  CASE WHEN label IN ('EX-2.1', '2.1 Plan') THEN 'MERGER_AGREEMENT' WHEN label IN ('Exhibit 99.1 Press', 'EX-99.2') THEN 'PRESS_EXHIBIT' END AS exhibit,
  CASE WHEN NOT contains(head, 'May') THEN '2024-03-' || lpad(regexp_extract(head, 'March ([0-9]+)', 1), 2, '0') END AS dated
FROM ({WORDS})
"""


@query
def shown_multiples(spark, sf_dir):
    d = deals(spark, sf_dir)
    quality = F.when(c("deal_id") % 5 == 0, "NM").otherwise("CALCULATED")
    return d.select("deal_id", vocab.shown_multiple(F.when(c("deal_id") % 7 != 0, (c("deal_id") % 40) / 8), quality).alias("shown"), vocab.equal(c("value_currency"), F.lower("financials_currency"), "enum").cast("int").alias("same_currency"), vocab.equal(c("revenue"), c("revenue") * F.when(c("deal_id") % 2 == 0, 1.004).otherwise(1.02), "numeric").cast("int").alias("close"))


SQL["shown_multiples"] = f"""
SELECT deal_id, CASE WHEN deal_id % 7 = 0 THEN '' WHEN deal_id % 5 = 0 THEN 'NM' ELSE printf('%.2f', floor((deal_id % 40) / 8 * 100 + 0.5 + 1e-9) / 100) END AS shown,
  CAST(coalesce(value_currency = financials_currency, FALSE) AS INTEGER) AS same_currency, CASE WHEN revenue IS NULL OR revenue = 0 OR deal_id % 2 = 0 THEN 1 ELSE 0 END AS close
FROM ({DEALS})
"""


@query
def diluted_shares(spark, sf_dir):
    kind = F.element_at(F.array(*map(F.lit, ["COMMON_STOCK", "PREFERRED_STOCK", "RSU", "NOTE"])), (c("l_linenumber") % 4 + 1).cast("int"))
    rows = view(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("txn"), kind.alias("security_type"), c("l_linestatus").alias("security_class"), c("l_returnflag").alias("as_reported"), c("l_shipdate").cast("date").cast("string").alias("as_of")).agg(F.max("l_quantity").alias("shares"))
    return scanners.diluted_shares(rows, "txn")


SQL["diluted_shares"] = """
WITH s AS (
  SELECT l_orderkey AS txn, l_linenumber % 4 AS kind, l_linestatus, l_returnflag, CAST(l_shipdate AS DATE) AS as_of, max(l_quantity) AS shares FROM lineitem GROUP BY ALL
), latest AS (SELECT txn, kind, l_linestatus, l_returnflag, arg_max(shares, as_of) AS shares FROM s GROUP BY ALL),
t AS (SELECT txn, sum(shares) FILTER (WHERE kind < 3) AS n, bool_or(kind = 0) AS common, bool_or(kind = 2) AS options FROM latest GROUP BY txn)
SELECT txn, CASE WHEN n > 0 THEN n END AS diluted_shares, CASE WHEN common AND options THEN 'COMPLETE' WHEN common OR n > 0 THEN 'PARTIAL' ELSE 'NOT_AVAILABLE' END AS quality FROM t
"""


@query
def capped_per_type(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderdate")
    w = Window.partitionBy("o_custkey", "o_orderstatus").orderBy(c("o_orderdate").desc_nulls_last(), "o_orderkey")
    total = F.count(F.lit(1)).over(Window.partitionBy("o_custkey", "o_orderstatus"))
    return o.withColumn("position", F.row_number().over(w)).withColumn("total", total).where("position <= 3").select("o_custkey", "o_orderstatus", "o_orderkey", "position", "total")


SQL["capped_per_type"] = """
SELECT o_custkey, o_orderstatus, o_orderkey, position::INTEGER AS position, total FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS position, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS total FROM orders
) WHERE position <= 3
"""


@query
def typed_ledger_round_trip(spark, sf_dir):
    rows = view(spark, sf_dir, "orders")
    df = rows.select("o_orderkey", "o_totalprice", "o_orderstatus", (c("o_custkey") % 2 == 0).alias("flag"))
    for name, kind in (("o_totalprice", "number"), ("o_orderstatus", "string"), ("flag", "boolean")):
        t, n = ledger.encoded(c(name), kind)
        df = df.withColumn(f"{name}_text", t).withColumn(f"{name}_num", n)
    return df.select("o_orderkey", c("flag_text"), c("flag_num"), ledger.decoded(c("o_totalprice_text"), c("o_totalprice_num"), "number").alias("price"), ledger.decoded(c("o_orderstatus_text"), c("o_orderstatus_num"), "string").alias("state"), ledger.decoded(c("flag_text"), c("flag_num"), "boolean").alias("flag"))


SQL["typed_ledger_round_trip"] = """
SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN '1' ELSE '0' END AS flag_text, CASE WHEN o_custkey % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS flag_num,
  o_totalprice AS price, o_orderstatus AS state, (CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 0 END)::INTEGER AS flag FROM orders
"""


@query
def party_rows(spark, sf_dir):
    rows = view(spark, sf_dir, "orders").select("o_orderkey", F.array(F.struct(F.concat(F.lit("Buyer "), c("o_custkey") % 9).alias("name"), F.lit("strategic").alias("type")), F.struct(F.when(c("o_orderkey") % 2 == 0, F.lit("Seller")).alias("name"), F.lit(None).cast("string").alias("type"))).alias("parties"))
    return ledger.exploded(rows, ["o_orderkey"], "parties", "party.", ["name", "type"])


SQL["party_rows"] = """
SELECT o_orderkey, 'party.0' AS fact_key, 'name' AS field, 'Buyer ' || (o_custkey % 9) AS value FROM orders
UNION ALL SELECT o_orderkey, 'party.0', 'type', 'strategic' FROM orders UNION ALL SELECT o_orderkey, 'party.1', 'name', 'Seller' FROM orders WHERE o_orderkey % 2 = 0
"""


@query
def hash_order_sample(spark, sf_dir):
    d = view(spark, sf_dir, "documents").select("doc_id", "lang")
    return d.withColumn("h", F.sha2(c("doc_id").cast("string"), 256)).orderBy("h").limit(50)


SQL["hash_order_sample"] = "SELECT doc_id, lang, sha256(CAST(doc_id AS VARCHAR)) AS h FROM documents ORDER BY h LIMIT 50"


@query
def stale_fields(spark, sf_dir):
    live = view(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("id")).agg(F.max(F.when(c("l_returnflag") == "A", 1).otherwise(0)).alias("a"), F.max(F.when(c("l_linestatus") == "O", 1).otherwise(0)).alias("o"))
    rows = view(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), "o_totalprice", "o_orderstatus").join(live, "id", "left")
    return rows.select("id", F.when(c("a") == 1, c("o_totalprice")).alias("price"), F.when(c("o") == 1, c("o_orderstatus")).alias("state"))


SQL["stale_fields"] = """
WITH l AS (SELECT l_orderkey AS id, bool_or(l_returnflag = 'A') AS a, bool_or(l_linestatus = 'O') AS o FROM lineitem GROUP BY 1)
SELECT o_orderkey AS id, CASE WHEN a THEN o_totalprice END AS price, CASE WHEN o THEN o_orderstatus END AS state FROM orders LEFT JOIN l ON id = o_orderkey
"""


@query
def content_duplicates_profile(spark, sf_dir):
    d = view(spark, sf_dir, "documents")
    d = d.select("doc_id", "lang", F.sha2("text", 256).alias("hash"))
    n = d.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id")).where("n > 1")
    langs = relational.first_seen_list(d, ["hash"], c("lang"), c("doc_id"), "langs")
    return n.join(langs, "hash").select("doc_id", "n", "langs")


SQL["content_duplicates_profile"] = """
WITH h AS (SELECT sha256(text) AS hash, lang, min(doc_id) AS first_id, count(*) AS k FROM documents GROUP BY ALL)
SELECT min(first_id) AS doc_id, sum(k)::BIGINT AS n, string_agg(lang, '|' ORDER BY first_id) AS langs FROM h GROUP BY hash HAVING sum(k) > 1
"""


FILES = """
SELECT l_orderkey AS filing, ((l_partkey * 1000 + l_suppkey) * 10 + l_linenumber % 10) * 100 + CAST(l_quantity AS BIGINT) AS pos, CASE l_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE ' https://f.example/' || CAST(l_suppkey % 4 AS VARCHAR(10)) || ' ' END AS url,
  CASE l_partkey % 7 WHEN 0 THEN 'EX-2.1' WHEN 1 THEN 'EX-99.1' WHEN 2 THEN ' Exhibit 2.01 agreement' WHEN 3 THEN 'EX-21' WHEN 4 THEN '10-K' ELSE NULL END AS type, CASE l_suppkey % 3 WHEN 0 THEN 'EX-99.2 press release' WHEN 1 THEN '2.1 plan of merger' ELSE 'graphic' END AS description
FROM lineitem
"""


@query
def filing_exhibits(spark, sf_dir):
    rows = spark.sql(FILES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=view(spark, sf_dir, "lineitem"))
    files = F.transform(F.array_sort(F.collect_list(F.struct("pos", "url", "type", "description"))), lambda x: F.struct(x["url"].alias("url"), x["type"].alias("type"), x["description"].alias("description")))
    filings = rows.groupBy("filing").agg(files.alias("files"))
    shown = lambda kind: F.array_join(F.transform(scanners.exhibits(c("files"), kind), lambda x: F.concat(x["label"], F.lit("@"), x["url"])), "|")
    return filings.select("filing", shown("MERGER_AGREEMENT").alias("agreements"), shown("PRESS_EXHIBIT").alias("releases"))


SQL["filing_exhibits"] = f"""
WITH f AS (SELECT filing, pos, trim(url) AS url, trim(coalesce(type, '')) AS type, trim(coalesce(description, '')) AS description FROM ({FILES})),
k AS (SELECT *, CASE WHEN regexp_matches(type, '^(EX-2\\.1|Exhibit 2\\.01)') THEN type WHEN regexp_matches(description, '^2\\.1 ') THEN description END AS a,
             CASE WHEN regexp_matches(type, '^EX-99') THEN type WHEN regexp_matches(description, '^EX-99') THEN description END AS r FROM f WHERE url <> ''),
one AS (SELECT filing, string_agg(a || '@' || url, '|' ORDER BY pos) AS agreements FROM (SELECT *, row_number() OVER (PARTITION BY filing, url ORDER BY pos) AS n FROM k WHERE a IS NOT NULL) WHERE n = 1 GROUP BY filing),
two AS (SELECT filing, string_agg(r || '@' || url, '|' ORDER BY pos) AS releases FROM (SELECT *, row_number() OVER (PARTITION BY filing, url ORDER BY pos) AS n FROM k WHERE r IS NOT NULL) WHERE n = 1 GROUP BY filing)
SELECT filing, coalesce(agreements, '') AS agreements, coalesce(releases, '') AS releases FROM (SELECT DISTINCT filing FROM f) LEFT JOIN one USING (filing) LEFT JOIN two USING (filing)
"""
