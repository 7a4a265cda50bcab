"""Queries over what grows and what comes from outside: states kept up to date, streams, committed tables, resolvers that fail, pages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.operators import cluster, ledger
from factmill.operators.incremental import Resolution
from factmill.operators.shared import dealt, shared_root
from factmill.plans.domain import view
from factmill.plans.oracles import SQL, _resolve
from factmill.plans.queries import query
from factmill.sources import pages, versions
from factmill.streaming import resolution

c = F.col

NUMBERED = """
SELECT l_orderkey AS txn, l_orderkey * 100000000000 + ((l_partkey * 1000 + l_suppkey) * 10 + l_linenumber % 10) * 100 + CAST(l_quantity AS BIGINT) AS id, CASE l_returnflag WHEN 'A' THEN 'T1' WHEN 'N' THEN 'T2' ELSE 'T3' END AS tier,
  CASE WHEN l_linestatus = 'F' THEN 'HIGH' WHEN l_partkey % 3 = 0 THEN 'LOW' ELSE NULL END AS confidence, ((l_partkey * 1000 + l_suppkey) * 10 + l_linenumber % 10) * 100 + CAST(l_quantity AS BIGINT) AS seq, l_shipdate AS at, l_discount AS value
FROM lineitem
"""


def _numbered(spark: SparkSession, sf_dir: str, whole: bool = True) -> DataFrame:
    rows = spark.sql(NUMBERED.replace("FROM lineitem", "FROM {lineitem}"), lineitem=view(spark, sf_dir, "lineitem"))
    return dealt(rows, "txn").distinct() if whole else rows


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/factmill/{name}-{uuid.uuid4().hex}"


@query
def resolve_incremental(spark, sf_dir):
    """Three batches of claims, the second with all of the first again and two thirds of the retractions, which the last claims follow."""
    rows = _numbered(spark, sf_dir, whole=False)  # each batch drops claims that come twice
    kept = Resolution(spark, _folder(spark, "resolution"), ["txn"], buckets=8)
    part, gone = F.pmod(F.xxhash64("id"), F.lit(3)), rows.where("id % 17 = 0").select("txn", "id")
    kept.apply(rows.where(part == 0))
    kept.apply(rows.where(part <= 1), gone.where("id % 3 <> 0"))
    kept.apply(rows.where(part == 2), gone)
    return kept.resolved().select("txn", "value", "flagged", "n_seen")


@query
def resolve_stream(spark, sf_dir):
    """The table as a stream, by a state for each key; no claim is late, as the watermark spans the table."""
    # a stream reads folders: a table of one file is found by its name
    stream = spark.readStream.schema(view(spark, sf_dir, "lineitem").schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
    # the columns of NUMBERED; a stream can't be bound to a view of a statement
    told = ((c("l_partkey") * 1000 + c("l_suppkey")) * 10 + c("l_linenumber") % 10) * 100 + c("l_quantity").cast("long")
    rows = stream.select(
        c("l_orderkey").alias("txn"), (c("l_orderkey") * 100_000_000_000 + told).alias("id"), F.when(c("l_returnflag") == "A", "T1").when(c("l_returnflag") == "N", "T2").otherwise("T3").alias("tier"),
        F.when(c("l_linestatus") == "F", "HIGH").when(c("l_partkey") % 3 == 0, "LOW").alias("confidence"), told.alias("seq"), c("l_shipdate").cast("timestamp").alias("at"), c("l_discount").alias("value"),
    )
    folder = _folder(spark, "stream")
    resolution.written(resolution.resolved_stream(rows, ["txn"], late="20000 days", ttl_seconds=25_000 * 86_400), f"{folder}/out", f"{folder}/check").awaitTermination()
    return resolution.answers(spark.read.parquet(f"{folder}/out"), ["txn"]).select("txn", "value", "flagged", "n_seen")


def _told(where: str) -> str:
    return f"""
WITH ledger AS (SELECT DISTINCT * FROM ({NUMBERED}) WHERE {where}), {_resolve('SELECT * FROM ledger', 'txn')}, n AS (SELECT txn, count(*) AS n_seen FROM ledger GROUP BY txn)
SELECT txn, value, flagged, n_seen FROM n JOIN answers USING (txn)
"""


SQL["resolve_incremental"] = _told("id % 17 <> 0")
SQL["resolve_stream"] = _told("TRUE")


@query
def resolver_failures(spark, sf_dir):
    """Conflicts, by a resolver that fails for every third transaction and names no claim for every fifth."""
    def asked(key: dict, claims) -> dict:
        if key["txn"] % 3 == 0:
            raise RuntimeError("no answer came")
        best = max(claims, key=lambda r: (r["value"], -r["id"]))
        return {"chosen": -1 if key["txn"] % 5 == 0 else best["id"], "value": best["value"], "severity": "MINOR"}

    out, conflicts = ledger.resolved_each(_numbered(spark, sf_dir), ["txn"], "id", asked, tries=1)
    told = conflicts.select(c("txn").alias("__t"), "severity", "n_claims", "chosen_id", F.substring_index("reason", ":", 1).alias("reason"))
    return out.join(told, c("txn") == c("__t"), "left").drop("__t")


SQL["resolver_failures"] = f"""
WITH ledger AS (SELECT DISTINCT * FROM ({NUMBERED})), {_resolve('SELECT * FROM ledger', 'txn')}, n AS (SELECT txn, count(*) AS n_seen FROM ledger GROUP BY txn),
top AS (SELECT txn, max(value) AS top_value, arg_min(id, struct_pack(v := -value, i := id)) AS top_id, count(*) AS n_claims FROM deciding WHERE tier = best_tier GROUP BY txn)
SELECT txn, CASE WHEN flagged = 1 AND txn % 3 <> 0 AND txn % 5 <> 0 THEN top_value ELSE value END AS value, CAST(flagged = 1 AND (txn % 3 = 0 OR txn % 5 = 0) AS INTEGER) AS flagged, n_seen,
  CASE WHEN flagged = 1 THEN CASE WHEN txn % 3 = 0 OR txn % 5 = 0 THEN 'MATERIAL' ELSE 'MINOR' END END AS severity, CASE WHEN flagged = 1 THEN n_claims END AS n_claims,
  CASE WHEN flagged = 1 AND txn % 3 <> 0 AND txn % 5 <> 0 THEN top_id END AS chosen_id,
  CASE WHEN flagged = 1 THEN CASE WHEN txn % 3 = 0 THEN 'RuntimeError' WHEN txn % 5 = 0 THEN 'the answer names no claim of the conflict' END END AS reason
FROM n JOIN answers USING (txn) LEFT JOIN top USING (txn)
"""


@query
def committed_tables(spark, sf_dir):
    """Customers upserted, orders superseded and lines replaced, each as versions of one folder; the last version read."""
    store = versions.Versions(spark, _folder(spark, "tables"), 8)
    people = view(spark, sf_dir, "customer").select("c_custkey", "c_name", c("c_acctbal").alias("balance"), F.lit(1).alias("version"))
    versions.upsert(store, "people", people, "c_custkey", ["c_name", "balance"], "version", people.schema)
    versions.upsert(store, "people", people.where("c_custkey % 7 = 0").select("c_custkey", F.lit(0.0).alias("balance")), "c_custkey", ["balance"], "version")
    o = view(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    versions.supersede(store, "orders", o, "o_orderkey")
    versions.supersede(store, "orders", o.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("X")), "o_orderkey")
    rows = view(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    versions.replace_children(store, "lines", rows, "l_orderkey")
    versions.replace_children(store, "lines", rows.where("l_orderkey % 5 = 0 AND l_quantity > 40").withColumn("l_quantity", F.lit(1.0)), "l_orderkey")
    bought = store.read("lines").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("n"))
    own = store.read("orders").join(bought, c("o_orderkey") == c("l_orderkey"), "left").groupBy(c("o_custkey").alias("k")).agg(
        F.count(F.when(c("is_current") == 1, 1)).alias("n_current"), F.count(F.when(c("is_current") == 0, 1)).alias("n_old"), F.sum(F.when(c("is_current") == 1, c("n"))).alias("quantity"),
    )
    return store.read("people").join(own, c("c_custkey") == c("k"), "left").select("c_custkey", "balance", "version", "n_current", "n_old", "quantity")


SQL["committed_tables"] = """
WITH lines AS (SELECT l_orderkey, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey % 5 = 0 AND l_quantity > 40)
               UNION ALL SELECT l_orderkey, 1.0 FROM lineitem WHERE l_orderkey % 5 = 0 AND l_quantity > 40),
bought AS (SELECT l_orderkey, sum(l_quantity) AS n FROM lines GROUP BY l_orderkey),
own AS (SELECT o_custkey AS k, count(*) AS n_current, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_old, sum(n) AS quantity FROM orders LEFT JOIN bought ON o_orderkey = l_orderkey GROUP BY o_custkey)
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 0.0 ELSE c_acctbal END AS balance, CASE WHEN c_custkey % 7 = 0 THEN 2 ELSE 1 END AS version, n_current, n_old, quantity FROM customer LEFT JOIN own ON c_custkey = k
"""


@query
def components_of_orders(spark, sf_dir):
    """The closure of orders that share a part and ship on one day: a component's least order, its size and its parts."""
    rows = view(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", c("l_shipdate").cast("date").alias("day")).distinct()
    hub = rows.groupBy("l_partkey", "day").agg(F.min("l_orderkey").alias("b"))
    edges = rows.join(hub, ["l_partkey", "day"]).select(c("l_orderkey").alias("a"), "b").where("a <> b")
    labels = cluster.components(edges)
    return labels.groupBy(c("label").alias("least_order")).agg(F.count(F.lit(1)).alias("n_orders"), F.max("node").alias("greatest_order"))


SQL["components_of_orders"] = """
WITH RECURSIVE r AS (SELECT DISTINCT l_orderkey, l_partkey, CAST(l_shipdate AS DATE) AS d FROM lineitem), e AS (SELECT DISTINCT x.l_orderkey AS a, y.l_orderkey AS b FROM r x JOIN r y USING (l_partkey, d) WHERE x.l_orderkey <> y.l_orderkey),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a), least AS (SELECT a, least(a, min(b)) AS least_order FROM reach GROUP BY a)
SELECT least_order, count(*) AS n_orders, max(a) AS greatest_order FROM least GROUP BY least_order
"""


@query
def page_texts(spark, sf_dir):
    """The best text of every whole page. SQL can't read pages; tests hold it against a tree walked in Python."""
    return pages.page_texts(view(spark, sf_dir, "pages"))
