"""Projections of the driver's tables onto the domain: deals, a ledger, templated texts.

They are inputs, not operators, and are written in SQL that Spark and DuckDB read alike, so
that queries and oracles start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations"]

DEALS = """
SELECT o_orderkey AS deal_id,
  CASE o_orderkey % 7 WHEN 0 THEN 'ACQUISITION' WHEN 1 THEN 'MERGER' WHEN 2 THEN 'VC_ROUND' WHEN 3 THEN 'MINORITY_INVESTMENT'
    WHEN 4 THEN 'SPIN_OFF' WHEN 5 THEN 'GROWTH_EQUITY' ELSE 'ACQUISITION' END AS event,
  CASE o_custkey % 4 WHEN 0 THEN 'TRANSACTION_VALUE' WHEN 1 THEN 'EQUITY_VALUE' WHEN 2 THEN 'ENTERPRISE_VALUE' ELSE 'EQUITY_VALUE' END AS value_type,
  o_totalprice AS value_amount,
  CASE o_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE NULL END AS value_currency,
  CASE o_custkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD' ELSE 'GBP' END AS financials_currency,
  CASE o_custkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE NULL END AS debt_currency,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE floor(o_totalprice * 0.3) END AS total_debt,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE floor(o_totalprice * 0.1) END AS cash,
  CASE WHEN o_orderkey % 17 = 0 THEN floor(o_totalprice * 0.25) END AS reported_net_debt,
  CASE WHEN o_orderkey % 3 = 0 THEN '2023-12-31' ELSE '2024-06-30' END AS debt_as_of,
  CASE WHEN o_orderkey % 5 = 0 THEN '2023-12-31' WHEN o_orderkey % 5 = 1 THEN NULL ELSE '2024-06-30' END AS cash_as_of,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 120 AS DOUBLE) END AS pct,
  CASE o_orderkey % 4 WHEN 0 THEN 'NEW_MINORITY_STAKE' WHEN 1 THEN 'FULL_ACQUISITION' WHEN 2 THEN NULL ELSE 'MAJORITY_INCREASING_STAKE' END AS transition,
  CASE WHEN o_orderkey % 2 = 0 THEN 'PUBLIC' ELSE 'PRIVATE' END AS target_status,
  CASE WHEN o_orderkey % 3 = 1 THEN 'assets' ELSE 'Standalone_Company' END AS target_type,
  CASE o_custkey % 3 WHEN 0 THEN 'private_equity' WHEN 1 THEN 'strategic' ELSE 'MANAGEMENT' END AS acquirer_type,
  CASE WHEN o_custkey % 2 = 0 THEN 1 END AS private_outcome,
  CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS buyer_sponsor,
  CASE WHEN o_custkey % 5 = 0 THEN 1 ELSE 0 END AS seller_sponsor,
  CASE WHEN o_orderkey % 19 = 0 THEN 1 END AS said_secondary,
  CASE o_orderstatus WHEN 'P' THEN 'TERMINATED' WHEN 'F' THEN 'CLOSED' ELSE 'ANNOUNCED' END AS history,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS announced,
  floor(o_totalprice / (1 + o_custkey % 90)) AS revenue,
  floor(o_totalprice / (1 + o_custkey % 140)) AS ebitda,
  CASE o_orderkey % 5 WHEN 0 THEN 'LTM' WHEN 1 THEN 'NTM' WHEN 2 THEN 'ANNUAL' WHEN 3 THEN 'TTM' ELSE 'QUARTERLY' END AS revenue_period,
  CASE o_orderkey % 3 WHEN 0 THEN 'ANNUAL' WHEN 1 THEN 'LTM' ELSE NULL END AS ebitda_period,
  CASE WHEN o_orderkey % 4 = 0 THEN substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 1, 4) ELSE substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 1, 10) END AS revenue_end,
  CASE WHEN o_orderkey % 4 = 1 THEN '1991-12-31' ELSE substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 1, 7) END AS ebitda_end,
  floor(o_totalprice * 0.5) AS round_size
FROM orders
"""

LEDGER = """
SELECT l_orderkey AS txn, l_suppkey AS source,
  CASE l_returnflag WHEN 'A' THEN 'T1' WHEN 'N' THEN 'T2' ELSE 'T3' END AS tier,
  CASE WHEN l_linestatus = 'F' THEN 'HIGH' WHEN l_partkey % 3 = 0 THEN 'LOW' ELSE NULL END AS confidence,
  l_partkey * 10000000000 + l_suppkey * 100000 + CAST(extract(YEAR FROM l_shipdate) * 372 + extract(MONTH FROM l_shipdate) * 31 + extract(DAY FROM l_shipdate) AS BIGINT) AS seq,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) AS filed,
  l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax, l_partkey AS part,
  CASE l_linenumber % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency
FROM lineitem
"""

CLAIMS = """
SELECT c_custkey AS id,
  CASE c_custkey % 12 WHEN 0 THEN '65%' WHEN 1 THEN 'approximately 40.5 %' WHEN 2 THEN '30-40%' WHEN 3 THEN 'at least 51%' WHEN 4 THEN '' WHEN 5 THEN '~ 12'
    WHEN 6 THEN '0%' WHEN 7 THEN '101' WHEN 8 THEN 'majority' WHEN 9 THEN 'about 7.25%' WHEN 10 THEN 'APPROX. 99' ELSE NULL END AS pct,
  CASE c_custkey % 11 WHEN 0 THEN 'Series A' WHEN 1 THEN 'series b-2 extension' WHEN 2 THEN 'Pre-Seed round' WHEN 3 THEN 'seed funding' WHEN 4 THEN 'Series AA'
    WHEN 5 THEN 'Series C03' WHEN 6 THEN 'angel' WHEN 7 THEN 'bridge' WHEN 8 THEN 'Series H financing round' WHEN 9 THEN 'series_d1' ELSE NULL END AS label,
  CASE c_custkey % 10 WHEN 0 THEN 'acquisition' WHEN 1 THEN 'SPINOFF' WHEN 2 THEN 'series_b' WHEN 3 THEN 'TAKE_PRIVATE' WHEN 4 THEN 'Deal_Close' WHEN 5 THEN ''
    WHEN 6 THEN 'pipe_offering' WHEN 7 THEN 'something' WHEN 8 THEN NULL ELSE 'merger' END AS reason,
  c_nationkey % 3 > 0 AS relevant,
  CASE c_custkey % 6 WHEN 0 THEN 'hiring, go_to_market' WHEN 1 THEN 'Hiring,HIRING , nonsense' WHEN 2 THEN 'nonsense' WHEN 3 THEN '' WHEN 4 THEN 'OTHER,acquisitions,other' ELSE NULL END AS uses,
  CASE c_custkey % 8 WHEN 0 THEN 'Acme Holdings, Inc.' WHEN 1 THEN 'The Beta & Gamma Group Ltd' WHEN 2 THEN 'Delta (Europe) GmbH' WHEN 3 THEN 'Alpha and Omega LLC'
    WHEN 4 THEN 'Zeta   Co., Limited' WHEN 5 THEN 'Group' WHEN 6 THEN '' ELSE NULL END AS company,
  CASE c_custkey % 9 WHEN 0 THEN 'Acme Capital, Beta Partners' WHEN 1 THEN 'Acme Capital, LLC' WHEN 2 THEN 'Acme; Beta Partners' WHEN 3 THEN 'KKR and Blue Owl' WHEN 4 THEN 'One Fund and Two Fund and Three Fund'
    WHEN 5 THEN 'Solo' WHEN 6 THEN 'KKR, TPG, Apollo Global' WHEN 7 THEN 'Big Fund, Inc, Other Fund' ELSE '' END AS names,
  'raised $' || CAST(c_custkey % 400 AS VARCHAR(10)) || CASE c_custkey % 4 WHEN 0 THEN ' million' WHEN 1 THEN '.5 bn' WHEN 2 THEN ',000' ELSE 'k' END || ' then US$ 2,500 for ' || CASE WHEN c_custkey % 3 = 0 THEN 'Foo Corp (NYSE: FOO)' WHEN c_custkey % 3 = 1 THEN 'Bar (NASDAQ:BARX) and (NYSE: ZZ)' ELSE 'nobody' END AS news
FROM customer
"""


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DEALS.replace("FROM orders", "FROM {orders}"), orders=view(spark, sf_dir, "orders"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LEDGER.replace("FROM lineitem", "FROM {lineitem}"), lineitem=view(spark, sf_dir, "lineitem"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CLAIMS.replace("FROM customer", "FROM {customer}"), customer=view(spark, sf_dir, "customer"))
