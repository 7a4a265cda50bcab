"""Queries over the warehouse: ledger writers, derived rows, participants, checks, scores, review sheets.

The warehouse's tables are templated from the driver's tables in SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.operators import cluster, derived, ledger, participants, quality, relational, writers
from factmill.operators.shared import dealt
from factmill.plans.domain import LEDGER, view
from factmill.plans.domain import ledger as claims_ledger
from factmill.plans.extraction import _in, _of
from factmill.plans.oracles import SQL, _resolve
from factmill.plans.queries import query

c = F.col


# ---- ledger writers

STAGED = """
SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 't' || CAST(o_custkey AS VARCHAR(20)) END AS txn, o_orderkey AS extraction, o_orderkey % 100 AS source, CASE o_custkey % 3 WHEN 0 THEN 'T1' ELSE 'T2' END AS tier,
  CASE o_custkey % 4 WHEN 0 THEN 'SEC_FORM' ELSE 'NEWS' END AS source_type, CASE o_orderkey % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'LOW' ELSE NULL END AS confidence, '2024-01-01' AS published, 'dt:1' AS dt_version, 'hc:1' AS hc_version, 'lc:1' AS lc_version,
  CASE o_orderkey % 5 WHEN 0 THEN 'CLUSTERED' WHEN 1 THEN 'FAILED' ELSE 'AGGREGATED' END AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'ACQUISITION' END AS deal_type, CASE WHEN o_orderkey % 6 = 0 THEN floor(o_totalprice) END AS round_size,
  CASE o_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END AS is_merger_of_equals, 'Target ' || CAST(o_custkey % 50 AS VARCHAR(20)) AS target_name, CASE WHEN o_orderkey % 4 = 0 THEN 30 END AS go_shop_period_days,
  CASE o_orderkey % 4 WHEN 0 THEN '[{"amount":' || CAST(o_custkey AS VARCHAR(20)) || ',"currency":"USD","type":"EQUITY_VALUE","basis":"about"},{"currency":"EUR"}]' WHEN 1 THEN 'broken' ELSE NULL END AS value_observations,
  CASE o_orderkey % 5 WHEN 0 THEN '[{"multiple_type":"EV_EBITDA","multiple_value":11.5,"period_basis":"LTM","period_end_date":null},{"multiple_value":3}]' ELSE '[]' END AS reported_multiples,
  CASE o_orderkey % 3 WHEN 0 THEN '[{"name":"Acme","type":null},{"name":""},{"name":"Beta","type":"spac"}]' ELSE '[]' END AS acquirers, CASE o_orderkey % 3 WHEN 1 THEN '[{"name":"Seller"}]' ELSE NULL END AS sellers,
  CASE o_orderkey % 8 WHEN 0 THEN '[{"name":"First Bank"}]' ELSE '[]' END AS financing_providers, CASE o_orderkey % 9 WHEN 0 THEN '[{"form":"CASH","amount":5,"per_share_amount":2.5},{"exchange_ratio":0.5}]' ELSE NULL END AS consideration_components
FROM orders
"""
staged = _of(STAGED, "orders")


@query
def staging_observations(spark, sf_dir):
    rows = writers.backfilled(staged(spark, sf_dir))
    return rows.select("extraction", "field", "text", "number", "fact_key", "stage", "version", "confidence", "filing_type")


_WHOLE = """'{"amount":' || o || ',"basis":' || b || ',"currency":"' || u || '","evidence":null,"qualifier":null,"type":' || t || '}'"""
SQL["staging_observations"] = f"""
WITH s AS (SELECT *, extraction AS e, regexp_extract(value_observations, '"amount":([0-9]+)', 1) AS amount FROM ({STAGED}) WHERE txn IS NOT NULL AND status IN {_in(writers.READY)}),
v AS (SELECT e, 0 AS i, amount || '.0' AS o, '"about"' AS b, 'USD' AS u, '"EQUITY_VALUE"' AS t FROM s WHERE e % 4 = 0 UNION ALL SELECT e, 1, 'null', 'null', 'EUR', 'null' FROM s WHERE e % 4 = 0),
rows AS (
  SELECT e, '__source_row_present' AS field, '1' AS text, NULL::DOUBLE AS number, NULL AS fact_key, NULL AS version FROM s
  UNION ALL SELECT e, 'deal_type', deal_type, NULL, NULL, 'dt:1' FROM s UNION ALL SELECT e, 'round_size', CAST(CAST(round_size AS BIGINT) AS VARCHAR), round_size, NULL, 'hc:1' FROM s
  UNION ALL SELECT e, 'is_merger_of_equals', CASE WHEN is_merger_of_equals THEN '1' WHEN NOT is_merger_of_equals THEN '0' END, CAST(CAST(is_merger_of_equals AS INTEGER) AS DOUBLE), NULL, 'hc:1' FROM s
  UNION ALL SELECT e, 'target_name', target_name, NULL, NULL, 'hc:1' FROM s UNION ALL SELECT e, 'go_shop_period_days', CAST(go_shop_period_days AS VARCHAR), CAST(go_shop_period_days AS DOUBLE), NULL, 'lc:1' FROM s
  UNION ALL SELECT e, 'value_amount', amount, CAST(amount AS DOUBLE), 'value_observations[0]', 'hc:1' FROM s WHERE e % 4 = 0
  UNION ALL SELECT e, 'value_currency', u, NULL, 'value_observations[' || i || ']', 'hc:1' FROM v UNION ALL SELECT e, 'value_type', 'EQUITY_VALUE', NULL, 'value_observations[0]', 'hc:1' FROM s WHERE e % 4 = 0
  UNION ALL SELECT e, 'value_qualifier', 'about', NULL, 'value_observations[0]', 'hc:1' FROM s WHERE e % 4 = 0 UNION ALL SELECT e, 'value_observation', {_WHOLE}, NULL, 'value_observations[' || i || ']', 'hc:1' FROM v
  UNION ALL SELECT e, 'reported_multiple', '{{"as_reported_text":null,"multiple_type":"EV_EBITDA","multiple_value":11.5,"numerator_value_type":null,"period_basis":"LTM","period_end_date":null}}', NULL, 'reported_multiples[0]', 'hc:1' FROM s WHERE e % 5 = 0
  UNION ALL SELECT e, 'reported_multiple', '{{"as_reported_text":null,"multiple_type":null,"multiple_value":3.0,"numerator_value_type":null,"period_basis":null,"period_end_date":null}}', NULL, 'reported_multiples[1]', 'hc:1' FROM s WHERE e % 5 = 0
  UNION ALL SELECT e, 'multiple.EV_EBITDA.LTM.', '11.5', 11.5, 'reported_multiples[0]', 'hc:1' FROM s WHERE e % 5 = 0
  UNION ALL SELECT e, 'acquirer_party', '{{"name":"Acme","type":null}}', NULL, 'acquirers[0]', 'hc:1' FROM s WHERE e % 3 = 0 UNION ALL SELECT e, 'acquirer_party', '{{"name":"Beta","type":"spac"}}', NULL, 'acquirers[2]', 'hc:1' FROM s WHERE e % 3 = 0
  UNION ALL SELECT e, 'seller_party', '{{"name":"Seller"}}', NULL, 'sellers[0]', 'hc:1' FROM s WHERE e % 3 = 1
  UNION ALL SELECT e, 'financing_provider_party', '{{"name":"First Bank"}}', NULL, 'financing_providers[0]', 'lc:1' FROM s WHERE e % 8 = 0
  UNION ALL SELECT e, 'consideration_components', consideration_components, NULL, NULL, 'lc:1' FROM s UNION ALL SELECT e, 'consideration.CASH.amount', '5', 5, NULL, 'lc:1' FROM s WHERE e % 9 = 0
  UNION ALL SELECT e, 'consideration.CASH.per_share_amount', '2.5', 2.5, NULL, 'lc:1' FROM s WHERE e % 9 = 0 UNION ALL SELECT e, 'consideration.UNKNOWN.exchange_ratio', '0.5', 0.5, NULL, 'lc:1' FROM s WHERE e % 9 = 0)
SELECT r.e AS extraction, field, text, number, fact_key, 'BACKFILL' AS stage, r.version, CASE WHEN field = '__source_row_present' THEN coalesce(confidence, 'MEDIUM') ELSE confidence END AS confidence, CASE WHEN source_type = 'SEC_FORM' THEN source_type END AS filing_type
FROM rows r JOIN s ON s.e = r.e WHERE text IS NOT NULL
"""


@query
def staging_observations_by_stage(spark, sf_dir):
    rows = writers.observations(staged(spark, sf_dir), "HC_EXTRACT", classified=True, deal=True, funding=True)
    return rows.groupBy("field", "stage").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("number"), 2).alias("total")).where("field IN ('round_size', 'deal_type', 'target_name', '__source_row_present')")


SQL["staging_observations_by_stage"] = f"""
WITH s AS ({STAGED}) SELECT 'round_size' AS field, 'FUNDING_HC_EXTRACT' AS stage, count(round_size) AS n, sum(round_size) AS total FROM s UNION ALL SELECT 'deal_type', 'DT_CLASSIFY', count(deal_type), NULL FROM s
UNION ALL SELECT 'target_name', 'HC_EXTRACT', count(target_name), NULL FROM s UNION ALL SELECT '__source_row_present', 'HC_EXTRACT', count(*), NULL FROM s
"""


@query
def ledger_backfill(spark, sf_dir):
    o = view(spark, sf_dir, "orders")
    rows = o.select(F.when(c("o_orderkey") % 3 == 0, F.concat(F.lit("own"), c("o_orderkey"))).alias("txn"), c("o_orderkey").alias("extraction"), F.when(c("o_custkey") % 2 == 0, c("o_custkey")).alias("document"), F.when(c("o_orderkey") % 4 == 0, "NEWS").alias("source_type"), F.lit(None).cast("string").alias("filing_type"), F.lit(None).cast("string").alias("tier"), F.lit(None).cast("string").alias("stage"), F.lit(None).cast("string").alias("agreement_dated_as_of"))
    docs = view(spark, sf_dir, "customer").select(c("c_custkey").alias("document"), F.lit("FORM_A").alias("filing_type"), F.when(c("c_custkey") % 4 == 0, "Agreement dated as of March 3, 2024 by").otherwise("none").alias("raw_text"))
    return writers.with_provenance(writers.with_transactions(rows, staged(spark, sf_dir)), docs)


SQL["ledger_backfill"] = f"""
WITH s AS ({STAGED}), r AS (SELECT o.*, CASE WHEN o_orderkey % 3 = 0 THEN 'own' || o_orderkey ELSE s.txn END AS txn, o_custkey % 2 = 0 AND c_custkey IS NOT NULL AS there, o_custkey % 2 = 0 AS asked FROM orders o LEFT JOIN s ON s.extraction = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey)
SELECT txn, o_orderkey AS extraction, CASE WHEN asked THEN o_custkey END AS document, CASE WHEN o_orderkey % 4 = 0 THEN 'NEWS' WHEN there THEN 'FORM_A' END AS source_type, CASE WHEN there THEN 'FORM_A' END AS filing_type, CASE WHEN asked THEN 'T1' END AS tier,
  CASE WHEN asked THEN 'AGREEMENT_EXTRACT' END AS stage, CASE WHEN there AND o_custkey % 4 = 0 THEN '2024-03-03' END AS agreement_dated_as_of FROM r
"""


# ---- agreements

RESULTS = """
SELECT 't' || CAST(l_orderkey AS VARCHAR(20)) AS txn, l_partkey AS document, l_linenumber AS section, CASE l_suppkey % 3 WHEN 0 THEN 'FORM_A' WHEN 1 THEN 'FORM_B' ELSE 'FORM_C' END AS filing_type, CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) AS filed,
  CASE l_linenumber % 5 WHEN 0 THEN 'RECITALS' WHEN 1 THEN 'TERMINATION_FEES' WHEN 2 THEN 'CONDITIONS_TO_CLOSING' WHEN 3 THEN 'CONSIDERATION' ELSE 'CAPITALIZATION' END AS section_type,
  CASE l_linenumber % 5 WHEN 0 THEN '{"merger_structure":' || CASE l_suppkey % 2 WHEN 0 THEN '"UNKNOWN"' ELSE '"ONE_STEP"' END || ',"parties":[{"role":"MERGER_SUB","name":' || CASE l_partkey % 3 WHEN 0 THEN '"Merger Sub"' WHEN 1 THEN '"[TBD] Inc"' ELSE '" Sub ' || CAST(l_partkey AS VARCHAR(20)) || ' Inc "' END || '},{"role":"SELLER","name":"Seller Corp"},{"name":"x"}],"model_confidence":"HIGH"}'
    WHEN 1 THEN '{"target_termination_fee":' || CAST(l_partkey AS VARCHAR(20)) || ',"has_go_shop":' || CASE l_suppkey % 2 WHEN 0 THEN 'true' ELSE 'false' END || ',"go_shop_period_days":null,"notes":"n"}'
    WHEN 2 THEN '{"regulatory_approvals_required":true}' WHEN 3 THEN '{"consideration_components":[{"form":"CASH","amount":' || CAST(l_partkey AS VARCHAR(20)) || '}]}'
    ELSE '{"securities":[{"security_type":"COMMON_STOCK","security_class":"A","shares_outstanding":' || CAST(l_partkey AS VARCHAR(20)) || ',"shares_outstanding_as_of":"2024-01-01"},{"security_type":"RSU"},{"shares_outstanding":4}]}' END AS answer
FROM lineitem
"""
results = _of(RESULTS, "lineitem")


@query
def agreement_observations(spark, sf_dir):
    return writers.agreement_observations(results(spark, sf_dir)).select("txn", "document", "section", "filed", "field", "text", "number", "as_of")


SQL["agreement_observations"] = f"""
WITH r AS (SELECT DISTINCT * FROM ({RESULTS})), o AS (
  SELECT *, 'merger_structure' AS field, 'ONE_STEP' AS text, NULL::DOUBLE AS number, NULL AS as_of FROM r WHERE contains(answer, 'ONE_STEP')
  UNION ALL SELECT *, 'party.MERGER_SUB', trim(regexp_extract(answer, '" (Sub [0-9]+ Inc) "', 1)), NULL, NULL FROM r WHERE section_type = 'RECITALS' AND document % 3 = 2 UNION ALL SELECT *, 'party.SELLER', 'Seller Corp', NULL, NULL FROM r WHERE section_type = 'RECITALS'
  UNION ALL SELECT *, 'target_termination_fee', CAST(document AS VARCHAR), document, NULL FROM r WHERE section_type = 'TERMINATION_FEES' UNION ALL SELECT *, 'has_go_shop', CASE WHEN contains(answer, 'true') THEN 'True' ELSE 'False' END, CASE WHEN contains(answer, 'true') THEN 1 ELSE 0 END, NULL FROM r WHERE section_type = 'TERMINATION_FEES'
  UNION ALL SELECT *, 'regulatory_approvals_required', 'True', 1, NULL FROM r WHERE section_type = 'CONDITIONS_TO_CLOSING' UNION ALL SELECT *, 'consideration.CASH.amount', CAST(document AS VARCHAR), document, NULL FROM r WHERE section_type = 'CONSIDERATION'
  UNION ALL SELECT *, 'shares_outstanding.COMMON_STOCK.A', CAST(document AS VARCHAR), document, '2024-01-01' FROM r WHERE section_type = 'CAPITALIZATION' UNION ALL SELECT *, 'shares_outstanding.UNKNOWN', '4', 4, NULL FROM r WHERE section_type = 'CAPITALIZATION')
SELECT DISTINCT txn, document, section, filed, field, text, number, as_of FROM o
"""
RANKS = {"merger_structure": {"FORM_A": 0, "FORM_B": 1}, "target_fee_amount": {"FORM_B": 0, "FORM_C": 1}}


def _record(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "orders")
    s = lambda v: F.lit(v).cast("string")
    return o.select(F.concat(F.lit("t"), c("o_orderkey")).alias("txn"), F.when(c("o_orderkey") % 2 == 0, "TWO_STEP").alias("merger_structure"), s(None).alias("acquirer_merger_sub_name"), c("o_custkey").cast("double").alias("target_fee_amount"), F.lit(None).cast("int").alias("has_go_shop"), F.lit(1).alias("regulatory_approvals_required"), s("[]").alias("consideration_components"))


@query
def agreement_applied(spark, sf_dir):
    out = writers.applied_rows(_record(spark, sf_dir), results(spark, sf_dir), RANKS)
    return out.withColumn("n_conflicts", F.size("conflicts").cast("long")).drop("conflicts")


SQL["agreement_applied"] = f"""
WITH r AS ({RESULTS}), u AS (
  SELECT *, 'merger_structure' AS field, 'ONE_STEP' AS new, CASE filing_type WHEN 'FORM_A' THEN 0 WHEN 'FORM_B' THEN 1 ELSE 9 END AS rank FROM r WHERE contains(answer, 'ONE_STEP')
  UNION ALL SELECT *, 'acquirer_merger_sub_name', trim(regexp_extract(answer, '" (Sub [0-9]+ Inc) "', 1)), 0 FROM r WHERE section_type = 'RECITALS' AND document % 3 = 2
  UNION ALL SELECT *, 'target_fee_amount', CAST(document AS VARCHAR), CASE filing_type WHEN 'FORM_B' THEN 0 WHEN 'FORM_C' THEN 1 ELSE 9 END FROM r WHERE section_type = 'TERMINATION_FEES'
  UNION ALL SELECT *, 'has_go_shop', CASE WHEN contains(answer, 'true') THEN '1' ELSE '0' END, 0 FROM r WHERE section_type = 'TERMINATION_FEES' UNION ALL SELECT *, 'regulatory_approvals_required', '1', 0 FROM r WHERE section_type = 'CONDITIONS_TO_CLOSING'
  UNION ALL SELECT *, 'consideration_components', '[{{"amount":' || document || ',"form":"CASH"}}]', 0 FROM r WHERE section_type = 'CONSIDERATION'),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY txn, field ORDER BY rank, filed DESC, document DESC, section DESC) AS k FROM u) WHERE k = 1),
p AS (SELECT txn, max(new) FILTER (WHERE field = 'merger_structure') AS ms, max(new) FILTER (WHERE field = 'acquirer_merger_sub_name') AS sub, max(new) FILTER (WHERE field = 'target_fee_amount') AS fee, max(new) FILTER (WHERE field = 'has_go_shop') AS shop,
  max(new) FILTER (WHERE field = 'consideration_components') AS cc FROM w GROUP BY txn), o AS (SELECT 't' || o_orderkey AS t, * FROM orders)
SELECT t AS txn, coalesce(ms, CASE WHEN o_orderkey % 2 = 0 THEN 'TWO_STEP' END) AS merger_structure, sub AS acquirer_merger_sub_name, coalesce(CAST(fee AS DOUBLE), o_custkey) AS target_fee_amount, CAST(shop AS INTEGER) AS has_go_shop, 1 AS regulatory_approvals_required, coalesce(cc, '[]') AS consideration_components,
  CAST((ms IS NOT NULL AND o_orderkey % 2 = 0) AS BIGINT) + CAST(coalesce(CAST(fee AS DOUBLE) <> o_custkey, FALSE) AS BIGINT) + CAST(cc IS NOT NULL AS BIGINT) AS n_conflicts FROM o LEFT JOIN p ON p.txn = t
"""


@query
def agreement_securities(spark, sf_dir):
    return writers.securities(results(spark, sf_dir)).groupBy("security_type", "security_class", "as_of").agg(F.count(F.lit(1)).alias("n"), F.sum("shares").alias("shares"))


SQL["agreement_securities"] = f"""
WITH r AS ({RESULTS}) SELECT 'COMMON_STOCK' AS security_type, 'A' AS security_class, '2024-01-01' AS as_of, count(*) AS n, CAST(sum(document) AS DOUBLE) AS shares FROM r WHERE section_type = 'CAPITALIZATION'
UNION ALL SELECT 'RSU', NULL, NULL, count(*), NULL FROM r WHERE section_type = 'CAPITALIZATION'
"""


@query
def stale_canonical(spark, sf_dir):
    seen = view(spark, sf_dir, "lineitem").select(F.concat(F.lit("t"), c("l_orderkey")).alias("txn"), F.when(c("l_linenumber") == 1, "merger_structure").when(c("l_linenumber") == 2, "target_termination_fee").when(c("l_linenumber") == 3, "consideration.CASH.amount").otherwise("other").alias("field"), (c("l_returnflag") != "A").cast("int").alias("is_current"))
    own = {"merger_structure": "merger_structure", "target_fee_amount": "target_termination_fee"}
    return writers.cleared(_record(spark, sf_dir), seen, own).select("txn", "merger_structure", "target_fee_amount", "consideration_components")


SQL["stale_canonical"] = """
WITH l AS (SELECT l_orderkey AS k, bool_or(l_linenumber = 1) AS a, bool_or(l_linenumber = 2) AS b, bool_or(l_linenumber = 3) AS d FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1)
SELECT 't' || o_orderkey AS txn, CASE WHEN a AND o_orderkey % 2 = 0 THEN 'TWO_STEP' END AS merger_structure, CASE WHEN b THEN CAST(o_custkey AS DOUBLE) END AS target_fee_amount, CASE WHEN d THEN '[]' END AS consideration_components FROM orders LEFT JOIN l ON k = o_orderkey
"""


# ---- derived rows

FACTS = """
SELECT o_orderkey AS txn, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS target_revenue, CASE o_custkey % 2 WHEN 0 THEN 'USD' END AS target_revenue_currency, 'LTM' AS target_revenue_period_type, CASE o_custkey % 3 WHEN 0 THEN '2024' WHEN 1 THEN '2024-06' ELSE '2024-06-30' END AS target_revenue_period_end,
  CASE WHEN o_custkey % 4 <> 0 THEN floor(o_totalprice / 10) END AS target_ebitda, 'EUR' AS target_ebitda_currency, CASE WHEN o_orderkey % 2 = 0 THEN 'ANNUAL' END AS target_ebitda_period_type, CASE WHEN o_orderkey % 5 = 0 THEN 'soon' END AS target_ebitda_period_end,
  CASE WHEN o_orderkey % 4 <> 0 THEN floor(o_totalprice) END AS debt, CASE o_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN '' END AS debt_currency, CASE o_orderkey % 3 WHEN 0 THEN '2023-12-31' END AS debt_as_of,
  CASE WHEN o_custkey % 4 <> 1 THEN 5.0 END AS cash, 'USD' AS cash_currency, CASE o_custkey % 3 WHEN 1 THEN '2023-12-31' END AS cash_as_of, CASE WHEN o_orderkey % 5 = 0 THEN 9.0 END AS old_debt, CASE WHEN o_orderkey % 7 = 0 THEN 'GBP' END AS old_currency, CASE WHEN o_custkey % 5 = 0 THEN '2022-12-31' END AS old_as_of,
  CASE WHEN o_custkey % 5 = 1 THEN 40 END AS pct, CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS equals_flag, CASE o_custkey % 2 WHEN 0 THEN 'ENTERPRISE_VALUE' ELSE 'EQUITY_VALUE' END AS value_type, o_totalprice AS value_amount
FROM orders
"""
facts = _of(FACTS, "orders")


@query
def financial_rows(spark, sf_dir):
    return derived.metric_rows(facts(spark, sf_dir))


SQL["financial_rows"] = f"""
WITH f AS ({FACTS}), m AS (SELECT txn, 'REVENUE' AS metric_type, target_revenue AS value, target_revenue_currency AS currency, target_revenue_period_type AS period_type, target_revenue_period_end AS period_end FROM f
  UNION ALL SELECT txn, 'EBITDA', target_ebitda, target_ebitda_currency, target_ebitda_period_type, target_ebitda_period_end FROM f)
SELECT *, CASE length(period_end) WHEN 4 THEN CASE WHEN period_end = '2024' THEN 'year' END WHEN 7 THEN 'month' WHEN 10 THEN 'exact' END AS precision, 0 AS is_calculated FROM m WHERE value IS NOT NULL
"""


@query
def as_reported_multiples(spark, sf_dir):
    rows = view(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("txn"), c("l_partkey").alias("seq"), F.when(c("l_linenumber") % 3 == 0, "EV_EBITDA").when(c("l_linenumber") % 3 == 1, "PE").otherwise("PB").alias("t"), F.when(c("l_suppkey") % 2 == 0, "LTM").alias("b"), F.when(c("l_suppkey") % 5 == 0, "2024").alias("e"), c("l_quantity").alias("v"))
    one = rows.select("txn", writers.multiple_key(c("t"), c("b"), c("e")).alias("field"), c("v").alias("value"), F.lit("T1").alias("tier"), F.lit(None).cast("string").alias("confidence"), F.struct("seq", "v").alias("seq"))
    won = ledger.resolved(one, ["txn", "field"])
    kept = rows.select("txn", F.struct("seq", "v").alias("seq"), F.to_json(F.struct(c("t").alias("multiple_type"), c("b").alias("period_basis"), c("e").alias("period_end_date"), c("v").alias("multiple_value"), F.concat(c("seq").cast("string"), F.lit(" says")).alias("as_reported_text"))).alias("text"))
    return derived.multiple_rows(won, kept)


SQL["as_reported_multiples"] = """
WITH r AS (SELECT l_orderkey AS txn, l_partkey AS seq, l_quantity AS v, CASE l_linenumber % 3 WHEN 0 THEN 'EV_EBITDA' WHEN 1 THEN 'PE' ELSE 'PB' END AS t, CASE WHEN l_suppkey % 2 = 0 THEN 'LTM' END AS b, CASE WHEN l_suppkey % 5 = 0 THEN '2024' END AS e FROM lineitem)
SELECT txn, t AS multiple_type, min(v) AS value, b AS period_basis, e AS period_end, CASE WHEN e IS NOT NULL THEN 'year' END AS precision, CASE t WHEN 'EV_EBITDA' THEN 'implied_enterprise_value' ELSE 'implied_equity_value' END AS numerator, 'as_reported' AS source_flag,
  arg_min(seq || ' says', seq) AS as_reported FROM r GROUP BY txn, t, b, e HAVING count(DISTINCT v) = 1
"""


@query
def balance_inputs(spark, sf_dir):
    f = facts(spark, sf_dir)
    none = F.lit(None).cast("double")
    b = derived.balance_sheet(c("debt"), c("debt_currency"), c("debt_as_of"), c("cash"), c("cash_currency"), c("cash_as_of"), {"total_debt": c("old_debt"), "total_debt_currency": c("old_currency"), "cash_st": none, "cash_st_currency": c("old_currency"), "as_of": c("old_as_of")})
    ev = derived.stated_enterprise_value(c("value_amount"), c("value_type"))
    return f.select("txn", b.alias("b"), derived.percentage(c("pct")).alias("p"), derived.explicit(c("equals_flag")).alias("is_merger_of_equals"), ev.alias("v"), derived.investment_amount().alias("investment_amount")).select("txn", "b.*", "p.*", "is_merger_of_equals", c("v.value").alias("ev"), c("v.basis").alias("ev_basis"), "investment_amount")


SQL["balance_inputs"] = f"""
WITH f AS ({FACTS}), b AS (SELECT *, coalesce(debt, old_debt) AS d, coalesce(nullif(debt_currency, ''), old_currency) AS dc, coalesce(debt_as_of, CASE WHEN coalesce(debt, old_debt) IS NOT NULL THEN old_as_of END) AS da, coalesce(cash_as_of, CASE WHEN cash IS NOT NULL THEN old_as_of END) AS ca FROM f)
SELECT txn, d AS total_debt, dc AS total_debt_currency, da AS total_debt_as_of, CAST(cash AS DOUBLE) AS cash_st, cash_currency AS cash_st_currency, ca AS cash_st_as_of,
  CASE WHEN d IS NOT NULL AND cash IS NOT NULL THEN CASE WHEN da IS NOT DISTINCT FROM ca THEN da END WHEN d IS NOT NULL THEN da ELSE ca END AS as_of, CASE WHEN d IS NOT NULL OR cash IS NOT NULL THEN 'POINT_IN_TIME' END AS period_type,
  CAST(pct AS DOUBLE) AS pct, CASE WHEN pct IS NOT NULL THEN 'stated' END AS source, coalesce(equals_flag, 0) AS is_merger_of_equals, CASE WHEN value_type = 'ENTERPRISE_VALUE' AND value_amount > 0 THEN value_amount END AS ev,
  CASE WHEN value_type = 'ENTERPRISE_VALUE' AND value_amount > 0 THEN 'STATED' END AS ev_basis, NULL::DOUBLE AS investment_amount FROM b
"""


@query
def resolver_plugin(spark, sf_dir):
    rows = claims_ledger(spark, sf_dir).select("txn", F.lit("discount").alias("field"), c("discount").alias("value"), "tier", "confidence", "seq")
    highest = lambda conflicts: conflicts.groupBy("txn", "field").agg(F.max("value").alias("value"))
    out, conflicts = ledger.resolved_by(rows, ["txn", "field"], lambda df: highest(df.where("txn % 2 = 0")))
    n = conflicts.groupBy(c("txn").alias("__t")).agg(F.max("severity").alias("severity"), F.max("n_claims").alias("n_claims"))
    return out.join(n, c("txn") == c("__t"), "left").select("txn", "value", "flagged", "severity", "n_claims")


SQL["resolver_plugin"] = f"""
WITH ledger AS ({LEDGER}), told AS (SELECT *, CASE confidence WHEN 'HIGH' THEN 0 WHEN 'LOW' THEN 2 ELSE 1 END AS r, discount AS value FROM ledger WHERE discount IS NOT NULL), best AS (SELECT *, min(tier) OVER (PARTITION BY txn) AS bt FROM told), own AS (SELECT *, min(r) OVER (PARTITION BY txn) AS br FROM best WHERE tier = bt),
w AS (SELECT txn, count(DISTINCT value) AS nv, count(*) FILTER (WHERE r = br) AS nb, min(value) FILTER (WHERE r = br) AS bv, arg_min(value, seq) AS fv, max(value) AS mv, count(*) AS n FROM own GROUP BY txn), x AS (SELECT *, nv > 1 AND nb > 1 AS conflict FROM w)
SELECT txn, CASE WHEN conflict AND txn % 2 = 0 THEN mv WHEN nv > 1 AND nb = 1 THEN bv ELSE fv END AS value, CAST(conflict AND txn % 2 = 1 AS INTEGER) AS flagged, CASE WHEN conflict THEN CASE WHEN txn % 2 = 0 THEN 'RESOLVED' ELSE 'MATERIAL' END END AS severity, CASE WHEN conflict THEN n END AS n_claims FROM x
"""


# ---- participants

RECORDS = """
SELECT o_orderkey AS txn, CASE o_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' "Acme   Corp" ' ELSE 'Target ' || CAST(o_custkey AS VARCHAR(20)) END AS target_name, CASE o_orderkey % 4 WHEN 0 THEN 'CONSORTIUM' WHEN 1 THEN 'PE_PORTFOLIO' ELSE 'STRATEGIC' END AS acquirer_type,
  CASE o_custkey % 4 WHEN 0 THEN 'Big Fund and KKR' WHEN 1 THEN 'Consortium' WHEN 2 THEN 'One Corp' ELSE '' END AS acquirer_name, CASE o_custkey % 3 WHEN 0 THEN 'Alpha Fund, Beta Fund' WHEN 1 THEN 'Solo Fund led by X' ELSE NULL END AS acquirer_sponsor_name,
  CASE o_orderkey % 5 WHEN 0 THEN 'Seller One; Seller Two' WHEN 1 THEN 'Seller, Inc.' ELSE NULL END AS parent_seller_name, CASE WHEN o_orderkey % 6 = 0 THEN 'Sub Inc' END AS acquirer_merger_sub_name
FROM orders
"""
records = _of(RECORDS, "orders")


def _parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "lineitem").where("l_linenumber <= 2").select(c("l_orderkey").alias("txn"), F.when(c("l_suppkey") % 2 == 0, "Parent Co").otherwise("PARENT  co.").alias("name"), F.lit("HIGH").alias("confidence"), F.struct("l_linenumber", "l_partkey").alias("seq")).unionByName(
        view(spark, sf_dir, "lineitem").where("l_linenumber = 3 AND l_suppkey % 3 = 0").select(c("l_orderkey").alias("txn"), F.lit("Other Parent").alias("name"), F.lit("LOW").alias("confidence"), F.struct("l_linenumber", "l_partkey").alias("seq")))


@query
def participant_seats(spark, sf_dir):
    rows = participants.seats(records(spark, sf_dir), _parents(spark, sf_dir))
    return rows.where("name IS NOT NULL AND role <> 'PARENT_ACQUIRER'").select("txn", "name", "side", "role", "group_type", "is_primary", "status", (F.length("participant_id") + F.length("entity_id")).alias("n_ids"))


SQL["participant_seats"] = f"""
WITH r AS (SELECT *, acquirer_type = 'CONSORTIUM' AS joint FROM ({RECORDS})), s AS (
  SELECT txn, CASE WHEN target_name LIKE '%Acme%' THEN 'Acme Corp' ELSE target_name END AS name, 'TARGET' AS side, 'TARGET' AS role, NULL AS group_type, 1 AS is_primary, 'UNREVIEWED' AS status FROM r WHERE target_name IS NOT NULL
  UNION ALL SELECT txn, acquirer_name, 'BUYER', CASE acquirer_type WHEN 'PE_PORTFOLIO' THEN 'BUYER_PLATFORM' ELSE 'ACQUIRER' END, NULL, 1, 'UNREVIEWED' FROM r WHERE NOT joint AND acquirer_name <> ''
  UNION ALL SELECT txn, unnest(['Big Fund', 'KKR']), 'BUYER', 'ACQUIRER', 'CONSORTIUM', NULL, 'UNREVIEWED' FROM r WHERE joint AND acquirer_name = 'Big Fund and KKR' UNION ALL SELECT txn, 'One Corp', 'BUYER', 'ACQUIRER', 'CONSORTIUM', 1, 'UNREVIEWED' FROM r WHERE joint AND acquirer_name = 'One Corp'
  UNION ALL SELECT txn, unnest(['Seller One', 'Seller Two']), 'SELLER', 'PARENT_SELLER', 'SELLER_GROUP', NULL, 'UNREVIEWED' FROM r WHERE parent_seller_name LIKE '%;%' UNION ALL SELECT txn, parent_seller_name, 'SELLER', 'PARENT_SELLER', NULL, NULL, 'UNREVIEWED' FROM r WHERE parent_seller_name LIKE '%Inc.'
  UNION ALL SELECT txn, unnest(['Alpha Fund', 'Beta Fund']), 'BUYER', 'BUYER_SPONSOR', CASE WHEN joint THEN 'CONSORTIUM' ELSE 'INVESTOR_GROUP' END, NULL, 'UNREVIEWED' FROM r WHERE acquirer_sponsor_name LIKE 'Alpha%'
  UNION ALL SELECT txn, acquirer_sponsor_name, 'BUYER', 'BUYER_SPONSOR', CASE WHEN joint THEN 'CONSORTIUM' END, NULL, 'NEEDS_REVIEW' FROM r WHERE acquirer_sponsor_name LIKE 'Solo%' UNION ALL SELECT txn, acquirer_merger_sub_name, 'BUYER', 'MERGER_SUB', NULL, NULL, 'UNREVIEWED' FROM r WHERE acquirer_merger_sub_name IS NOT NULL)
SELECT *, 19 + 20 AS n_ids FROM s
"""


@query
def participant_parents(spark, sf_dir):
    rows = participants.seats(records(spark, sf_dir), _parents(spark, sf_dir)).where("role = 'PARENT_ACQUIRER'")
    return rows.select("txn", participants.entity_name(c("name")).alias("norm"), "status", "confidence", "stage")


SQL["participant_parents"] = """
WITH l AS (SELECT DISTINCT l_orderkey AS txn, 'parent co' AS norm, 'HIGH' AS confidence FROM lineitem WHERE l_linenumber <= 2 UNION SELECT DISTINCT l_orderkey, 'other parent', 'LOW' FROM lineitem WHERE l_linenumber = 3 AND l_suppkey % 3 = 0),
o AS (SELECT l.*, count(*) OVER (PARTITION BY txn) AS n FROM l JOIN orders ON o_orderkey = txn)
SELECT txn, norm, CASE WHEN n > 1 THEN 'NEEDS_REVIEW' ELSE 'UNREVIEWED' END AS status, confidence, 'AGREEMENT_OBSERVATION_BACKFILL' AS stage FROM o
"""


@query
def participant_dry_run(spark, sf_dir):
    planned = participants.plan(records(spark, sf_dir), _parents(spark, sf_dir))
    there = participants.plan(records(spark, sf_dir).where("txn % 3 = 0"), _parents(spark, sf_dir))
    return participants.would_insert(planned, {"transaction_participant_group": there["transaction_participant_group"], "entity": planned["entity"]}).where("`table` IN ('transaction_participant_group', 'entity')").select("table", F.when(c("table") != "entity", c("planned")).alias("planned"), "would_insert")


SQL["participant_dry_run"] = f"""
WITH g AS (SELECT txn, CAST(acquirer_type = 'CONSORTIUM' AS INTEGER) + CAST(coalesce(parent_seller_name LIKE '%;%', FALSE) AS INTEGER) + CAST(coalesce(acquirer_sponsor_name LIKE 'Alpha%' AND acquirer_type <> 'CONSORTIUM', FALSE) AS INTEGER) AS n FROM ({RECORDS}))
SELECT 'transaction_participant_group' AS "table", CAST(sum(n) AS BIGINT) AS planned, CAST(sum(n) FILTER (WHERE txn % 3 <> 0) AS BIGINT) AS would_insert FROM g UNION ALL SELECT 'entity', NULL, 0
"""


@query
def investor_participants(spark, sf_dir):
    rows = view(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("txn"), F.concat(F.lit(" Fund "), c("l_suppkey") % 4, F.lit("  ")).alias("name"), (c("l_returnflag") == "R").alias("is_lead"), F.when(c("l_linestatus") == "F", c("l_linenumber") % 2 == 0).alias("is_new"), F.when(c("l_linenumber") % 3 == 0, F.lit(True)).alias("is_existing"), F.struct("l_linenumber", "l_partkey").alias("seq"))
    return participants.investor_participants(rows).select("txn", "name", "is_lead", "is_new", "is_existing", "n_sources")


SQL["investor_participants"] = """
SELECT l_orderkey AS txn, 'Fund ' || (l_suppkey % 4) AS name, max(CAST(l_returnflag = 'R' AS INTEGER)) AS is_lead, max(CASE WHEN l_linestatus = 'F' THEN CAST(l_linenumber % 2 = 0 AS INTEGER) END) AS is_new, max(CASE WHEN l_linenumber % 3 = 0 THEN 1 END) AS is_existing, count(*) AS n_sources
FROM lineitem GROUP BY l_orderkey, l_suppkey % 4
"""


# ---- checks

CHECKED = """
SELECT o_orderkey AS txn, CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE 'T' END AS target_name, CASE o_custkey % 4 WHEN 0 THEN 'Buyer Group' WHEN 1 THEN 'Buyer' ELSE NULL END AS acquirer_name, CASE WHEN o_custkey % 5 = 0 THEN 'S' END AS parent_seller_name, CAST(NULL AS VARCHAR(5)) AS acquirer_sponsor_name,
  CASE WHEN o_orderkey % 4 = 0 THEN '2023-01-01' END AS closed_date, CASE WHEN o_orderkey % 3 = 0 THEN '2024-01-01' ELSE '2022-01-01' END AS announced_date, CASE o_orderkey % 6 WHEN 0 THEN 'ASSETS' ELSE 'subsidiary' END AS target_type, CASE o_orderkey % 10 WHEN 0 THEN 'ENERGY' WHEN 1 THEN '' END AS asset_type, CASE WHEN o_orderkey % 12 = 0 THEN 1 ELSE 0 END AS old_flag, 1 AS is_current,
  CASE o_custkey % 3 WHEN 0 THEN 'VC_ROUND' ELSE 'ACQUISITION' END AS event, CASE o_orderkey % 3 WHEN 0 THEN 'TRANSACTION_VALUE' ELSE 'ROUND_SIZE' END AS size_basis, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS ev, CASE o_custkey % 4 WHEN 0 THEN 'STATED' WHEN 1 THEN NULL ELSE 'EQUITY_PLUS_NET_DEBT' END AS ev_basis,
  CASE WHEN o_orderkey % 5 <> 0 THEN 7.0 END AS net_debt, CASE WHEN o_custkey % 3 = 0 THEN 'USD' END AS net_debt_currency, CASE WHEN o_custkey % 2 = 0 THEN 'EUR' END AS deal_currency
FROM orders
"""
checked = _of(CHECKED, "orders")


def _seated(spark, sf_dir):
    return view(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("txn"), F.when(c("l_linenumber") == 1, "TARGET").when(c("l_linenumber") == 2, "BUYER").otherwise("SELLER").alias("side"), F.when(c("l_linenumber") == 1, "TARGET").when(c("l_linenumber") == 2, "ACQUIRER").otherwise("PARENT_SELLER").alias("role"), (c("l_returnflag") != "N").cast("int").alias("is_current"))


@query
def qa_participants(spark, sf_dir):
    d, seated = checked(spark, sf_dir), _seated(spark, sf_dir)
    found = quality.missing_seats(d, seated).unionByName(quality.repeated(seated.where("is_current = 1"), "repeated_seat", ["side", "role"]))
    names = view(spark, sf_dir, "customer").select(c("c_custkey").alias("txn"), F.when(c("c_custkey") % 4 == 0, "The Investor Group").when(c("c_custkey") % 4 == 1, "Consortium of Two").otherwise("Acme").alias("name"), F.when(c("c_custkey") % 3 == 0, "acme.com").alias("domain"))
    return found.unionByName(quality.synthetic_entities(names, ["domain"])).groupBy("check").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("txn").alias("n_txn"))


SQL["qa_participants"] = f"""
WITH d AS ({CHECKED}), p AS (SELECT l_orderkey AS txn, least(l_linenumber, 3) AS k FROM lineitem WHERE l_returnflag <> 'N'),
f AS (SELECT 'target_name_without_seat' AS "check", txn FROM d WHERE target_name IS NOT NULL AND txn NOT IN (SELECT txn FROM p WHERE k = 1)
  UNION ALL SELECT CASE WHEN acquirer_name = 'Buyer' THEN 'acquirer_name_without_seat' ELSE 'acquirer_group_label' END, txn FROM d WHERE acquirer_name IS NOT NULL AND txn NOT IN (SELECT txn FROM p WHERE k = 2)
  UNION ALL SELECT 'parent_seller_name_without_seat', txn FROM d WHERE parent_seller_name IS NOT NULL AND txn NOT IN (SELECT txn FROM p WHERE k = 3)
  UNION ALL SELECT 'repeated_seat', txn FROM p GROUP BY txn, k HAVING count(*) > 1 UNION ALL SELECT 'synthetic_group_entity', c_custkey FROM customer WHERE c_custkey % 4 <= 1 AND c_custkey % 3 <> 0)
SELECT "check", count(*) AS n, count(DISTINCT txn) AS n_txn FROM f GROUP BY 1
"""


@query
def qa_records(spark, sf_dir):
    d = checked(spark, sf_dir)
    seen = view(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("txn"), F.when(c("l_linenumber") % 2 == 0, "closed_date").otherwise("target_name").alias("field"), F.when(c("l_suppkey") % 5 == 0, "null").otherwise("x").alias("text"), F.lit(1).alias("is_current"))
    found = quality.record_checks(d, ["old_flag"], ["target_name", "acquirer_name", "parent_seller_name", "closed_date", "announced_date", "target_type", "asset_type", "net_debt"]).unionByName(quality.lost_facts(d, seen, ["closed_date", "target_name"])).unionByName(quality.family_integrity(d))
    return found.groupBy("check").agg(F.count(F.lit(1)).alias("n"), F.min(c("txn").cast("long")).alias("first"))


SQL["qa_records"] = f"""
WITH d AS ({CHECKED}), n AS (SELECT *, CAST(target_name IS NOT NULL AS INTEGER) + CAST(acquirer_name IS NOT NULL AS INTEGER) + CAST(parent_seller_name IS NOT NULL AS INTEGER) + CAST(closed_date IS NOT NULL AS INTEGER) + 2 + CAST(coalesce(asset_type, '') <> '' AS INTEGER) + CAST(net_debt IS NOT NULL AS INTEGER) AS filled FROM d),
l AS (SELECT DISTINCT l_orderkey AS txn, l_linenumber % 2 = 0 AS closed FROM lineitem WHERE l_suppkey % 5 <> 0),
f AS (SELECT 'closed_before_announced' AS "check", txn FROM d WHERE closed_date < announced_date UNION ALL SELECT 'assets_without_type', txn FROM d WHERE target_type = 'ASSETS' AND coalesce(asset_type, '') = '' UNION ALL SELECT 'type_without_assets', txn FROM d WHERE target_type <> 'ASSETS' AND asset_type = 'ENERGY'
  UNION ALL SELECT 'no_target', txn FROM d WHERE target_name IS NULL UNION ALL SELECT 'retired_field', txn FROM d WHERE old_flag = 1 UNION ALL SELECT 'nearly_empty', txn FROM n WHERE filled < 6
  UNION ALL SELECT 'fact_lost', d.txn FROM d JOIN l ON l.txn = d.txn WHERE (closed AND closed_date IS NULL) OR (NOT closed AND target_name IS NULL) UNION ALL SELECT 'funding_sized_by_value', txn FROM d WHERE event = 'VC_ROUND' AND size_basis = 'TRANSACTION_VALUE')
SELECT "check", count(*) AS n, min(txn) AS first FROM f GROUP BY 1
"""


@query
def qa_currency_gap(spark, sf_dir):
    return quality.currency_gap(checked(spark, sf_dir))


SQL["qa_currency_gap"] = f"""
WITH d AS ({CHECKED}), k AS (SELECT *, ev IS NOT NULL AND ev_basis <> 'STATED' AND ev_basis IS NOT NULL AS calc FROM d)
SELECT unnest(['with_ev', 'stated_ev', 'calculated_ev', 'with_net_debt', 'currency_mismatch', 'missing_net_debt_currency', 'at_risk', 'calculated_without_net_debt']) AS name,
  unnest([count(ev), count(*) FILTER (WHERE ev IS NOT NULL AND ev_basis = 'STATED'), count(*) FILTER (WHERE calc), count(net_debt), count(*) FILTER (WHERE net_debt_currency <> deal_currency), count(*) FILTER (WHERE net_debt IS NOT NULL AND net_debt_currency IS NULL),
    count(*) FILTER (WHERE calc AND net_debt IS NOT NULL AND (net_debt_currency IS NULL OR deal_currency IS NULL)), count(*) FILTER (WHERE calc AND net_debt IS NULL)]) AS n FROM k
"""


@query
def qa_trace(spark, sf_dir):
    sources = view(spark, sf_dir, "customer").select(c("c_custkey").alias("source"), c("c_name").alias("url"))
    e = view(spark, sf_dir, "orders").select(c("o_custkey").alias("source"), c("o_orderkey").alias("extraction"), c("o_orderstatus").alias("status"), F.lit("ACQUISITION").alias("event"), F.when(c("o_orderkey") % 3 == 0, c("o_orderkey")).alias("txn"))
    r = view(spark, sf_dir, "orders").select(c("o_orderkey").alias("txn"), (c("o_orderkey") % 2).alias("is_current"))
    return quality.trace(sources, e, r)


SQL["qa_trace"] = """
SELECT c_custkey AS source, c_name AS url, o_orderkey AS extraction, coalesce(o_orderstatus, '(no staging row)') AS status, CASE WHEN o_orderkey IS NOT NULL THEN 'ACQUISITION' END AS event, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS cluster, CASE WHEN o_orderkey % 6 = 3 THEN o_orderkey END AS txn
FROM customer LEFT JOIN orders ON o_custkey = c_custkey
"""


@query
def qa_cardinality(spark, sf_dir):
    e = view(spark, sf_dir, "orders").select(F.when(c("o_orderkey") % 3 == 0, c("o_custkey")).alias("txn"))
    return quality.cardinality(view(spark, sf_dir, "customer").select(c("c_custkey").alias("source")), e, view(spark, sf_dir, "supplier"))


SQL["qa_cardinality"] = """
SELECT 'sources_extractions' AS "check", (SELECT count(*) FROM customer) AS n_left, (SELECT count(*) FROM orders) AS n_right UNION ALL SELECT 'clusters_records', (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey % 3 = 0), (SELECT count(*) FROM supplier)
"""


# ---- scores

@query
def gold_scores(spark, sf_dir):
    gold = view(spark, sf_dir, "orders").select(c("o_custkey").alias("source"), c("o_orderkey").alias("label"), c("o_orderstatus").alias("gold_status"), c("o_totalprice").cast("string").alias("gold_price"), F.when(c("o_orderkey") % 4 == 0, c("o_orderpriority")).alias("gold_note"))
    e = view(spark, sf_dir, "orders").select(c("o_custkey").alias("source"), c("o_orderkey").alias("extraction"), c("o_orderkey").alias("txn"))
    made = view(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0").select(c("o_orderkey").alias("txn"), F.lower("o_orderstatus").alias("made_status"), (c("o_totalprice") * 1.005).cast("string").alias("made_price"), c("o_orderpriority").alias("made_note"))
    pairs = quality.first_match(gold, e, made).select("*", "__r.made_status", "__r.made_price", "__r.made_note")
    return quality.scores(pairs, {"status": ("enum", 0.4), "price": ("numeric", 0.9)}, {"note": "date"})


SQL["gold_scores"] = """
WITH m AS (SELECT o_custkey AS s, arg_min(o_orderstatus, o_orderkey) AS st, arg_min(o_totalprice, o_orderkey) AS p, arg_min(o_orderpriority, o_orderkey) AS nt FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1),
j AS (SELECT o.*, st, p, nt FROM orders o JOIN m ON s = o_custkey), k AS (
  SELECT 'status' AS field, CAST(o_orderstatus = st AS INTEGER) AS ok FROM j UNION ALL SELECT 'price', CAST(CASE WHEN o_totalprice = 0 THEN p = 0 ELSE abs(o_totalprice - CAST(p AS DOUBLE) * 1.005) / abs(o_totalprice) <= 0.01 END AS INTEGER) FROM j UNION ALL SELECT 'note', CAST(upper(o_orderpriority) = upper(nt) AS INTEGER) FROM j WHERE o_orderkey % 4 = 0),
f AS (SELECT field, count(ok) AS n, CAST(sum(ok) AS BIGINT) AS correct, round(avg(ok), 6) AS precision FROM k GROUP BY 1)
SELECT *, CAST(CASE field WHEN 'status' THEN precision >= 0.4 WHEN 'price' THEN precision >= 0.9 END AS INTEGER) AS passed FROM f
"""


@query
def approved_remediation(spark, sf_dir):
    rows = view(spark, sf_dir, "customer").select(c("c_custkey").alias("txn"), F.when(c("c_custkey") % 3 == 0, "VC_ROUND").otherwise("ACQUISITION").alias("event"), F.when(c("c_custkey") % 4 == 0, "Acme Inc").when(c("c_custkey") % 4 == 1, "Beta Robotics").when(c("c_custkey") % 4 == 2, "Gamma").otherwise("Other").alias("target"), F.when(c("c_custkey") % 8 < 4, 100.0).otherwise(90.0).alias("staged"), F.when(c("c_custkey") % 5 == 0, 1.0).alias("round_size"))
    approvals = spark.createDataFrame([("acme", 100.0, 100.0, None, 1), ("Beta", 100.0, 327.0, "a cheque, not the round", 2)], "key string, staged double, round_size double, note string, seq int")
    unresolved = spark.createDataFrame([("gamma", "sources differ", 1)], "key string, reason string, seq int")
    return quality.remediation(rows, approvals, unresolved, ["VC_ROUND"])


SQL["approved_remediation"] = """
SELECT c_custkey AS txn, CASE c_custkey % 4 WHEN 0 THEN 'Acme Inc' WHEN 1 THEN 'Beta Robotics' WHEN 2 THEN 'Gamma' ELSE 'Other' END AS target, CASE WHEN c_custkey % 8 < 4 THEN 100.0 ELSE 90.0 END::DOUBLE AS staged,
  CASE c_custkey % 4 WHEN 2 THEN 'unresolved' WHEN 3 THEN 'not_approved' ELSE CASE WHEN c_custkey % 8 < 4 THEN 'planned' ELSE 'staged_changed' END END AS state,
  CASE WHEN c_custkey % 8 = 0 THEN 100.0 WHEN c_custkey % 8 = 1 THEN 327.0 END::DOUBLE AS canonical, CASE c_custkey % 4 WHEN 1 THEN 'a cheque, not the round' WHEN 2 THEN 'sources differ' END AS note FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 5 <> 0
"""


@query
def review_sheets(spark, sf_dir):
    li = view(spark, sf_dir, "lineitem")
    a = li.select(c("l_orderkey").alias("txn"), F.concat(F.lit("Bank "), c("l_suppkey") % 3).alias("name"), F.when(c("l_suppkey") % 2 == 0, "legal").alias("specialty"), F.when(c("l_linenumber") % 3 == 0, "buy_side").when(c("l_linenumber") % 3 == 1, "SELL_SIDE").alias("side"), F.struct("l_linenumber", "l_partkey").alias("seq"))
    i = li.select(c("l_orderkey").alias("txn"), F.concat(F.lit("Fund "), c("l_suppkey") % 3).alias("name"), F.lit("vc").alias("type"), (c("l_returnflag") == "R").cast("int").alias("is_lead"), c("l_linenumber").cast("int").alias("rank"), F.when(c("l_linenumber") % 2 == 0, c("l_quantity")).alias("amount"), F.lit("USD").alias("currency"), c("l_partkey").alias("seq"))
    s = li.select(c("l_orderkey").alias("txn"), F.concat(F.lit("u"), c("l_suppkey") % 2).alias("url"), F.struct("l_linenumber", "l_partkey").alias("seq"))
    sheets = quality.review_sheets(checked(spark, sf_dir).select("txn", "event"), a, i, s, view(spark, sf_dir, "customer").select(c("c_custkey").alias("source"), c("c_name").alias("url"), c("c_mktsegment").alias("title"), F.lit("x").alias("reason")))
    return sheets["fundings"].select("txn", "buy_side", "sell_side", "unassigned", "urls", "n_sources", "investors", "leads", "amounts")


_LIST = "(SELECT txn, {0} AS v, {1} AS o FROM ({2}) WHERE {0} IS NOT NULL)"


def _listed(value: str, order: str, rows: str) -> str:
    """txn, s: distinct values in first-seen order."""
    return f"(SELECT txn, string_agg(v, ' | ' ORDER BY o, v) AS s FROM (SELECT txn, v, min(o) AS o FROM {_LIST.format(value, order, rows)} GROUP BY txn, v) GROUP BY txn)"


_LINES = "SELECT l_orderkey AS txn, l_linenumber, l_partkey, 'Bank ' || (l_suppkey % 3) || CASE WHEN l_suppkey % 2 = 0 THEN ' (legal)' ELSE '' END AS bank, CASE l_linenumber % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'S' ELSE 'U' END AS side, 'u' || (l_suppkey % 2) AS url, 'Fund ' || (l_suppkey % 3) AS fund, l_returnflag = 'R' AS lead, l_quantity FROM lineitem"
_SEQ, _RANKED = "{'a': l_linenumber, 'b': l_partkey}", "{'l': CASE WHEN lead THEN 0 ELSE 1 END, 'r': l_linenumber, 's': l_partkey}"
SQL["review_sheets"] = f"""
SELECT d.txn, coalesce(b.s, '') AS buy_side, coalesce(e.s, '') AS sell_side, coalesce(u.s, '') AS unassigned, coalesce(w.s, '') AS urls, coalesce(n.n, 0) AS n_sources, coalesce(i.s, '') AS investors, coalesce(l.s, '') AS leads, coalesce(m.s, '') AS amounts FROM ({CHECKED}) d
LEFT JOIN {_listed("CASE WHEN side = 'B' THEN bank END", _SEQ, _LINES)} b ON b.txn = d.txn LEFT JOIN {_listed("CASE WHEN side = 'S' THEN bank END", _SEQ, _LINES)} e ON e.txn = d.txn LEFT JOIN {_listed("CASE WHEN side = 'U' THEN bank END", _SEQ, _LINES)} u ON u.txn = d.txn
LEFT JOIN {_listed("url", _SEQ, _LINES)} w ON w.txn = d.txn LEFT JOIN (SELECT l_orderkey AS txn, count(DISTINCT l_suppkey % 2) AS n FROM lineitem GROUP BY 1) n ON n.txn = d.txn LEFT JOIN {_listed("fund || ' (vc)'", _RANKED, _LINES)} i ON i.txn = d.txn
LEFT JOIN {_listed("CASE WHEN lead THEN fund END", _RANKED, _LINES)} l ON l.txn = d.txn LEFT JOIN {_listed("CASE WHEN l_linenumber % 2 = 0 THEN fund || ': ' || CAST(CAST(l_quantity AS DECIMAL(38,2)) AS VARCHAR) || ' USD' END", _RANKED, _LINES)} m ON m.txn = d.txn
WHERE d.event = 'VC_ROUND'
"""


# ---- predicates, orders, joins

@query
def status_predicates(spark, sf_dir):
    o = view(spark, sf_dir, "orders")
    v2, old = F.when(c("o_orderkey") % 3 == 0, "VC_ROUND").when(c("o_orderkey") % 3 == 1, "ACQUISITION"), F.when(c("o_custkey") % 3 == 0, "VC_ROUND").when(c("o_custkey") % 3 == 1, "MERGER")
    kind = F.coalesce(v2, old)
    notes = F.concat(F.lit('{"source":"'), c("o_custkey") % 10, F.lit('","n":'), c("o_orderkey"), F.lit("}"))
    branch = F.when(kind.isin("VC_ROUND"), "funding").when(~kind.isin("VC_ROUND"), "deal")
    rows = o.select("o_orderkey", branch.alias("branch"), F.get_json_object(notes, "$.source").try_cast("bigint").alias("source"), F.lower("o_orderpriority").like("%urgent%").alias("urgent"), ((F.trim("o_orderstatus") != "") & (v2.isNotNull() | kind.isin("VC_ROUND"))).alias("eligible"))
    return rows.where(c("branch").isNotNull()).groupBy("branch", "source").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(c("urgent"), 1)).alias("urgent"), F.count(F.when(c("eligible"), 1)).alias("eligible"))


SQL["status_predicates"] = """
WITH a AS (SELECT *, coalesce(CASE o_orderkey % 3 WHEN 0 THEN 'VC_ROUND' WHEN 1 THEN 'ACQUISITION' END, CASE o_custkey % 3 WHEN 0 THEN 'VC_ROUND' WHEN 1 THEN 'MERGER' END) AS kind FROM orders)
SELECT CASE WHEN kind = 'VC_ROUND' THEN 'funding' ELSE 'deal' END AS branch, CAST(o_custkey % 10 AS BIGINT) AS source, count(*) AS n, count(*) FILTER (WHERE lower(o_orderpriority) LIKE '%urgent%') AS urgent, count(*) FILTER (WHERE o_orderkey % 3 <> 2 OR kind = 'VC_ROUND') AS eligible FROM a WHERE kind IS NOT NULL GROUP BY 1, 2
"""


@query
def presentation_order(spark, sf_dir):
    li = view(spark, sf_dir, "lineitem")
    order = [c("l_returnflag").desc(), c("l_linestatus").asc_nulls_last(), c("l_quantity").desc_nulls_last(), c("l_linenumber"), c("l_partkey"), c("l_suppkey")]
    from pyspark.sql import Window
    return li.select("l_orderkey", "l_linenumber", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)).alias("position"))


SQL["presentation_order"] = "SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag DESC, l_linestatus ASC NULLS LAST, l_quantity DESC NULLS LAST, l_linenumber, l_partkey, l_suppkey) AS INTEGER) AS position FROM lineitem"


@query
def ledger_inputs(spark, sf_dir):
    obs = claims_ledger(spark, sf_dir).select(c("txn").alias("extraction"), "tier", "confidence", "price", c("source").alias("s"))
    rows = ledger.inputs(obs, staged(spark, sf_dir), view(spark, sf_dir, "supplier").select(c("s_suppkey").alias("source"), F.lit("T3").alias("tier"), F.lit("2024-02-02").alias("published")), writers.READY)
    return rows.groupBy("txn", "tier", "confidence", "published").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("total"))


SQL["ledger_inputs"] = f"""
WITH s AS ({STAGED}), l AS ({LEDGER})
SELECT s.txn, coalesce(l.tier, 'T3') AS tier, coalesce(l.confidence, 'MEDIUM') AS confidence, CASE WHEN s_suppkey IS NOT NULL THEN '2024-02-02' END AS published, count(*) AS n, round(sum(price), 2) AS total
FROM l JOIN s ON s.extraction = l.txn LEFT JOIN supplier ON s_suppkey = s.source WHERE s.status IN {_in(writers.READY)} GROUP BY 1, 2, 3, 4
"""


@query
def bare_group(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return relational.any_row(o, ["o_custkey"], "o_orderkey")


SQL["bare_group"] = "SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus, arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey"


@query
def top_first_seen(spark, sf_dir):
    rows = view(spark, sf_dir, "conversations").select(F.concat_ws(":", "role", F.col("conv_id") % 7).alias("key"), (c("conv_id") * 1000 + c("turn")).alias("seq"))
    return relational.top_seen(rows, "key", "seq", 5)


SQL["top_first_seen"] = """
SELECT key, n FROM (SELECT role || ':' || (conv_id % 7) AS key, count(*) AS n, min(conv_id * 1000 + turn) AS first FROM conversations GROUP BY 1) ORDER BY n DESC, first LIMIT 5
"""


@query
def review_sample(spark, sf_dir):
    d = view(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return relational.review_sample(d, "doc_id", "source", thin=25, first=[("long", c("n_chars") > 3000, 10)], catch_all=[("src0", 8)], floor=3, target=60, share=0.18, least=22)


SQL["review_sample"] = """
WITH d AS (SELECT doc_id, source, n_chars, sha256(CAST(doc_id AS VARCHAR)) AS h, count(*) OVER (PARTITION BY source) AS k FROM documents),
s1 AS (SELECT doc_id, '1:long' AS stratum FROM (SELECT *, row_number() OVER (ORDER BY h) AS r FROM d WHERE n_chars > 3000) WHERE r <= 10),
l1 AS (SELECT * FROM d WHERE doc_id NOT IN (SELECT doc_id FROM s1)), s2 AS (SELECT doc_id, '2:census:' || source AS stratum FROM l1 WHERE k <= 25 AND source <> 'src0'),
l2 AS (SELECT * FROM l1 WHERE doc_id NOT IN (SELECT doc_id FROM s2)), s3 AS (SELECT doc_id, '3:catch_all:src0' AS stratum FROM (SELECT *, row_number() OVER (ORDER BY h) AS r FROM l2 WHERE source = 'src0') WHERE r <= 8),
l3 AS (SELECT * FROM l2 WHERE doc_id NOT IN (SELECT doc_id FROM s3)), s4 AS (SELECT doc_id, '4:floor:' || source AS stratum FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h) AS r FROM l3 WHERE source <> 'src0' AND k > 25) WHERE r <= 3),
l4 AS (SELECT * FROM l3 WHERE doc_id NOT IN (SELECT doc_id FROM s4)), t AS (SELECT sum(k) AS total FROM (SELECT DISTINCT source, k FROM d WHERE k > 25 AND source <> 'src0')),
s5 AS (SELECT doc_id, '5:reserve:' || source AS stratum FROM (SELECT l4.*, row_number() OVER (PARTITION BY source ORDER BY h) AS r FROM l4 WHERE source <> 'src0' AND k > 25), t WHERE r <= greatest(3, round_even(22 * k / total, 0)))
SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3 UNION ALL SELECT * FROM s4 UNION ALL SELECT * FROM s5
"""


@query
def column_roles(spark, sf_dir):
    p = relational.full_profile(view(spark, sf_dir, "pages").select("page_id", "url", "html"), ["page_id", "url", "html"])
    return relational.column_roles(p).select("role", "column", "position")


SQL["column_roles"] = f"""
WITH p AS ({SQL["profile_pages"]}), s AS (
  SELECT 'id' AS role, "column", distinct_ratio * 2 + CASE WHEN "column" = 'page_id' THEN 1.5 ELSE 0 END + CASE WHEN fill_pct = 100 THEN 0.5 ELSE 0 END - CASE WHEN p50 > 120 THEN 3 ELSE 0 END AS x FROM p
  UNION ALL SELECT 'title', "column", CASE WHEN p50 BETWEEN 20 AND 250 THEN 1 ELSE 0 END + CASE WHEN distinct_ratio > 0.5 THEN 0.5 ELSE 0 END - CASE WHEN url_pct > 20 THEN 2 ELSE 0 END FROM p
  UNION ALL SELECT 'body', "column", CASE WHEN p50 > 400 THEN 2 WHEN p50 > 200 THEN 1 ELSE 0 END FROM p UNION ALL SELECT 'url', "column", url_pct / 50 + CASE WHEN "column" = 'url' THEN 0.5 ELSE 0 END FROM p UNION ALL SELECT 'date', "column", date_pct / 50 FROM p)
SELECT role, "column", CAST(row_number() OVER (PARTITION BY role ORDER BY round(x, 2) DESC, "column") AS INTEGER) AS position FROM s WHERE round(x, 2) > 0
"""


@query
def duplicate_profile(spark, sf_dir):
    p = view(spark, sf_dir, "pages").select("page_id", "url", F.concat(c("url"), F.lit("x")).alias("title"), "html")
    return relational.duplicates(p, {"id": "page_id", "url": "url", "title": "title"}, "html")


SQL["duplicate_profile"] = """
WITH k AS (SELECT unnest(['id', 'url', 'title', 'body_exact']) AS role, unnest([CAST(page_id AS VARCHAR), nullif(lower(trim(url)), ''), nullif(lower(trim(url || 'x')), ''), CASE WHEN trim(html) <> '' THEN sha256(lower(trim(regexp_replace(html, '[\\x20\\x09-\\x0D]+', ' ', 'g')))) END]) AS v FROM pages), g AS (SELECT role, v, count(*) AS n FROM k WHERE v IS NOT NULL GROUP BY 1, 2)
SELECT role, CAST(sum(n) AS BIGINT) AS n_values, count(*) AS n_distinct, count(*) FILTER (WHERE n > 1) AS repeated, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_repeats FROM g GROUP BY role
"""


# ---- more of the ledger

def _anchored_sql(amount: str) -> str:
    body = SQL["anchor_qualifiers"].replace("price AS value", f"{amount} AS value").replace("l.price = a.value", f"l.{amount} = a.value")
    return f"({body})"


@query
def anchor_shared(spark, sf_dir):
    keep = ["txn", "source", "tier", "confidence", "seq"]
    rows = dealt(claims_ledger(spark, sf_dir).select(*keep, "price", "quantity", "currency"), "txn")  # before a claim becomes three
    told = [F.struct(F.lit(f).alias("field"), c(f).alias("value"), F.lit(None).cast("string").alias("text")) for f in ("price", "quantity")]
    told.append(F.struct(F.lit("currency").alias("field"), F.lit(None).cast("double").alias("value"), c("currency").alias("text")))
    return ledger.anchored_qualifiers(rows.select(*keep, F.inline(F.array(*told))), ["price", "quantity"], "currency")


SQL["anchor_shared"] = f"""
SELECT p.txn, p.currency AS price_currency, q.currency AS quantity_currency, CASE WHEN p.currency = q.currency THEN p.currency END AS currency FROM {_anchored_sql("price")} p JOIN {_anchored_sql("quantity")} q ON q.txn = p.txn
"""


@query
def ledger_history(spark, sf_dir):
    rows = claims_ledger(spark, sf_dir).select(c("part").alias("txn"), F.lit("quantity").alias("field"), c("quantity").cast("int").cast("string").alias("text"), "filed", c("source").alias("document"))
    return ledger.histories(rows, view(spark, sf_dir, "supplier").where("s_suppkey % 3 > 0").select(c("s_suppkey").alias("document"), c("s_name").alias("title")), ["1"])


SQL["ledger_history"] = f"""
WITH l AS (SELECT DISTINCT part AS txn, filed, source, CAST(CAST(quantity AS INTEGER) AS VARCHAR) AS text, s_name FROM ({LEDGER}) LEFT JOIN supplier ON s_suppkey = source AND s_suppkey % 3 > 0 WHERE quantity <> 1)
SELECT txn, 'quantity' AS field, '[' || string_agg('{{"filed":"' || filed || '","document":' || source || ',"value":"' || text || '","title":' || coalesce('"' || s_name || '"', 'null') || '}}', ',' ORDER BY filed, source, text) || ']' AS history FROM l GROUP BY txn HAVING count(DISTINCT text) > 1
"""


@query
def resolve_json(spark, sf_dir):
    from factmill.functions.vocab import canonical_json
    text = F.when(c("part") % 2 == 0, F.concat(F.lit('{"b": 1, "a": '), c("source") % 2, F.lit("}"))).otherwise(F.concat(F.lit('{"a":'), c("source") % 2, F.lit(',"b":1}')))
    rows = claims_ledger(spark, sf_dir).withColumn("doc", canonical_json(text)).withColumn("field", F.lit("doc"))
    when = F.when(c("part") % 4 == 0, "2024-02-30").otherwise(c("filed"))
    won = ledger.resolved(rows, ["txn"], value="doc")
    days = rows.groupBy("txn").agg(F.max(ledger.decoded(when, F.lit(None).cast("double"), "date")).cast("string").alias("last_day"), F.count(ledger.decoded(F.when(c("part") % 3 == 0, F.substring(text, 1, 5)).otherwise(text), F.lit(None).cast("double"), "json")).alias("n_json"))
    return won.select("txn", "doc", "flagged").join(days, "txn")


SQL["resolve_json"] = f"""
WITH ledger AS ({LEDGER}), {_resolve("SELECT txn, tier, confidence, seq, '{' || chr(34) || 'a' || chr(34) || ':' || (source % 2) || ',' || chr(34) || 'b' || chr(34) || ':1}' AS value FROM ledger", 'txn')},
d AS (SELECT txn, CAST(max(CASE WHEN part % 4 <> 0 THEN CAST(filed AS DATE) END) AS VARCHAR) AS last_day, count(*) FILTER (WHERE part % 3 <> 0) AS n_json FROM ledger GROUP BY txn)
SELECT a.txn, a.value AS doc, flagged, last_day, n_json FROM answers a JOIN d ON d.txn = a.txn
"""


@query
def export_joined(spark, sf_dir):
    labels = view(spark, sf_dir, "labels")
    current = lambda rule, col, name: labels.where(rule).select(c("doc_id").alias("__d"), c(col).alias(name))
    d = view(spark, sf_dir, "documents").select("doc_id", "source")
    out = d.join(current("quality = 1", "quality", "summary"), c("doc_id") == c("__d"), "left").drop("__d")
    return out.join(current("toxic = 1", "toxic", "rationale"), c("doc_id") == c("__d"), "left").drop("__d")


SQL["export_joined"] = "SELECT d.doc_id, source, a.quality AS summary, b.toxic AS rationale FROM documents d LEFT JOIN labels a ON a.doc_id = d.doc_id AND a.quality = 1 LEFT JOIN labels b ON b.doc_id = d.doc_id AND b.toxic = 1"


# ---- clusters

TOLD = """
SELECT c_custkey AS extraction, CASE c_custkey % 3 WHEN 0 THEN 'VC_ROUND' ELSE 'ACQUISITION' END AS event,
  CASE c_custkey % 8 WHEN 0 THEN 'acme robotics ' WHEN 1 THEN 'acme robotic ' WHEN 2 THEN 'zenith labs ' WHEN 3 THEN 'zenith lab ' WHEN 4 THEN 'nova systems europe ' WHEN 5 THEN 'nova ' WHEN 6 THEN 'orbit foods ' ELSE NULL END || substr(md5(CAST(c_nationkey % 12 AS VARCHAR(9))), 1, 8) AS target,
  CASE c_custkey % 5 WHEN 0 THEN 'big buyer' WHEN 1 THEN 'big buyers' WHEN 2 THEN 'other fund' WHEN 3 THEN 'other fund two' ELSE NULL END AS acquirer,
  CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'soon' ELSE '2024-0' || CAST(1 + c_custkey % 6 AS VARCHAR(9)) || '-1' || CAST(c_custkey % 9 AS VARCHAR(9)) END AS day, CASE c_custkey % 2 WHEN 0 THEN 'exact' ELSE 'month' END AS precision,
  CASE c_custkey % 4 WHEN 0 THEN 'Series A' WHEN 1 THEN 'seed' ELSE NULL END AS round_label, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE floor(abs(c_acctbal)) + 1 END AS round_size, CASE WHEN c_custkey % 10 = 0 THEN 'tc_old' END AS cluster
FROM customer
"""
told = _of(TOLD, "customer")


@query
def cluster_deals(spark, sf_dir):
    rows = told(spark, sf_dir)
    return cluster.clustered(rows.withColumn("target", F.concat(F.lit("The "), F.initcap("target"), F.lit(", Inc."))).withColumn("acquirer", F.concat("acquirer", F.lit(" LLC"))))


def _common(a: str, b: str) -> str:
    """Length of the longest common subsequence, row by row."""
    line = f"list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j]), lambda acc, j: list_append(acc, CASE WHEN {a}[i[1]] = {b}[j[1]] THEN row[j[1]] + 1 ELSE greatest(row[j[1] + 1], acc[-1]) END), [0::BIGINT])"
    return f"list_reduce(list_transform(range(1, length({a}) + 1), lambda i: [i]), lambda row, i: {line}, list_transform(range(0, length({b}) + 1), lambda x: 0::BIGINT))[-1]"


def _alike(names: str) -> str:
    """like(a, b): pairs of distinct names (column name of ``names``) that score 90 or more, both ways, and each with itself."""
    return f"""
  w AS (SELECT DISTINCT name, list_sort(list_distinct(list_filter(string_split(name, ' '), lambda x: x <> ''))) AS w FROM ({names}) WHERE coalesce(name, '') <> ''),
  p AS (SELECT a.name AS a, b.name AS b, list_sort(list_filter(a.w, lambda x: list_contains(b.w, x))) AS s, list_sort(list_filter(a.w, lambda x: NOT list_contains(b.w, x))) AS da, list_sort(list_filter(b.w, lambda x: NOT list_contains(a.w, x))) AS db FROM w a JOIN w b ON a.name < b.name),
  o AS (SELECT *, array_to_string(s, ' ') AS sh, array_to_string(list_concat(s, da), ' ') AS x, array_to_string(list_concat(s, db), ' ') AS y FROM p),
  scored AS (SELECT a, b, CASE WHEN len(s) > 0 AND (len(da) = 0 OR len(db) = 0) THEN 100 ELSE greatest(200.0 * ({_common("x", "y")}) / (length(x) + length(y)), CASE WHEN len(s) > 0 THEN 200.0 * length(sh) / (length(sh) + least(length(x), length(y))) ELSE 0 END) END AS score FROM o),
  alike AS (SELECT a, b FROM scored WHERE score >= 90 UNION ALL SELECT b, a FROM scored WHERE score >= 90 UNION ALL SELECT name, name FROM w)"""


SQL["cluster_fuzzy"] = f"""
WITH RECURSIVE t AS (SELECT lower(p_name) AS name, p_partkey FROM part UNION ALL SELECT lower(p_name) || 's', p_partkey FROM part WHERE p_partkey % 5 = 0), {_alike("SELECT name FROM t")},
reach(a, b) AS (SELECT a, b FROM alike UNION SELECT r.a, e.b FROM reach r JOIN alike e ON r.b = e.a), l AS (SELECT a AS name, min(b) AS cluster FROM reach GROUP BY a),
own AS (SELECT name, min(p_partkey) AS first_part, count(*) AS n FROM t GROUP BY name)
SELECT cluster, count(*) AS n_names, CAST(sum(n) AS BIGINT) AS n_rows, min(first_part) AS first_part, 'tc_' || sha256(string_agg(own.name, '|' ORDER BY own.name) || '|ext_' || min(first_part))[1:12] AS cluster_id FROM own JOIN l ON l.name = own.name GROUP BY cluster
"""
SQL["cluster_deals"] = f"""
WITH RECURSIVE d AS (SELECT extraction AS id, event = 'VC_ROUND' AS f, target, coalesce(acquirer, '') AS acquirer, day, TRY_CAST(day AS DATE) AS at, precision = 'exact' AS exact, CASE round_label WHEN 'Series A' THEN 'a' WHEN 'seed' THEN 's' END AS stage, round_size FROM ({TOLD})
  WHERE cluster IS NULL AND target IS NOT NULL AND (acquirer IS NOT NULL OR event = 'VC_ROUND')), {_alike("SELECT target AS name FROM d UNION SELECT acquirer FROM d")},
m AS (SELECT x.id AS a, y.id AS b FROM d x JOIN alike t ON t.a = x.target JOIN d y ON y.target = t.b AND x.id < y.id AND x.f = y.f LEFT JOIN alike q ON q.a = x.acquirer AND q.b = y.acquirer
  WHERE CASE WHEN x.f THEN NOT (coalesce(x.exact AND y.exact AND abs(x.at - y.at) > 30, FALSE) OR coalesce(x.stage <> y.stage, FALSE) OR coalesce(abs(x.round_size - y.round_size) / greatest(x.round_size, y.round_size) > 0.15, FALSE))
    ELSE q.a IS NOT NULL AND CASE WHEN x.day IS NOT NULL AND y.day IS NOT NULL THEN coalesce(abs(x.at - y.at) <= 3, FALSE) ELSE TRUE END END),
e AS (SELECT a, b FROM m UNION ALL SELECT b, a FROM m), reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a), l AS (SELECT id, least(id, coalesce(min(b), id)) AS label FROM d LEFT JOIN reach ON a = id GROUP BY id),
n AS (SELECT DISTINCT label, unnest([target, nullif(acquirer, '')]) AS name FROM d JOIN l ON l.id = d.id), k AS (SELECT label, string_agg(name, '|' ORDER BY name) AS names FROM n WHERE name IS NOT NULL GROUP BY label),
g AS (SELECT label, min(day) AS first, min(d.id) AS least, count(*) AS n_members FROM d JOIN l ON l.id = d.id GROUP BY label)
SELECT l.id AS extraction, 'tc_' || sha256(names || '|' || coalesce(first, 'ext_' || least))[1:12] AS cluster_id, n_members FROM l JOIN g ON g.label = l.label JOIN k ON k.label = l.label
"""
