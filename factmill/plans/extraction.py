"""Queries over extraction answers and news, with their SQL beside them.

The answers and texts are templated from the tables in SQL that Spark and DuckDB read alike. Where an
answer is JSON the SQL reads it with JSON functions of its own; where a text is templated the SQL
tells what each template must give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.functions import extracted, scanners, signals, vocab
from factmill.plans.domain import view
from factmill.plans.oracles import SQL
from factmill.plans.queries import query

c = F.col


def _of(sql: str, table: str, key: str | None = None):
    """The SQL's rows. With a ``key``, which must tell rows apart, they are dealt first: a small file is one task's, however long its texts take."""
    def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        plain = sql.replace("{", "{{").replace("}", "}}")
        own = view(spark, sf_dir, table)
        own = own.repartition(4 * spark.sparkContext.defaultParallelism, key) if key else own
        return spark.sql(plain.replace(f"FROM {table}", f"FROM {{{table}}}"), **{table: own})

    return rows


def _in(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


# ---- classifications

CLASSIFIED = """
SELECT o_orderkey AS id,
  '{"v2_event_type":' || CASE o_orderkey % 8 WHEN 0 THEN '"ACQUISITION"' WHEN 1 THEN '"MERGER"' WHEN 2 THEN 'null' WHEN 3 THEN '"RECAPITALIZATION"' WHEN 4 THEN '"SPIN_OFF"' WHEN 5 THEN '"ACQUISITION"' ELSE 'null' END
  || ',"deal_type":' || CASE o_custkey % 5 WHEN 0 THEN '"SPIN_SPLIT"' WHEN 1 THEN '"ACQUISITION"' WHEN 2 THEN 'null' WHEN 3 THEN '"VC_ROUND"' ELSE CASE WHEN o_orderkey % 9 = 0 THEN '"ODD"' ELSE 'null' END END
  || ',"distribution_mechanism":' || CASE WHEN o_custkey % 5 = 0 AND o_orderkey % 3 = 0 THEN '"EXCHANGE_OFFER"' WHEN o_orderkey % 31 = 0 THEN '"PRO_RATA"' ELSE 'null' END
  || ',"event_history_type":' || CASE o_custkey % 4 WHEN 0 THEN '"ANNOUNCED"' WHEN 1 THEN 'null' WHEN 2 THEN '"CLOSE"' ELSE '"CLOSED"' END
  || ',"event_type":' || CASE o_orderkey % 4 WHEN 0 THEN '"CLOSE"' WHEN 1 THEN '"AMENDED"' WHEN 2 THEN 'null' ELSE '"ANNOUNCED"' END
  || ',"target_status":' || CASE WHEN o_custkey % 17 = 0 THEN 'null' ELSE '"PUBLIC"' END
  || ',"recap_type":' || CASE o_orderkey % 11 WHEN 0 THEN '"DIVIDEND"' WHEN 1 THEN '"ODD"' ELSE 'null' END
  || ',"combination_structure":' || CASE o_orderkey % 16 WHEN 0 THEN '"MERGER"' WHEN 5 THEN '"ODD"' WHEN 3 THEN '"DE_SPAC"' ELSE 'null' END
  || ',"target_type":' || CASE o_custkey % 13 WHEN 0 THEN '"ASSETS"' WHEN 1 THEN '"spinco"' ELSE '"subsidiary"' END || CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE '}' END AS answer,
  CASE o_custkey % 3 WHEN 0 THEN 'SPLIT' WHEN 1 THEN 'SPIN_OFF' ELSE NULL END AS spin
FROM orders
"""
classified = _of(CLASSIFIED, "orders")


@query
def classification_rejects(spark, sf_dir):
    return extracted.judged(classified(spark, sf_dir), {"reason": ("answer", extracted.classification_rules)}).select("id", "reason", extracted.spin_type(c("spin")).alias("spin"))


SQL["classification_rejects"] = f"""
WITH a AS (SELECT id, spin, TRY_CAST(answer AS JSON) AS j FROM ({CLASSIFIED})),
f AS (SELECT id, spin, j, j->>'$.v2_event_type' AS e, j->>'$.deal_type' AS d, j->>'$.distribution_mechanism' AS m, j->>'$.event_history_type' AS h, j->>'$.event_type' AS o, j->>'$.target_status' AS s,
  j->>'$.recap_type' AS r, j->>'$.combination_structure' AS k, j->>'$.target_type' AS t FROM a),
g AS (SELECT *, CASE WHEN e IN {_in(extracted.EVENT_TYPES)} THEN e WHEN d = 'SPIN_SPLIT' THEN CASE WHEN m = 'EXCHANGE_OFFER' THEN 'SPLIT_OFF' ELSE 'SPIN_OFF' END WHEN d IN {_in(extracted.EVENT_TYPES)} THEN d ELSE e END AS x FROM f)
SELECT id, CASE WHEN j IS NULL THEN 'not_json' WHEN e NOT IN {_in(extracted.EVENT_TYPES)} THEN 'event_type' WHEN d NOT IN {_in([*extracted.EVENT_TYPES, 'SPIN_SPLIT'])} THEN 'deal_type'
  WHEN x IS NULL AND d IS NULL THEN 'no_event' WHEN NOT coalesce(h IN {_in(extracted.HISTORIES)}, FALSE) AND NOT coalesce(o IN {_in(extracted.HISTORIES + extracted.LEGACY_HISTORIES)}, FALSE) THEN 'history'
  WHEN s IS NULL THEN 'target_status' WHEN CASE WHEN x = 'RECAPITALIZATION' THEN r NOT IN {_in(extracted.RECAPS)} ELSE r IS NOT NULL END THEN 'recap_type'
  WHEN NOT (coalesce(x IN ('SPIN_OFF', 'SPLIT_OFF'), FALSE) OR coalesce(d = 'SPIN_SPLIT', FALSE)) AND m IS NOT NULL THEN 'spin_fields'
  WHEN k IS NOT NULL AND NOT (coalesce(x = 'ACQUISITION', FALSE) AND k IN {_in(extracted.COMBINATIONS)}) THEN 'combination' WHEN t NOT IN {_in(extracted.TARGET_KINDS)} THEN 'target_type' END AS reason,
  CASE spin WHEN 'SPLIT' THEN 'SPLIT_OFF' ELSE spin END AS spin FROM g
"""


# ---- deals

ANSWERED = """
SELECT o_orderkey AS id, CASE o_custkey % 3 WHEN 0 THEN 'assets' ELSE 'subsidiary' END AS target_type, CASE o_orderkey % 3 WHEN 0 THEN 'JOINT_VENTURE' ELSE 'ACQUISITION' END AS event,
  '{"target":{"asset_type":' || CASE o_orderkey % 14 WHEN 0 THEN '"ODD"' WHEN 1 THEN '"ENERGY"' ELSE 'null' END || '},"acquirer":{},"parent_seller":{},'
  || '"dates":{"announced_date_precision":' || CASE o_custkey % 15 WHEN 0 THEN '"day"' WHEN 1 THEN '"month"' ELSE 'null' END || '},'
  || '"value":{"type":' || CASE o_orderkey % 10 WHEN 0 THEN '"MARKET_CAPITALIZATION"' WHEN 1 THEN '"ODD"' WHEN 2 THEN 'null' ELSE '"EQUITY_VALUE"' END || ',"amount":' || CAST(o_custkey AS VARCHAR(20)) || ',"currency":"USD","per_share_price":' || CASE WHEN o_orderkey % 2 = 0 THEN '2.5' ELSE 'null' END || '},'
  || CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE '"target_financials":{},' END
  || '"value_observations":' || CASE o_custkey % 11 WHEN 0 THEN '{}' WHEN 1 THEN '[1]' WHEN 2 THEN '[{"amount":5,"odd":1}]' WHEN 3 THEN '[{"type":"ODD"}]' WHEN 4 THEN '[]'
       WHEN 5 THEN '[{"type":"MARKET_CAPITALIZATION","amount":9},{"type":"EQUITY_VALUE","amount":' || CAST(o_custkey AS VARCHAR(20)) || ',"currency":"EUR","qualifier":"about"}]'
       ELSE '[{"amount":null,"type":null},{"type":"TRANSACTION_VALUE","amount":7.5,"basis":"approximately"}]' END || ','
  || '"features":' || CASE o_orderkey % 23 WHEN 0 THEN '[]' WHEN 1 THEN '{"is_secondary_buyout":"yes"}' WHEN 2 THEN '{"is_going_private_outcome":true}' ELSE '{"is_going_private_outcome":false}' END || ','
  || '"acquirers":' || CASE o_custkey % 7 WHEN 0 THEN '"x"' WHEN 1 THEN '["Plain Name",{"name":" "},{"type":"spac"}]' WHEN 2 THEN '[{"name":"Acme","type":"PRIVATE_EQUITY"},{"name":"Beta","type":"consortium"}]' WHEN 3 THEN '[{"name":" Gamma ","type":"odd"},7]' ELSE '[]' END || ','
  || '"jv_partners":' || CASE o_orderkey % 4 WHEN 0 THEN '["One",{"name":"Two"}]' ELSE '[]' END || ','
  || '"buy_side_sponsors":[],"parent_sellers":[],"parent_acquirers":[],"sell_side_sponsors":[],"sellers":[],'
  || '"reported_multiples":' || CASE o_custkey % 6 WHEN 0 THEN 'null' WHEN 1 THEN '[{"multiple_type":"EV_EBITDA","multiple_value":11.5,"period_basis":"LTM","period_end_date":"2024","as_reported_text":"11.5x"},{"multiple_type":"PE","multiple_value":"7"}]'
       WHEN 2 THEN '[{"multiple_type":"PE","multiple_value":8,"period_basis":"ODD"},{"multiple_type":"EV_SALES","multiple_value":2},{"multiple_type":"PB","multiple_value":0},{"multiple_type":"PB","multiple_value":true}]' ELSE '[]' END || ','
  || '"model_confidence":"HIGH","deal":{"stake_transition_type":' || CASE o_orderkey % 19 WHEN 0 THEN '"ODD"' ELSE 'null' END || ',"offer_mechanism":' || CASE o_orderkey % 21 WHEN 0 THEN '"SCHEME"' WHEN 1 THEN '"TENDER_OFFER"' ELSE 'null' END || '},'
  || '"financials_disclosure_status":' || CASE o_orderkey % 29 WHEN 0 THEN 'null' ELSE '"DISCLOSED"' END || ',"transaction_terms_disclosure_status":' || CASE o_custkey % 31 WHEN 0 THEN '"maybe"' ELSE '"UNKNOWN"' END || '}' AS answer
FROM orders
"""
answered = _of(ANSWERED, "orders")


@query
def deal_rejects(spark, sf_dir):
    return extracted.judged(answered(spark, sf_dir), {"reason": ("answer", extracted.deal_rules)}).select("id", "reason")


_ITEMS = "CASE WHEN json_type(j, '$.{0}') = 'ARRAY' THEN CAST(json_extract(j, '$.{0}') AS JSON[]) ELSE [] END"
SQL["deal_rejects"] = f"""
WITH a AS (SELECT id, TRY_CAST(answer AS JSON) AS j FROM ({ANSWERED})), v AS (SELECT *, {_ITEMS.format('value_observations')} AS o FROM a)
SELECT id, CASE WHEN NOT list_has_all(json_keys(j), {extracted.DEAL_KEYS}) THEN 'missing' WHEN j->>'$.value.type' NOT IN {_in(extracted.VALUE_TYPES)} THEN 'value_type'
  WHEN json_type(j, '$.value_observations') <> 'ARRAY' THEN 'value_list' WHEN len(list_filter(o, lambda x: json_type(x) <> 'OBJECT')) > 0 THEN 'value_item'
  WHEN len(list_filter(o, lambda x: NOT list_has_all({extracted.VALUE_KEYS}, json_keys(x)))) > 0 THEN 'value_keys' WHEN len(list_filter(o, lambda x: (x->>'$.type') NOT IN {_in(extracted.VALUE_TYPES)})) > 0 THEN 'value_item_type'
  WHEN json_type(j, '$.acquirers') <> 'ARRAY' OR json_type(j, '$.jv_partners') <> 'ARRAY' THEN 'party_list' WHEN json_type(j, '$.reported_multiples') <> 'ARRAY' THEN 'multiple_list'
  WHEN json_type(j, '$.features') <> 'OBJECT' THEN 'features' WHEN json_type(j, '$.features.is_secondary_buyout') = 'VARCHAR' THEN 'feature_flag'
  WHEN j->>'$.financials_disclosure_status' IS NULL THEN 'financials_disclosure' WHEN j->>'$.transaction_terms_disclosure_status' = 'maybe' THEN 'terms_disclosure'
  WHEN j->>'$.deal.stake_transition_type' IS NOT NULL THEN 'transition' WHEN j->>'$.deal.offer_mechanism' = 'SCHEME' THEN 'offer' WHEN j->>'$.target.asset_type' = 'ODD' THEN 'asset_type'
  WHEN j->>'$.dates.announced_date_precision' = 'day' THEN 'date_precision' END AS reason FROM v
"""


@query
def deal_parties(spark, sf_dir):
    names = lambda p: F.array_join(F.transform(p, lambda x: F.concat(x["name"], F.lit(":"), F.coalesce(x["type"], F.lit("-")))), "|")
    return answered(spark, sf_dir).select("id", names(extracted.parties(c("answer"), "acquirers")).alias("buyers"), names(extracted.parties(c("answer"), "jv_partners")).alias("partners"))


SQL["deal_parties"] = f"""
SELECT id, CASE WHEN contains(answer, 'Plain Name') THEN 'Plain Name:-' WHEN contains(answer, 'Acme') THEN 'Acme:private_equity|Beta:unknown' WHEN contains(answer, 'Gamma') THEN 'Gamma:-' ELSE '' END AS buyers,
  CASE WHEN contains(answer, '"One"') THEN 'One:-|Two:-' ELSE '' END AS partners FROM ({ANSWERED})
"""


@query
def deal_multiples_cleaned(spark, sf_dir):
    rows = answered(spark, sf_dir).select("id", F.explode(extracted.stated_multiples(c("answer"))).alias("m"))
    return rows.select("id", "m.*")


SQL["deal_multiples_cleaned"] = f"""
WITH a AS (SELECT id, unnest({_ITEMS.format('reported_multiples')}) AS m FROM (SELECT id, CAST(answer AS JSON) AS j FROM ({ANSWERED})))
SELECT id, m->>'$.multiple_type' AS multiple_type, CAST(m->>'$.multiple_value' AS DOUBLE) AS multiple_value, CASE WHEN m->>'$.period_basis' IN {_in(extracted.MULTIPLE_PERIODS)} THEN m->>'$.period_basis' END AS period_basis,
  m->>'$.period_end_date' AS period_end_date, CASE WHEN (m->>'$.multiple_type') LIKE 'EV_%' THEN 'implied_enterprise_value' ELSE 'implied_equity_value' END AS numerator_value_type, m->>'$.as_reported_text' AS as_reported_text
FROM a WHERE m->>'$.multiple_type' IN {_in(extracted.MULTIPLE_TYPES)} AND json_type(m, '$.multiple_value') NOT IN ('VARCHAR', 'BOOLEAN') AND CAST(m->>'$.multiple_value' AS DOUBLE) > 0
"""


@query
def deal_values_cleaned(spark, sf_dir):
    d = answered(spark, sf_dir).select("id", extracted.value_observations(c("answer")).alias("v"), extracted.primary_value(c("answer")).alias("p"))
    return d.select("id", F.size("v").cast("long").alias("n_values"), F.array_join(F.transform("v", lambda x: F.coalesce(x["type"], F.lit("-"))), "|").alias("types"), c("p.amount").alias("amount"), c("p.currency").alias("currency"), c("p.type").alias("type"), c("p.qualifier").alias("qualifier"), c("p.per_share_price").alias("per_share_price"))


SQL["deal_values_cleaned"] = f"""
WITH a AS (SELECT id, CAST(answer AS JSON) AS j FROM ({ANSWERED})), o AS (SELECT id, j, list_filter({_ITEMS.format('value_observations')}, lambda x: json_type(x) = 'OBJECT' AND coalesce(x->>'$.type', '') <> 'MARKET_CAPITALIZATION') AS every FROM a),
k AS (SELECT *, list_filter(every, lambda x: x->>'$.amount' IS NOT NULL OR x->>'$.type' IS NOT NULL) AS kept, every[1] AS one, coalesce(j->>'$.value.type', '') = 'MARKET_CAPITALIZATION' AS retired FROM o)
SELECT id, len(kept) AS n_values, coalesce(array_to_string(list_transform(kept, lambda x: coalesce(x->>'$.type', '-')), '|'), '') AS types,
  CASE WHEN one IS NOT NULL THEN CAST(one->>'$.amount' AS DOUBLE) WHEN NOT retired THEN CAST(j->>'$.value.amount' AS DOUBLE) END AS amount,
  CASE WHEN one IS NOT NULL THEN one->>'$.currency' WHEN NOT retired THEN j->>'$.value.currency' END AS currency, CASE WHEN one IS NOT NULL THEN one->>'$.type' WHEN NOT retired THEN j->>'$.value.type' END AS type,
  one->>'$.qualifier' AS qualifier, CAST(j->>'$.value.per_share_price' AS DOUBLE) AS per_share_price FROM k
"""


@query
def deal_subordinate(spark, sf_dir):
    d = answered(spark, sf_dir)
    return d.select("id", extracted.subordinate(c("answer"), c("target_type"), c("event")).alias("s")).select("id", "s.asset_type", F.array_join("s.jv_partners", "|").alias("partners"), "s.private_outcome")


SQL["deal_subordinate"] = f"""
SELECT id, CASE WHEN target_type = 'assets' THEN j->>'$.target.asset_type' END AS asset_type, CASE WHEN event = 'JOINT_VENTURE' AND contains(answer, '"One"') THEN 'One|Two' ELSE '' END AS partners,
  CASE WHEN j->>'$.features.is_going_private_outcome' = 'true' THEN 1 END AS private_outcome FROM (SELECT *, CAST(answer AS JSON) AS j FROM ({ANSWERED}))
"""


# ---- fundings, terms, rationales

TERMS = """
SELECT c_custkey AS id,
  '{"company":{},"investors":' || CASE c_custkey % 9 WHEN 0 THEN '{}' WHEN 1 THEN '[{"investor_type":"odd"}]' ELSE '[{"investor_type":"vc_firm"},{}]' END || ',"round":{"round_price_direction":' || CASE c_custkey % 8 WHEN 0 THEN '"SIDEWAYS"' WHEN 1 THEN '"UP"' ELSE 'null' END
  || '},"dates":{},"financials_disclosure_status":' || CASE c_custkey % 7 WHEN 0 THEN 'null' ELSE '"UNKNOWN"' END || ',"transaction_terms_disclosure_status":"DISCLOSED"' || CASE c_custkey % 10 WHEN 0 THEN '' ELSE ',"model_confidence":"LOW"' END || '}' AS funding,
  '{"advisors":' || CASE c_custkey % 6 WHEN 0 THEN '{}' WHEN 1 THEN '[{"name":" Bank ","advisor_specialty":"financial_advisory","advised_side":"BUY_SIDE","advised_party":"TARGET"},{"name":""},3]'
       WHEN 2 THEN '[{"name":"Law","specialty":"legal","advised_side":"MIDDLE"},{"name":"Odd","specialty":"cooking","type":"LEGAL"},{"name":"Tax","advisor_specialty":"tax","advised_party_name":" Acme "}]' ELSE '[]' END
  || ',"financing_providers":' || CASE c_custkey % 4 WHEN 0 THEN '["First Bank",{"name":"Second"},{"name":null}]' ELSE 'null' END
  || ',"consideration_components":' || CASE c_custkey % 11 WHEN 0 THEN '[{"form":"EARN_OUT"}]' WHEN 1 THEN '[1]' WHEN 2 THEN '"x"' ELSE '[{"form":"CASH"}]' END
  || ',"flags":{"deal_attitude":' || CASE c_custkey % 13 WHEN 0 THEN '"COLD"' ELSE '"FRIENDLY"' END || ',"approach_type":' || CASE c_custkey % 17 WHEN 0 THEN '"LOUD"' ELSE 'null' END || '},"go_shop":' || CASE c_custkey % 5 WHEN 0 THEN '{"has_go_shop":false,"go_shop_period_days":30}' WHEN 1 THEN '{"has_go_shop":true,"go_shop_period_days":30}' ELSE 'null' END
  || ',"termination_fees":{}' || CASE c_custkey % 19 WHEN 0 THEN '' ELSE ',"model_confidence":"LOW"' END || '}' AS terms,
  '{"rationale":' || CASE c_custkey % 5 WHEN 0 THEN '"OTHER"' WHEN 1 THEN '"odd"' ELSE '"TALENT_ACQUISITION"' END || ',"secondary_rationales":' || CASE c_custkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN '"x"' WHEN 2 THEN '["OTHER","odd","TALENT_ACQUISITION","GEOGRAPHIC_EXPANSION","VERTICAL_INTEGRATION"]' ELSE '[]' END
  || ',"supporting_excerpt_index":1,"model_confidence":"HIGH"' || CASE c_custkey % 23 WHEN 0 THEN '' ELSE ',"notes":null' END || '}' AS rationale,
  CASE c_custkey % 6 WHEN 0 THEN 'Consortium' WHEN 1 THEN 'a group led by KKR' WHEN 2 THEN 'Investor Group' WHEN 3 THEN 'The Carlyle Group' WHEN 4 THEN ' buyer group ' ELSE NULL END AS party
FROM customer
"""
terms = _of(TERMS, "customer")


@query
def funding_and_terms_rejects(spark, sf_dir):
    rows = terms(spark, sf_dir).withColumnsRenamed({"funding": "funding_answer", "terms": "terms_answer"})
    rows = extracted.judged(rows, {"funding": ("funding_answer", extracted.funding_rules), "terms": ("terms_answer", extracted.terms_rules)})
    return rows.select("id", "funding", "terms", extracted.is_group_label(c("party")).cast("int").alias("group_label"))


SQL["funding_and_terms_rejects"] = f"""
WITH a AS (SELECT id, party, CAST(funding AS JSON) AS f, CAST(terms AS JSON) AS t FROM ({TERMS}))
SELECT id, CASE WHEN NOT list_has_all(json_keys(f), {extracted.FUNDING_KEYS}) THEN 'missing' WHEN f->>'$.financials_disclosure_status' IS NULL THEN 'financials_disclosure' WHEN json_type(f, '$.investors') <> 'ARRAY' THEN 'investor_list'
    WHEN f->>'$.investors[0].investor_type' = 'odd' THEN 'investor_type' WHEN f->>'$.round.round_price_direction' = 'SIDEWAYS' THEN 'price_direction' END AS funding,
  CASE WHEN NOT list_has_all(json_keys(t), {extracted.TERMS_KEYS}) THEN 'missing' WHEN json_type(t, '$.advisors') <> 'ARRAY' THEN 'advisor_list' WHEN json_type(t, '$.consideration_components') <> 'ARRAY' THEN 'component_list'
    WHEN json_type(t, '$.consideration_components[0]') <> 'OBJECT' THEN 'component' WHEN t->>'$.consideration_components[0].form' = 'EARN_OUT' THEN 'form' WHEN t->>'$.go_shop.has_go_shop' = 'false' THEN 'go_shop'
    WHEN t->>'$.flags.deal_attitude' = 'COLD' THEN 'attitude' WHEN t->>'$.flags.approach_type' = 'LOUD' THEN 'approach' END AS terms,
  CAST(coalesce(party IN ('Consortium', 'a group led by KKR', 'Investor Group', ' buyer group '), FALSE) AS INTEGER) AS group_label FROM a
"""


@query
def advisor_participations(spark, sf_dir):
    rows = terms(spark, sf_dir).select("id", F.array_join(extracted.providers(c("terms")), "|").alias("providers"), F.explode_outer(extracted.advisors(c("terms"))).alias("a"))
    return rows.select("id", "providers", "a.*")


_NOTHING = "NULL::VARCHAR"
SQL["advisor_participations"] = f"""
WITH a AS (SELECT id, id % 6 AS k, CASE WHEN id % 4 = 0 THEN 'First Bank|Second' ELSE '' END AS providers FROM ({TERMS}))
SELECT id, providers, 'Bank' AS name, 'FINANCIAL' AS type, 'TARGET' AS advised_party, 'financial_advisory' AS specialty, {_NOTHING} AS advised_party_name, 'BUY_SIDE' AS advised_side FROM a WHERE k = 1
UNION ALL SELECT id, providers, 'Law', 'LEGAL', 'UNKNOWN', 'legal', NULL, NULL FROM a WHERE k = 2 UNION ALL SELECT id, providers, 'Odd', 'LEGAL', 'UNKNOWN', NULL, NULL, NULL FROM a WHERE k = 2
UNION ALL SELECT id, providers, 'Tax', 'OTHER', 'UNKNOWN', 'tax', 'Acme', NULL FROM a WHERE k = 2 UNION ALL SELECT id, providers, NULL, NULL, NULL, NULL, NULL, NULL FROM a WHERE k NOT IN (1, 2)
"""


@query
def rationale_tags(spark, sf_dir):
    d = terms(spark, sf_dir).select("id", extracted.rationale(c("rationale")).alias("r"))
    return d.select("id", "r.reason", "r.rationale", F.array_join("r.secondary", "|").alias("secondary"))


SQL["rationale_tags"] = f"""
WITH a AS (SELECT id, CASE WHEN id % 23 = 0 THEN 'missing' WHEN id % 5 = 1 THEN 'rationale' WHEN id % 4 = 1 THEN 'secondary_list' END AS reason FROM ({TERMS}))
SELECT id, reason, CASE WHEN reason IS NULL THEN CASE WHEN id % 5 = 0 THEN 'OTHER' ELSE 'TALENT_ACQUISITION' END END AS rationale,
  CASE WHEN reason IS NULL THEN CASE WHEN id % 4 <> 2 THEN '' WHEN id % 5 = 0 THEN 'TALENT_ACQUISITION|GEOGRAPHIC_EXPANSION' ELSE 'OTHER|GEOGRAPHIC_EXPANSION' END END AS secondary FROM a
"""


# ---- news

NEWS = """
SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'ACQUISITION' ELSE 'PIPE' END AS event, 'Acme Robotics' AS target, 'Big Buyer' AS acquirer, 'News of the day' AS title,
  CASE c_custkey % 12 WHEN 0 THEN 'Acme raised $' || CAST(c_custkey AS VARCHAR(20)) || ' million in Series B funding at a $3.2 billion post-money valuation. It is done.'
    WHEN 1 THEN 'The company raised more than $' || CAST(c_custkey AS VARCHAR(20)) || ' million. More text.' WHEN 2 THEN 'It has raised approximately $' || CAST(c_custkey AS VARCHAR(20)) || 'k in seed funding.'
    WHEN 3 THEN 'Fund One manages $' || CAST(c_custkey AS VARCHAR(20)) || ' billion. Nothing else.' WHEN 4 THEN 'Secured a credit facility of $' || CAST(c_custkey AS VARCHAR(20)) || ' million.' WHEN 5 THEN 'No amount was told.'
    WHEN 6 THEN 'Lead made a $50 million investment in the Series D, bringing the total Series D to $' || CAST(c_custkey AS VARCHAR(20)) || ' million.' WHEN 7 THEN 'Bringing its total to $' || CAST(c_custkey AS VARCHAR(20)) || ' million since launch.'
    WHEN 8 THEN 'Fund Two committed $' || CAST(c_custkey AS VARCHAR(20)) || ' million and invested $9 million in Acme.' WHEN 9 THEN 'It closed a $' || CAST(c_custkey AS VARCHAR(20)) || ' million PIPE with new holders.'
    WHEN 10 THEN 'A private investment in public equity was agreed. Reportedly raised over $' || CAST(c_custkey AS VARCHAR(20)) || ' million.' ELSE 'PIPE welding news: sold tools for $' || CAST(c_custkey AS VARCHAR(20)) || '.' END
  || CASE c_custkey % 5 WHEN 0 THEN ' Acme Robotics (NYSE: ACME) said so.' WHEN 1 THEN ' It files with the SEC and trades common stock.' WHEN 2 THEN ' Big Buyer (Nasdaq: BIG) said so.' ELSE '' END AS body,
  CASE c_custkey % 4 WHEN 0 THEN 'ANNOUNCEMENT' WHEN 1 THEN 'CLOSE' WHEN 2 THEN 'AMENDMENT' ELSE NULL END AS kind,
  CASE c_custkey % 6 WHEN 0 THEN '8.01,1.01' WHEN 1 THEN '8.01' WHEN 2 THEN '2.01' WHEN 3 THEN '9.01' ELSE '1.02,2.01,8.01' END AS items,
  CASE c_custkey % 5 WHEN 0 THEN 'EX-99.1' WHEN 1 THEN 'EX-99.2 Investor Presentation' WHEN 2 THEN 'EX-99.1 Press Release' WHEN 3 THEN 'EX-99.3' ELSE NULL END AS label
FROM customer
"""
news = _of(NEWS, "customer")


@query
def round_amounts(spark, sf_dir):
    return news(spark, sf_dir).select("id", signals.round_amount(c("title"), c("body")).alias("r")).select("id", "r.*")


SQL["round_amounts"] = f"""
SELECT id, CASE id % 12 WHEN 0 THEN 'ROUND_SIZE_CANDIDATE' WHEN 1 THEN 'LOWER_BOUND_NORMALIZED' WHEN 2 THEN 'NON_EXACT_AMOUNT' WHEN 3 THEN 'NOT_ROUND_INVESTOR_SCOPE' WHEN 4 THEN 'NOT_ROUND_FACILITY' WHEN 5 THEN 'NO_AMOUNT_DISCLOSED' WHEN 6 THEN 'ROUND_SIZE_CANDIDATE'
    WHEN 7 THEN 'NOT_ROUND_CUMULATIVE' WHEN 8 THEN 'INVESTOR_CHECK_ONLY' WHEN 9 THEN 'ROUND_SIZE_CANDIDATE' WHEN 10 THEN 'NON_EXACT_AMOUNT' ELSE 'AMBIGUOUS' END AS classification,
  CASE id % 12 WHEN 2 THEN id * 1e3 WHEN 3 THEN id * 1e9 WHEN 5 THEN NULL WHEN 8 THEN 9e6 WHEN 11 THEN id * 1e0 ELSE id * 1e6 END AS amount,
  CASE id % 12 WHEN 1 THEN 'more than' WHEN 2 THEN 'approximately' WHEN 10 THEN 'over' END AS qualifier, CASE id % 12 WHEN 1 THEN 'ANCHOR' WHEN 2 THEN 'DEFERRED' WHEN 10 THEN 'DEFERRED' END AS normalization FROM ({NEWS})
"""


@query
def money_mentions(spark, sf_dir):
    d = news(spark, sf_dir).select("id", signals.money_mentions(F.concat(c("body"), F.when(c("id") % 2 == 0, " or about £2,500 thousand").otherwise(" or €7"))).alias("m"), scanners.source_character(F.when(c("id") % 3 == 0, " original_reporting ").when(c("id") % 3 == 1, "odd")).alias("character"))
    return d.select("id", F.size("m").cast("long").alias("n"), F.get("m", 0)["qualifier"].alias("first_qualifier"), F.element_at("m", -1)["qualifier"].alias("qualifier"), F.element_at("m", -1)["currency"].alias("currency"), F.element_at("m", -1)["amount"].alias("amount"), "character")


SQL["money_mentions"] = f"""
SELECT id, CASE WHEN id % 12 IN (0, 6, 8) THEN 3 WHEN id % 12 = 5 THEN 1 ELSE 2 END AS n, CASE id % 12 WHEN 1 THEN 'more than' WHEN 2 THEN 'approximately' WHEN 10 THEN 'over' END AS first_qualifier, CASE WHEN id % 2 = 0 THEN 'about' END AS qualifier,
  CASE WHEN id % 2 = 0 THEN 'GBP' ELSE 'EUR' END AS currency, CASE WHEN id % 2 = 0 THEN 2500000 ELSE 7 END::DOUBLE AS amount, CASE WHEN id % 3 = 0 THEN 'ORIGINAL_REPORTING' ELSE 'UNKNOWN' END AS character FROM ({NEWS})
"""


@query
def structure_routing(spark, sf_dir):
    return news(spark, sf_dir).select("id", signals.routed(c("event"), c("title"), c("body")).alias("r")).select("id", "r.event", "r.status", "r.form", c("r.corroborated").cast("int").alias("corroborated"))


SQL["structure_routing"] = f"""
WITH a AS (SELECT id, event AS own, CASE id % 12 WHEN 9 THEN 'ACRONYM' WHEN 10 THEN 'EXPANDED' END AS said FROM ({NEWS})), b AS (SELECT *, own = 'PIPE' OR (own = 'UNKNOWN' AND said IS NOT NULL) AS out FROM a)
SELECT id, CASE WHEN out THEN 'PIPE' ELSE own END AS event, CASE WHEN out THEN 'RECOGNIZED_NOT_PROFILED' ELSE 'CLASSIFIED' END AS status, CASE WHEN own = 'PIPE' THEN 'CLASSIFIER' WHEN out THEN said END AS form, CASE WHEN out THEN CAST(said IS NOT NULL AS INTEGER) END AS corroborated FROM b
"""


@query
def public_parties(spark, sf_dir):
    rows = news(spark, sf_dir)
    found = signals.public_party(c("body"), c("target"), c("acquirer"))
    item = signals.best_item(F.split("items", ","), c("kind"))
    return rows.select("id", found.alias("p"), item.alias("item"), signals.press_exhibit(c("label"), c("body")).alias("exhibit")).select("id", "p.signal", "p.side", "p.ticker", "item", "exhibit")


SQL["public_parties"] = f"""
SELECT id, CASE id % 5 WHEN 0 THEN 'NYSE:ACME near entity name' WHEN 1 THEN 'SEC language: ''files with the SEC''; public boilerplate: ''common stock''' WHEN 2 THEN 'NASDAQ:BIG near entity name' END AS signal,
  CASE id % 5 WHEN 0 THEN 'TARGET' WHEN 1 THEN 'BOTH' WHEN 2 THEN 'ACQUIRER' END AS side, CASE id % 5 WHEN 0 THEN 'ACME' WHEN 2 THEN 'BIG' END AS ticker,
  CASE kind WHEN 'CLOSE' THEN CASE WHEN contains(items, '2.01') THEN '2.01' WHEN contains(items, '8.01') THEN '8.01' END WHEN 'AMENDMENT' THEN CASE WHEN contains(items, '1.01') THEN '1.01' WHEN contains(items, '2.01') THEN '2.01' WHEN contains(items, '8.01') THEN '8.01' END
    ELSE CASE WHEN contains(items, '1.01') THEN '1.01' WHEN contains(items, '8.01') THEN '8.01' END END AS item,
  CASE WHEN id % 5 = 1 THEN 'INVESTOR_PRESENTATION' WHEN id % 5 = 2 THEN 'PRESS_RELEASE' ELSE 'OTHER' END AS exhibit FROM ({NEWS})
"""


# ---- pages

MARKED = """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://news.BusinessWire.com/a?b=1' WHEN 1 THEN 'https://prnewswire.com/x' WHEN 2 THEN 'https://notprnewswire.com/x' ELSE url END AS url,
  CASE page_id % 5 WHEN 0 THEN '<html><head><meta property="og:title" content="A title"><META name="author" content="Me"><meta name="robots" content="x"><script type="application/ld+json">{"a":1}</script><script type="application/ld+json">broken{</script></head>' ELSE '' END || html AS html,
  CASE page_id % 9 WHEN 0 THEN 403 ELSE 200 END AS status
FROM pages
"""
marked = _of(MARKED, "pages")


@query
def page_signals(spark, sf_dir):
    p = marked(spark, sf_dir)
    meta = signals.metadata(c("html"))
    return p.select("page_id", F.array_join(signals.site_rules(c("url")), "|").alias("rules"), signals.wall(c("html"), c("status")).alias("wall"), F.element_at(meta, "og:title").alias("og_title"), F.element_at(meta, "author").alias("author"), F.array_join(signals.linked_data(c("html")), "|").alias("linked"))


_WALLS = " ".join(f"WHEN contains(lower(substring(html, 1, 8000)), '{m}') THEN 'marker: {m}'" for m in signals.WALL_MARKERS)
_HINTS = " OR ".join(f"contains(lower(html), '{m}')" for m in signals.STRUCTURE_HINTS)
SQL["page_signals"] = f"""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN '.bw-release-story|[itemprop=''articleBody'']' WHEN 1 THEN '.release-body|.col-lg-10 .release-body' ELSE '' END AS rules,
  CASE WHEN status = 403 THEN 'status 403' WHEN coalesce(html, '') = '' THEN 'empty body' {_WALLS} WHEN NOT ({_HINTS}) AND length(html) < 3000 THEN 'no article structure and only ' || length(html) || ' bytes' END AS wall,
  CASE WHEN page_id % 5 = 0 THEN 'A title' ELSE nullif(regexp_extract(html, '(?i)<meta[^>]+(?:property|name)=["'']og:title["''][^>]+content=["'']([^"'']*)["'']', 1), '') END AS og_title,
  CASE WHEN page_id % 5 = 0 THEN 'Me' ELSE nullif(regexp_extract(html, '(?i)<meta[^>]+(?:property|name)=["'']author["''][^>]+content=["'']([^"'']*)["'']', 1), '') END AS author,
  CASE WHEN page_id % 5 = 0 THEN '{{"a":1}}' ELSE '' END AS linked FROM ({MARKED})
"""


@query
def best_texts(spark, sf_dir):
    d = view(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    pick = lambda name, part: F.struct(F.lit(name).alias("extractor"), part.alias("text"))
    cut = F.array(pick("first", F.substring("text", 1, 300)), pick("half", F.expr("substring(text, 1, length(text) div 6)")), pick("again", F.substring("text", 2, 300)))
    return d.where("text IS NOT NULL").select("doc_id", signals.best_text(cut, c("text")).alias("b")).select("doc_id", "b.extractor", F.length("b.text").cast("long").alias("n"), c("b.suspect").cast("int").alias("suspect"))


SQL["best_texts"] = """
WITH a AS (SELECT doc_id, length(text) AS n, least(length(text), 300) AS f, length(text) // 6 AS h FROM documents WHERE text IS NOT NULL),
b AS (SELECT *, CASE WHEN greatest(f, h) <= 200 THEN 'none' WHEN f >= h THEN 'first' ELSE 'half' END AS best FROM a)
SELECT doc_id, CASE best WHEN 'none' THEN CASE WHEN n > 0 THEN 'raw_body' END ELSE best END AS extractor, CASE best WHEN 'none' THEN nullif(n, 0) WHEN 'first' THEN f ELSE h END AS n,
  CAST(CASE best WHEN 'none' THEN TRUE WHEN 'first' THEN n * 0.2 > f ELSE n * 0.2 > h END AS INTEGER) AS suspect FROM b
"""


@query
def keyword_scan(spark, sf_dir):
    d = view(spark, sf_dir, "conversations")
    text = F.when(c("conv_id") % 3 == 0, F.concat(c("text"), F.lit(" with Total Debt of 5"))).when(c("conv_id") % 5 == 0, F.concat(c("text"), F.lit(" raises money"))).otherwise(c("text"))
    rows = d.withColumn("text", text).where("text IS NOT NULL")
    hit, deal = (c("text").rlike(signals.as_sql_reads(p)) for p in (signals.BALANCE_SHEET, signals.DEAL_HEADLINE))
    return rows.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(hit, 1)).alias("candidates"), F.count(F.when(deal, 1)).alias("deal_language"), F.coalesce(F.sum(F.when(hit, F.floor(F.length("text") / 4))), F.lit(0)).alias("tokens"))


SQL["keyword_scan"] = f"""
WITH a AS (SELECT role, CASE WHEN conv_id % 3 = 0 THEN text || ' with Total Debt of 5' WHEN conv_id % 5 = 0 THEN text || ' raises money' ELSE text END AS text FROM conversations WHERE text IS NOT NULL),
b AS (SELECT *, regexp_matches(text, '{signals.BALANCE_SHEET}') AS hit, regexp_matches(text, '{signals.DEAL_HEADLINE}') AS deal FROM a)
SELECT role, count(*) AS n, count(*) FILTER (WHERE hit) AS candidates, count(*) FILTER (WHERE deal) AS deal_language, CAST(coalesce(sum(length(text) // 4) FILTER (WHERE hit), 0) AS BIGINT) AS tokens FROM b GROUP BY role
"""


# ---- agreements

AGREED = """
SELECT c_custkey AS id, chr(10) AS nl,
  'AGREEMENT AND PLAN OF MERGER' || chr(10) || 'dated as of March 3, 2024 between the parties.' || chr(10) || 'WHEREAS, number ' || CAST(c_custkey AS VARCHAR(20)) || '; NOW, THEREFORE, agreed.' || chr(10)
  || 'ARTICLE I' || chr(10) || 'DEFINITIONS' || chr(10) || '"Exchange Ratio" means one for two.' || chr(10)
  || 'ARTICLE II' || chr(10) || CASE c_custkey % 3 WHEN 0 THEN 'MERGER CONSIDERATION' || chr(10) || 'Cash is paid.' WHEN 1 THEN 'THE MERGER' || chr(10) || 'Section 2.01 Closing. Later.' || chr(10) || 'Section 2.02 Merger Consideration. By the Exchange Ratio.' ELSE 'OTHER MATTERS' || chr(10) || 'None.' END || chr(10)
  || 'ARTICLE III' || chr(10) || 'TERMINATION' || chr(10) || CASE c_custkey % 2 WHEN 0 THEN 'Section 3.01 Effect of Termination. A fee.' || chr(10) ELSE 'Plain words.' || chr(10) END
  || 'ARTICLE IV' || chr(10) || 'REPRESENTATIONS AND WARRANTIES OF THE COMPANY' || chr(10) || 'Section 4.01 Capitalization. Ten shares.' || chr(10) || 'Section 4.02 Other. End.' || chr(10) AS body
FROM customer
"""
agreed = _of(AGREED, "customer", "c_custkey")


@query
def agreement_sections(spark, sf_dir):
    rows = scanners.sections(agreed(spark, sf_dir), "id", "body", by_article=True)
    return rows.select("id", "section_type", "heading", "start", F.col("end").alias("stop"), F.length("excerpt").cast("long").alias("n"))


SQL["agreement_sections"] = f"""
WITH a AS (SELECT id, body, strpos(body, 'ARTICLE I' || nl) - 1 AS a1, strpos(body, 'ARTICLE II' || nl) - 1 AS a2, strpos(body, 'ARTICLE III') - 1 AS a3, strpos(body, 'ARTICLE IV') - 1 AS a4, strpos(body, 'dated as of') - 1 AS d,
  strpos(body, 'Section 2.02') - 1 AS s2, strpos(body, 'Section 3.01') - 1 AS s3, strpos(body, 'Section 4.01') - 1 AS s4, strpos(body, 'Section 4.02') - 1 AS s5 FROM ({AGREED})),
r AS (
  SELECT id, 'RECITALS' AS section_type, 'RECITALS' AS heading, d AS start, a1 AS stop, a1 - d AS n FROM a
  UNION ALL SELECT id, 'CONSIDERATION', 'MERGER CONSIDERATION', a2, a3, a3 - a2 FROM a WHERE id % 3 = 0
  UNION ALL SELECT id, 'CONSIDERATION', 'Merger Consideration', s2, a3, length('[Merger Consideration]') + 1 + (a3 - s2 - 1) + 2 + length('[Definition: "Exchange Ratio"]') + 1 + length('"Exchange Ratio" means one for two.') FROM a WHERE id % 3 = 1
  UNION ALL SELECT id, 'TERMINATION_FEES', 'Effect of Termination', s3, a4, length('[Effect of Termination]') + 1 + (a4 - s3 - 1) FROM a WHERE id % 2 = 0
  UNION ALL SELECT id, 'TERMINATION_FEES', 'TERMINATION', a3, a4, a4 - a3 FROM a WHERE id % 2 = 1
  UNION ALL SELECT id, 'CAPITALIZATION', 'Section 4.01 Capitalization.', s4, s5, s5 - s4 FROM a)
SELECT id, section_type, heading, CAST(start AS INTEGER) AS start, CAST(stop AS INTEGER) AS stop, n FROM r
"""


@query
def heading_sections(spark, sf_dir):
    d = agreed(spark, sf_dir).withColumn("body", F.concat(F.lit("RECITALS\nWHEREAS, we agree.\n"), F.repeat(F.lit("filler words of the text\n"), 40), F.lit("PURCHASE PRICE\nTen.\nNOTHING HERE\nThe termination fee is one.\nSECTION HEAD\n")))
    rows = scanners.sections(d, "id", "body")
    return rows.select("id", "section_type", "heading", "confidence", F.length("excerpt").cast("long").alias("n"))


SQL["heading_sections"] = f"""
SELECT id, t.section_type, t.heading, t.confidence, CAST(t.n AS BIGINT) AS n FROM ({AGREED}), (VALUES ('RECITALS', 'RECITALS', 'HIGH', 28 + 40 * 25), ('CONSIDERATION', 'PURCHASE PRICE', 'HIGH', 20), ('TERMINATION_FEES', 'NOTHING HERE', 'MEDIUM', 41)) AS t(section_type, heading, confidence, n)
"""


@query
def rationale_excerpts(spark, sf_dir):
    d = view(spark, sf_dir, "orders").select((c("o_orderkey") % 50).alias("txn"), c("o_orderkey").alias("seq"), F.when(c("o_custkey") % 2 == 0, "T1").otherwise("T2").alias("tier"), F.concat(F.lit("We expand. "), F.repeat(F.lit("x"), 400), F.lit(" strategic fit no "), c("o_orderkey").cast("string")).alias("body"))
    return scanners.excerpts_by_tier(d, "txn", "tier", "seq", "body").select("txn", "position", "tier", F.length("excerpt").cast("long").alias("n"))


SQL["rationale_excerpts"] = """
WITH d AS (SELECT o_orderkey % 50 AS txn, o_orderkey AS seq, CASE WHEN o_custkey % 2 = 0 THEN 'T1' ELSE 'T2' END AS tier FROM orders),
e AS (SELECT txn, seq, tier, 0 AS k, 159 AS n FROM d UNION ALL SELECT txn, seq, tier, 1, 150 + 9 + length(' fit no ' || seq) FROM d)
SELECT txn, CAST(position AS INTEGER) AS position, tier, CAST(n AS BIGINT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY txn ORDER BY tier, seq, k) AS position FROM e) WHERE position <= 3
"""


@query
def document_titles(spark, sf_dir):
    t = F.concat(F.when(c("c_custkey") % 3 == 0, "UNITED STATES\n[•]\n").otherwise("<html>\n"), F.when(c("c_custkey") % 4 == 0, "AGREEMENT AND PLAN").when(c("c_custkey") % 4 == 1, "The Tender Offer Statement").when(c("c_custkey") % 4 == 2, "this is a long line of prose").otherwise("SHORT"), F.lit("\nMERGER NUMBER "), c("c_custkey").cast("string"))
    return view(spark, sf_dir, "customer").select("c_custkey", scanners.document_title(t).alias("title"))


SQL["document_titles"] = "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'AGREEMENT AND PLAN' WHEN 1 THEN 'The Tender Offer Statement' ELSE 'MERGER NUMBER ' || c_custkey END AS title FROM customer"


# ---- shown values

@query
def shown_values(spark, sf_dir):
    o = view(spark, sf_dir, "orders")
    kind = F.when(c("o_orderkey") % 8 == 0, "FY").when(c("o_orderkey") % 8 == 1, "TTM").when(c("o_orderkey") % 8 == 2, "NTM").when(c("o_orderkey") % 8 == 3, "QUARTER").when(c("o_orderkey") % 8 == 4, "UNKNOWN").when(c("o_orderkey") % 8 == 5, "calendar_year").when(c("o_orderkey") % 8 == 6, "INTERIM")
    end = F.when(c("o_custkey") % 5 == 0, F.lit(None)).when(c("o_custkey") % 5 == 1, "soon").otherwise(c("o_orderdate").cast("date").cast("string"))
    flag = F.when(c("o_custkey") % 3 == 0, F.lit(None)).otherwise(c("o_custkey") % 3 - 1).cast("int")
    number = F.when(c("o_orderkey") % 3 == 0, F.lit(None)).when(c("o_orderkey") % 3 == 1, c("o_custkey").cast("double")).otherwise(c("o_custkey") + 0.5)
    return o.select(
        c("o_orderkey").alias("id"), vocab.shown_period(kind, end).alias("period"), vocab.shown_pair(kind, end).alias("pair"), vocab.shown_flag(flag).alias("flag"), vocab.shown_number(number).alias("number"),
        vocab.shown_multiples(F.when(c("o_orderkey") % 4 != 0, (c("o_custkey") % 80) / 8), F.when(c("o_custkey") % 4 != 0, (c("o_custkey") % 40) / 4)).alias("multiples"),
    )


SQL["shown_values"] = """
WITH a AS (SELECT o_orderkey AS id, o_custkey AS k, CASE o_orderkey % 8 WHEN 0 THEN 'FY' WHEN 1 THEN 'TTM' WHEN 2 THEN 'NTM' WHEN 3 THEN 'QUARTER' WHEN 4 THEN 'UNKNOWN' WHEN 5 THEN 'calendar_year' WHEN 6 THEN 'INTERIM' END AS t,
  CASE o_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS e FROM orders)
SELECT id, CASE WHEN t IS NULL OR t = 'UNKNOWN' THEN e WHEN e IS NULL THEN t WHEN t = 'FY' THEN 'FY' || e[1:4] WHEN t = 'calendar_year' THEN 'CY' || e[1:4]
    WHEN t = 'QUARTER' THEN CASE WHEN e = 'soon' THEN 'Q soon' ELSE 'Q' || ((CAST(e[6:7] AS INTEGER) - 1) // 3 + 1) || ' ' || e[1:4] END ELSE t || ' ' || e END AS period,
  concat_ws(' / ', t, e) AS pair, CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'N' ELSE 'Y' END AS flag, CASE id % 3 WHEN 0 THEN '' WHEN 1 THEN CAST(k AS VARCHAR) ELSE k || '.5' END AS number,
  concat_ws(' | ', CASE WHEN id % 4 <> 0 THEN 'LTM=' || printf('%.1f', floor((k % 80) / 8 * 10 + 0.5 + 1e-9) / 10) || 'x' END, CASE WHEN k % 4 <> 0 THEN 'NTM=' || printf('%.1f', floor((k % 40) / 4 * 10 + 0.5 + 1e-9) / 10) || 'x' END) AS multiples FROM a
"""


@query
def notes_merged(spark, sf_dir):
    notes = F.when(c("c_custkey") % 4 == 0, '{"b":{"x":[1,2]},"a":"s"}').when(c("c_custkey") % 4 == 1, "plain words").when(c("c_custkey") % 4 == 2, '{"hc":1,"z":true}')
    return view(spark, sf_dir, "customer").select("c_custkey", vocab.notes_with(notes, "hc", F.concat(F.lit('{"n":'), c("c_custkey").cast("string"), F.lit("}"))).alias("notes"))


SQL["notes_merged"] = """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '{"a":"s","b":{"x":[1,2]},"hc":{"n":' || c_custkey || '}}' WHEN 1 THEN '{"hc":{"n":' || c_custkey || '},"raw":"plain words"}'
  WHEN 2 THEN '{"hc":{"n":' || c_custkey || '},"z":true}' ELSE '{"hc":{"n":' || c_custkey || '}}' END AS notes FROM customer
"""
