"""DuckDB SQL for the engine's queries, written apart from their Spark form."""

from __future__ import annotations

from factmill.functions import derive, text
from factmill.plans.domain import CLAIMS, DEALS, LEDGER


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _first_marker(expr: str, markers: list[str], prefix: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({expr}, '{m}') THEN '{prefix}{m}'" for m in markers) + " END"


_RANK = "CASE confidence WHEN 'HIGH' THEN 0 WHEN 'LOW' THEN 2 ELSE 1 END"


def _resolve(source: str, keys: str, value: str = "value", counts: str = "TRUE") -> str:
    """Resolution by windows: claims(keys, tier, confidence, seq, value) in ``source``."""
    return f"""
      told AS (SELECT *, {_RANK} AS r FROM ({source}) WHERE {value} IS NOT NULL AND tier IN ('T1', 'T2', 'T3', 'T4') AND {counts}),
      deciding AS (SELECT *, min(tier) OVER (PARTITION BY {keys}) AS best_tier FROM told),
      own AS (SELECT *, min(r) OVER (PARTITION BY {keys}) AS best_r FROM deciding WHERE tier = best_tier),
      won AS (
        SELECT {keys}, count(DISTINCT {value}) AS n_values, count(*) FILTER (WHERE r = best_r) AS n_best,
               min({value}) FILTER (WHERE r = best_r) AS best_value, arg_min({value}, seq) AS first_value
        FROM own GROUP BY {keys}
      ),
      answers AS (
        SELECT {keys}, CASE WHEN n_values > 1 AND n_best = 1 THEN best_value ELSE first_value END AS {value},
               CAST(n_values > 1 AND n_best > 1 AS INTEGER) AS flagged
        FROM won
      )"""


_LONG = " UNION ALL ".join(f"SELECT txn, source, tier, confidence, seq, '{f}' AS field, {f} AS value FROM ledger" for f in ("quantity", "price", "discount", "tax"))

SQL: dict[str, str] = {}

SQL["resolve_flagship"] = f"""
WITH ledger AS ({LEDGER}), deals AS ({DEALS}), {_resolve(_LONG, 'txn, field')},
wide AS (
  SELECT txn, max(value) FILTER (WHERE field = 'quantity') AS quantity, max(value) FILTER (WHERE field = 'price') AS price,
         max(value) FILTER (WHERE field = 'discount') AS discount, max(value) FILTER (WHERE field = 'tax') AS tax, CAST(sum(flagged) AS BIGINT) AS n_conflicts
  FROM answers GROUP BY txn
)
SELECT wide.*, CASE history WHEN 'TERMINATED' THEN 'TERMINATED' WHEN 'CLOSED' THEN 'CLOSED' ELSE 'PENDING' END AS status
FROM wide JOIN deals ON txn = deal_id
"""

SQL["resolve_manual_override"] = f"""
WITH claims AS (
  SELECT user_id AS txn, CASE event_type WHEN 'click' THEN 'T1' WHEN 'view' THEN 'T2' ELSE 'T9' END AS tier, NULL AS confidence, event_id AS seq, value, event_type = 'purchase' AS manual
  FROM events
), {_resolve('SELECT * FROM claims', 'txn')},
hand AS (SELECT txn, arg_max(value, seq) AS value FROM claims WHERE manual AND value IS NOT NULL GROUP BY txn),
n AS (SELECT txn, count(*) AS n_seen FROM claims GROUP BY txn)
SELECT n.txn, round(coalesce(hand.value, answers.value), 6) AS value,
       CASE WHEN hand.txn IS NULL THEN coalesce(flagged, 0) ELSE 0 END AS flagged, n_seen
FROM n LEFT JOIN hand USING (txn) LEFT JOIN answers USING (txn)
"""

SQL["resolve_boolean"] = f"""
WITH ledger AS ({LEDGER}), flags AS (SELECT *, CAST(discount > 0.05 AS DOUBLE) AS flag FROM ledger),
{_resolve('SELECT * FROM flags', 'txn', 'flag', 'flag <> 0')},
n AS (SELECT txn, count(*) AS n_seen FROM flags GROUP BY txn)
SELECT txn, coalesce(flag, 0) AS flag, coalesce(flagged, 0) AS flagged, n_seen FROM n LEFT JOIN answers USING (txn)
"""

SQL["typed_sibling_pick"] = f"""
WITH ledger AS ({LEDGER}), typed AS (SELECT DISTINCT txn, source FROM ledger WHERE currency = 'USD'),
{_resolve('SELECT l.txn, l.tier, l.confidence, l.seq, l.price AS value FROM ledger l JOIN typed USING (txn, source)', 'txn')}
SELECT txn, value, flagged FROM answers
"""

SQL["anchor_qualifiers"] = f"""
WITH ledger AS ({LEDGER}), {_resolve('SELECT txn, tier, confidence, seq, price AS value FROM ledger', 'txn')},
sources AS (SELECT DISTINCT l.txn, l.source FROM ledger l JOIN answers a ON l.txn = a.txn AND l.price = a.value),
q AS (SELECT l.txn, l.tier, l.seq, l.currency, {_RANK} AS r FROM ledger l JOIN sources USING (txn, source)),
d AS (SELECT *, min(tier) OVER (PARTITION BY txn) AS bt FROM q), o AS (SELECT *, min(r) OVER (PARTITION BY txn) AS br FROM d WHERE tier = bt),
w AS (SELECT txn, count(DISTINCT currency) AS nv, count(*) FILTER (WHERE r = br) AS nb, min(currency) FILTER (WHERE r = br) AS bv, arg_min(currency, seq) AS fv FROM o GROUP BY txn)
SELECT txn, CASE WHEN nv > 1 AND nb = 1 THEN bv ELSE fv END AS currency, CAST(nv > 1 AND nb > 1 AS INTEGER) AS flagged FROM w
"""

SQL["ledger_diff"] = f"""
WITH ledger AS ({LEDGER}), live AS (SELECT part AS txn, quantity, filed, row(seq, txn) AS place FROM ledger WHERE quantity <> 1),
d AS (
  SELECT txn, count(DISTINCT quantity) AS n_values, arg_min(quantity, row(filed, place)) AS first_value, arg_max(quantity, row(filed, place)) AS last_value
  FROM live GROUP BY txn HAVING count(DISTINCT quantity) > 1
)
SELECT txn, 'quantity' AS field, n_values, first_value, last_value, round(last_value - first_value, 2) AS delta,
       round((last_value - first_value) / nullif(first_value, 0) * 100, 2) AS delta_pct,
       CASE WHEN last_value > first_value THEN 'INCREASE' WHEN last_value < first_value THEN 'DECREASE' ELSE 'IDENTICAL' END AS change_type
FROM d
"""

SQL["field_priority"] = """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY substr(o_orderpriority, 1, 1), o_orderdate DESC NULLS LAST, o_orderkey DESC) AS nth FROM orders
) WHERE nth = 1
"""

SQL["ledger_values_exploded"] = """
SELECT o_orderkey, 'value.0' AS fact_key, 'amount' AS field, NULL::VARCHAR AS value FROM orders WHERE o_totalprice IS NOT NULL
UNION ALL SELECT o_orderkey, 'value.0', 'currency', 'USD' FROM orders
UNION ALL SELECT o_orderkey, 'value.1', 'currency', o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL
"""

SQL["ledger_insert_ignore"] = """
WITH o AS (SELECT o_custkey AS txn, o_orderstatus AS text, o_orderkey AS seq FROM orders),
old AS (SELECT txn, text, min(seq) AS seq FROM o WHERE seq % 3 = 0 GROUP BY txn, text),
new AS (SELECT txn, text, min(seq) AS seq FROM o WHERE seq % 3 <> 0 GROUP BY txn, text)
SELECT * FROM old UNION ALL SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.txn = new.txn AND old.text = new.text)
"""

_M = """
  CASE WHEN ok_{m} AND NOT mismatch AND ltm_{m} THEN x_{m} END AS ev_to_{m}_ltm, CASE WHEN ok_{m} AND NOT mismatch AND ntm_{m} AND NOT ltm_{m} THEN x_{m} END AS ev_to_{m}_ntm"""
_AGE = "datediff('day', CASE WHEN regexp_full_match(trim({m}_end), '[0-9]{{4}}') THEN try_cast(trim({m}_end) || '-12-31' AS DATE) WHEN length(trim({m}_end)) >= 10 THEN try_cast(substr(trim({m}_end), 1, 10) AS DATE) END, try_cast(announced AS DATE))"
SQL["derive_multiples"] = f"""
WITH deals AS ({DEALS}), slots AS (
  SELECT *, coalesce(value_currency <> financials_currency, FALSE) AS mismatch,
    coalesce(value_amount > 0 AND event NOT IN {_in(derive.FUNDING)}, FALSE) AS base,
    coalesce(revenue_period IN ('LTM', 'TTM') OR (revenue_period = 'ANNUAL' AND {_AGE.format(m='revenue')} BETWEEN 0 AND 455), FALSE) AS ltm_revenue, coalesce(revenue_period = 'NTM', FALSE) AS ntm_revenue,
    coalesce(ebitda_period IN ('LTM', 'TTM') OR (ebitda_period = 'ANNUAL' AND {_AGE.format(m='ebitda')} BETWEEN 0 AND 455), FALSE) AS ltm_ebitda, coalesce(ebitda_period = 'NTM', FALSE) AS ntm_ebitda,
    CASE WHEN revenue > 0 THEN round(value_amount / revenue, 2) END AS x_revenue, CASE WHEN ebitda > 0 THEN round(value_amount / ebitda, 2) END AS x_ebitda
  FROM deals
), able AS (
  SELECT *, base AND x_revenue IS NOT NULL AND (ltm_revenue OR ntm_revenue) AS ok_revenue, base AND x_ebitda IS NOT NULL AND (ltm_ebitda OR ntm_ebitda) AS ok_ebitda FROM slots
)
SELECT deal_id, {_M.format(m='revenue')}, {_M.format(m='ebitda')},
  CASE WHEN NOT mismatch AND ((ok_revenue AND x_revenue BETWEEN 0.1 AND 50) OR (ok_ebitda AND x_ebitda BETWEEN 1 AND 100)) THEN 'CALCULATED'
       WHEN ok_revenue OR ok_ebitda THEN 'NM' ELSE 'NOT_CALCULABLE' END AS multiple_quality
FROM able
"""

SQL["derive_ev_bridge"] = f"""
WITH deals AS ({DEALS}), a AS (
  SELECT *, CASE WHEN event NOT IN {_in(derive.FUNDING)} AND value_type = 'EQUITY_VALUE' AND value_amount > 0 THEN value_amount END AS equity,
    coalesce(total_debt IS NOT NULL AND cash IS NOT NULL AND debt_currency IS NOT NULL AND debt_as_of = cash_as_of, FALSE) AS sheet
  FROM deals
), b AS (
  SELECT *, CASE WHEN equity > 0 AND pct > 0 THEN CASE WHEN pct < 100 THEN round(equity / (pct / 100), 2) ELSE equity END END AS implied,
    CASE WHEN reported_net_debt IS NOT NULL THEN reported_net_debt WHEN sheet THEN round(total_debt - cash, 2) END AS nd,
    CASE WHEN reported_net_debt IS NOT NULL THEN 'REPORTED' WHEN sheet THEN 'CALCULATED_TOTAL_DEBT_MINUS_CASH_ST' END AS nd_basis FROM a
), e AS (SELECT *, coalesce(implied IS NOT NULL AND nd IS NOT NULL AND value_currency = debt_currency, FALSE) AS sum_ok, value_type = 'ENTERPRISE_VALUE' AND value_amount > 0 AS stated FROM b)
SELECT deal_id, equity, implied AS implied_equity, nd AS net_debt, nd_basis AS net_debt_basis,
  CASE WHEN stated THEN value_amount WHEN sum_ok THEN round(implied + nd, 2) END AS implied_ev,
  CASE WHEN stated THEN 'STATED' WHEN sum_ok AND nd_basis = 'REPORTED' THEN 'IMPLIED_EQUITY_PLUS_REPORTED_NET_DEBT' WHEN sum_ok THEN 'IMPLIED_EQUITY_PLUS_CALCULATED_NET_DEBT' END AS ev_basis
FROM e
"""

_MINOR = f"CASE WHEN event = 'MINORITY_INVESTMENT' THEN 1 WHEN pct IS NOT NULL THEN CAST(pct < 50 AS INTEGER) WHEN transition IN {_in(derive.MINORITY_TRANSITIONS)} THEN 1 ELSE 0 END"
SQL["derive_transaction_value"] = f"""
WITH deals AS ({DEALS}), a AS (
  SELECT *, CASE WHEN event NOT IN {_in(derive.FUNDING)} AND value_type = 'EQUITY_VALUE' AND value_amount > 0 THEN value_amount END AS equity, {_MINOR} AS minor FROM deals
), b AS (
  SELECT *, CASE WHEN event IN {_in(derive.FUNDING)} THEN NULL WHEN value_type = 'TRANSACTION_VALUE' AND value_amount > 0 THEN 'STATED' WHEN equity IS NULL THEN NULL
      WHEN minor = 1 THEN 'EQUITY_BELOW_CONTROL' WHEN event NOT IN ('ACQUISITION', 'MERGER') THEN NULL
      WHEN total_debt IS NOT NULL AND value_currency = debt_currency THEN 'EQUITY_PLUS_TOTAL_DEBT' ELSE 'EQUITY_VALUE_ONLY' END AS basis FROM a
), v AS (SELECT *, CASE WHEN basis = 'STATED' THEN value_amount WHEN basis = 'EQUITY_PLUS_TOTAL_DEBT' THEN round(equity + total_debt, 2) WHEN basis IS NOT NULL THEN equity END AS tv FROM b)
SELECT deal_id, tv AS transaction_value, basis AS value_basis,
  CASE WHEN event IN {_in(derive.FUNDING)} AND round_size > 0 THEN round_size WHEN event IN {_in(derive.PURCHASES)} AND tv > 0 THEN tv END AS transaction_size,
  CASE WHEN event IN {_in(derive.FUNDING)} AND round_size > 0 THEN 'ROUND_SIZE' WHEN event IN {_in(derive.PURCHASES)} AND tv > 0 THEN 'TRANSACTION_VALUE' END AS size_basis,
  CASE WHEN value_currency IS NULL THEN debt_currency WHEN debt_currency IS NULL OR debt_currency = value_currency THEN value_currency END AS currency
FROM v
"""

_PRECISION = "CASE WHEN regexp_full_match({c}, '[0-9]{{4}}') THEN 'year' WHEN length({c}) = 7 THEN 'month' WHEN length({c}) >= 10 THEN 'exact' END"
SQL["derive_flags"] = f"""
WITH deals AS ({DEALS})
SELECT deal_id, {_MINOR} AS is_minority,
  CAST(coalesce(event = 'ACQUISITION' AND target_status = 'PUBLIC' AND lower(target_type) = 'standalone_company' AND lower(acquirer_type) IN {_in(derive.PRIVATE_BUYERS)} AND private_outcome = 1, FALSE) AS INTEGER) AS is_take_private,
  CAST(coalesce(said_secondary, 0) = 1 OR (event IN ('ACQUISITION', 'MERGER') AND buyer_sponsor = 1 AND seller_sponsor = 1) AS INTEGER) AS is_secondary,
  CASE WHEN history = 'TERMINATED' THEN 'TERMINATED' WHEN deal_id % 9 = 0 OR history = 'CLOSED' THEN 'CLOSED' ELSE 'PENDING' END AS status,
  {_PRECISION.format(c='revenue_end')} AS revenue_precision, {_PRECISION.format(c='ebitda_end')} AS ebitda_precision
FROM deals
"""

SQL["derive_consideration"] = """
WITH f AS (SELECT DISTINCT l_orderkey, (l_linenumber + l_orderkey) % 6 AS k FROM lineitem), s AS (
  SELECT l_orderkey, bool_or(k = 0) AS cash, bool_or(k = 1) AS stock, bool_or(k = 4) AS other, bool_or(k = 2) AS earnout, bool_or(k = 3) AS cvr FROM f GROUP BY l_orderkey
)
SELECT l_orderkey, CASE WHEN other THEN 'OTHER' WHEN cash AND stock THEN 'CASH_AND_STOCK' WHEN cash THEN 'CASH' WHEN stock THEN 'STOCK' END AS consideration,
  CAST(earnout AS INTEGER) AS has_earnout, CAST(cvr AS INTEGER) AS has_cvr FROM s
"""

_ALIAS = " ".join(f"WHEN rc IN {_in(v)} THEN '{k}'" for k, v in text.REASON_ALIASES.items())
SQL["clean_claims"] = f"""
WITH claims AS ({CLAIMS}), a AS (
  SELECT *, lower(trim(regexp_replace(trim(pct), '%+$', ''))) AS p, upper(trim(coalesce(reason, ''))) AS rc,
    trim(regexp_replace(lower(trim(label)), '( extension| round| financing| funding)(\\s|extension|round|financing|funding)*$', '')) AS lb,
    list_distinct(list_filter(list_transform(string_split(uses, ','), lambda u: upper(trim(u))), lambda u: u IN {_in(text.PROCEEDS_USES)})) AS raw_uses,
    list_filter(list_transform(string_split(uses, ','), lambda u: upper(trim(u))), lambda u: u IN {_in(text.PROCEEDS_USES)}) AS all_uses
  FROM claims
), b AS (
  SELECT *, try_cast(CASE WHEN {' OR '.join(f"contains(p, '{m}')" for m in text.PERCENT_BOUNDS)} THEN NULL ELSE trim(regexp_replace(p, '^(approximately|approx\\.|approx|about|roughly|circa|~)', '')) END AS DOUBLE) AS v,
    CASE WHEN regexp_full_match(lb, 'pre[\\s\\-_]*seed') THEN 'PRE_SEED' WHEN lb = 'seed' THEN 'SEED' WHEN lb = 'angel' THEN 'ANGEL'
      WHEN regexp_full_match(lb, 'series[\\s\\-_]*[a-z][\\s\\-_]*([1-9][0-9]*)?') THEN 'SERIES_' || upper(regexp_extract(lb, '^series[\\s\\-_]*([a-z])', 1)) || regexp_extract(lb, '([0-9]*)$', 1) END AS round
  FROM a
)
SELECT id, CASE WHEN v > 0 AND v <= 100 THEN v END AS pct, round,
  CASE WHEN round IN ('PRE_SEED') THEN 'PRE_SEED' WHEN round IN ('SEED', 'ANGEL') THEN 'SEED' WHEN round LIKE 'SERIES_A%' THEN 'EARLY_STAGE' WHEN round LIKE 'SERIES_B%' OR round LIKE 'SERIES_C%' THEN 'GROWTH' WHEN round IS NOT NULL THEN 'LATE_STAGE' END AS stage,
  CASE WHEN rc IN {_in(text.REASON_CODES)} THEN rc {_ALIAS} WHEN relevant AND rc LIKE 'SERIES\\_%' ESCAPE '\\' THEN 'VC_ROUND_OR_FUNDING' WHEN rc || '_ANNOUNCEMENT' IN {_in(text.REASON_CODES)} THEN rc || '_ANNOUNCEMENT'
    WHEN relevant THEN 'AMBIGUOUS_BUT_LIKELY_DEAL' ELSE 'OTHER_NOT_RELEVANT' END AS reason,
  nullif(array_to_string(list_filter(all_uses, lambda u, i: list_position(all_uses, u) = i), ', '), '') AS uses
FROM b
"""

SQL["clean_names"] = f"""
WITH claims AS ({CLAIMS}), forms(company, name) AS (
  VALUES ('Acme Holdings, Inc.', 'acme'), ('The Beta & Gamma Group Ltd', 'beta gamma'), ('Delta (Europe) GmbH', 'delta'), ('Alpha and Omega LLC', 'alpha omega'), ('Zeta   Co., Limited', 'zeta'), ('Group', ''), ('', '')
), lists(names, parsed, status) AS (
  VALUES ('Acme Capital, Beta Partners', 'Acme Capital|Beta Partners', 'UNREVIEWED'), ('Acme Capital, LLC', 'Acme Capital, LLC', 'UNREVIEWED'), ('Acme; Beta Partners', 'Acme; Beta Partners', 'NEEDS_REVIEW'),
    ('KKR and Blue Owl', 'KKR|Blue Owl', 'UNREVIEWED'), ('One Fund and Two Fund and Three Fund', 'One Fund and Two Fund and Three Fund', 'NEEDS_REVIEW'), ('Solo', 'Solo', 'UNREVIEWED'),
    ('KKR, TPG, Apollo Global', 'KKR|TPG|Apollo Global', 'UNREVIEWED'), ('Big Fund, Inc, Other Fund', 'Big Fund, Inc, Other Fund', 'NEEDS_REVIEW'), ('', '', 'UNREVIEWED')
)
SELECT c.id, coalesce(f.name, '') AS company, l.parsed AS names, l.status FROM claims c LEFT JOIN forms f USING (company) JOIN lists l USING (names)
"""

SQL["text_money_ticker"] = f"""
WITH claims AS ({CLAIMS}), m AS (
  SELECT id, news, regexp_extract_all(news, '(?i)(?:US\\$|\\$)\\s?[0-9][0-9,]*(?:\\.[0-9]+)?\\s*(?:billion|bn|million|mm|m\\b|k\\b|thousand)?') AS all_m FROM claims
), p AS (SELECT *, list_transform(all_m, lambda x: try_cast(replace(regexp_extract(x, '[0-9][0-9,]*(\\.[0-9]+)?'), ',', '') AS DOUBLE) * CASE lower(regexp_extract(x, '[A-Za-z]+$')) WHEN 'billion' THEN 1e9 WHEN 'bn' THEN 1e9 WHEN 'million' THEN 1e6 WHEN 'mm' THEN 1e6 WHEN 'm' THEN 1e6 WHEN 'k' THEN 1e3 WHEN 'thousand' THEN 1e3 ELSE 1.0 END) AS amounts FROM m)
SELECT id, len(all_m)::BIGINT AS n_mentions, amounts[1]::DOUBLE AS first_amount, amounts[2]::DOUBLE AS second_amount,
  nullif(regexp_extract(news, '\\((?:NYSE|NASDAQ|Nasdaq|LSE|TSX)\\s*:\\s*([A-Z]{{1,5}})\\)', 1), '') AS ticker FROM p
"""

_HASH = "sha256(lower(trim(regexp_replace({t}, '[\\x20\\x09-\\x0D]+', ' ', 'g'))))"
SQL["dedup_content_hash"] = f"SELECT {_HASH.format(t='text')} AS hash, min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY 1"
SQL["dedup_url_then_hash"] = f"""
WITH a AS (SELECT page_id, url, {_HASH.format(t='html')} AS hash, row_number() OVER (PARTITION BY url ORDER BY page_id) AS n FROM pages WHERE trim(url) <> ''),
b AS (SELECT page_id, url, hash, row_number() OVER (PARTITION BY hash ORDER BY page_id) AS m FROM a WHERE n = 1)
SELECT page_id, url, hash FROM b WHERE m = 1
"""

_TITLE = "nullif(trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]+>', ' ', 'g'), '[\\x20\\x09-\\x0D]+', ' ', 'g')), '')"
SQL["html_title"] = f"SELECT page_id, {_TITLE} AS title, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host FROM pages"
SQL["body_quality"] = f"""
WITH a AS (
  SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'Access denied ' WHEN 2 THEN 'We use cookies here ' WHEN 3 THEN 'Attention Required! now ' ELSE '' END || regexp_replace(html, '<[^>]*>', ' ', 'g') AS t,
    CASE WHEN page_id % 2 = 0 THEN lower({_TITLE}) END AS title FROM pages
), b AS (SELECT *, lower(trim(regexp_replace(t, '[\\x20\\x09-\\x0D]+', ' ', 'g'))) AS flat FROM a)
SELECT page_id, CASE WHEN t IS NULL OR flat = '' THEN 'empty' ELSE coalesce(
  {_first_marker("substr(flat, 1, 500)", text.DECISIVE_MARKERS, 'block_page:body:')},
  CASE WHEN length(flat) < 1500 THEN {_first_marker("substr(flat, 1, 500)", text.GENERIC_MARKERS, 'block_page:short_body_marker:')} END,
  CASE WHEN length(flat) < 600 THEN {_first_marker("flat", text.WEAK_MARKERS, 'block_page:short_body_marker:')} END,
  {_first_marker("title", text.DECISIVE_MARKERS + text.GENERIC_MARKERS, 'block_page:title:')},
  CASE WHEN length(t) < 100 THEN 'too_short:' || length(t) END) END AS reason
FROM b
"""

SQL["body_quality_whole"] = f"""
WITH a AS (SELECT page_id, regexp_replace(html, '<[^>]*>', ' ', 'g') AS t, lower({_TITLE}) AS title FROM pages),
b AS (SELECT *, lower(trim(regexp_replace(t, '[\\x20\\x09-\\x0D]+', ' ', 'g'))) AS flat FROM a)
SELECT page_id, CASE WHEN t IS NULL OR flat = '' THEN 'empty' ELSE coalesce(
  {_first_marker("substr(flat, 1, 500)", text.DECISIVE_MARKERS, 'block_page:body:')},
  CASE WHEN length(flat) < 1500 THEN {_first_marker("substr(flat, 1, 500)", text.GENERIC_MARKERS, 'block_page:short_body_marker:')} END,
  CASE WHEN length(flat) < 600 THEN {_first_marker("flat", text.WEAK_MARKERS, 'block_page:short_body_marker:')} END,
  {_first_marker("title", text.DECISIVE_MARKERS + text.GENERIC_MARKERS, 'block_page:title:')},
  CASE WHEN length(t) < 100 THEN 'too_short:' || length(t) END) END AS reason
FROM b
"""

SQL["cluster_islands"] = """
WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'),
a AS (SELECT *, CASE WHEN datediff('day', lag(day) OVER w, day) <= 1 THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY user_id ORDER BY day, event_id)),
b AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY day, event_id) AS island FROM a)
SELECT user_id, island::BIGINT AS island, count(*) AS n_events, min(event_id) AS first_event, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day FROM b GROUP BY user_id, island
"""

SQL["nearest_filing"] = """
WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day FROM orders), l AS (SELECT l_orderkey AS k, CAST(l_shipdate AS DATE) AS filed, l_partkey AS part FROM lineitem)
SELECT o.k, CAST(o.day AS VARCHAR) AS day, count(*) AS n_in_window, min(abs(datediff('day', o.day, filed)))::INTEGER AS days_off, arg_min(part, row(abs(datediff('day', o.day, filed)), part)) AS part
FROM o JOIN l ON o.k = l.k AND filed BETWEEN o.day - 30 AND o.day + 7 GROUP BY o.k, o.day
"""

SQL["semi_triggered"] = "SELECT o_orderkey, o_orderstatus FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_discount > 0.09)"
SQL["anti_unlabelled"] = "SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"
SQL["left_on_predicate"] = "SELECT d.doc_id, d.lang, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id AND l.quality = 1"
SQL["scalar_counts"] = "SELECT c_custkey, c_mktsegment, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders, (SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_custkey = c_custkey) AS n_states FROM customer"
SQL["having_dupes"] = "SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY ALL HAVING count(*) > 1 AND count(DISTINCT l_partkey) > 1"
SQL["flag_pivot"] = "SELECT user_id, " + ", ".join(f"max(CASE WHEN event_type = '{k}' THEN 1 ELSE 0 END) AS has_{k}" for k in ("click", "view", "purchase")) + " FROM events GROUP BY user_id"
SQL["uniqlist"] = """
WITH f AS (SELECT conv_id, role, min(turn) AS first_turn FROM conversations GROUP BY conv_id, role), n AS (SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id)
SELECT conv_id, string_agg(role, '|' ORDER BY first_turn, role) AS roles, any_value(n_turns) AS n_turns FROM f JOIN n USING (conv_id) GROUP BY conv_id
"""
SQL["json_agg"] = """SELECT conv_id, '[' || string_agg('{"role":"' || role || '","turn":' || turn || '}', ',' ORDER BY turn, role) || ']' AS turns FROM conversations GROUP BY conv_id"""
SQL["coverage"] = f"WITH deals AS ({DEALS}) " + " UNION ALL ".join(f"SELECT '{n}' AS \"column\", count({n}) AS filled FROM deals" for n in ("pct", "total_debt", "cash", "reported_net_debt", "value_currency", "transition"))

SQL["upsert_owned_columns"] = """
WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS state, o_totalprice AS price, o_orderpriority AS note FROM orders)
SELECT id, CASE WHEN id % 2 = 0 THEN CASE WHEN id % 3 = 0 THEN NULL ELSE 'X' END ELSE state END AS state, CASE WHEN id % 2 = 0 THEN price + 1 ELSE price END AS price,
  CASE WHEN id % 4 <> 0 THEN note END AS note, CASE WHEN id % 4 = 0 THEN 1 WHEN id % 2 = 0 THEN 2 ELSE 1 END AS version
FROM o
"""
SQL["soft_delete_latest"] = """
SELECT o_orderkey AS id, o_orderstatus AS state, CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END AS is_current FROM orders WHERE o_orderkey % 4 <> 0
UNION ALL SELECT o_orderkey, 'N', 1 FROM orders WHERE o_orderkey % 2 = 0
"""
SQL["replace_children"] = """
WITH new AS (SELECT l_orderkey, l_linenumber, l_quantity + 100 AS l_quantity FROM lineitem WHERE l_orderkey % 10 = 0 AND l_linenumber = 1)
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM new) UNION ALL SELECT * FROM new
"""
SQL["update_from_join"] = "SELECT c_custkey, c_mktsegment, coalesce((SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey AND c_custkey % 2 = 0), c_acctbal) AS c_acctbal FROM customer"

SQL["participant_entities"] = """
WITH a AS (SELECT CAST(conv_id AS VARCHAR) AS txn, role AS name, turn, trim(regexp_replace(replace(lower(role), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS norm FROM conversations)
SELECT 'ent_' || substr(sha1(txn || '|' || norm), 1, 16) AS entity_id, txn, arg_min(name, row(turn, name)) AS name, count(*) AS n_rows FROM a WHERE norm <> '' GROUP BY txn, norm
"""
SQL["investor_collapse"] = """
SELECT l_orderkey AS txn, 'fund ' || (l_suppkey % 7) || ' inc' AS norm, 'Fund ' || (l_suppkey % 7) || ', Inc.' AS name, max(CAST(l_returnflag = 'R' AS INTEGER)) AS is_lead,
  max(CASE WHEN l_linestatus = 'F' THEN l_linenumber % 2 END)::INTEGER AS is_new, count(*) AS n_sources FROM lineitem GROUP BY l_orderkey, l_suppkey % 7
"""
SQL["parent_names"] = """
SELECT o_custkey AS txn, 'Parent ' || (max(o_orderkey) % 3) AS parent, count(DISTINCT o_orderkey % 3) AS n_names, CASE WHEN count(DISTINCT o_orderkey % 3) > 1 THEN 'NEEDS_REVIEW' ELSE 'UNREVIEWED' END AS review FROM orders GROUP BY o_custkey
"""

_COL = "SELECT '{n}' AS \"column\", CAST({e} AS VARCHAR) AS value FROM pages"
SQL["profile_columns"] = "WITH v AS (" + " UNION ALL ".join(_COL.format(n=n, e=e) for n, e in (("page_id", "page_id"), ("url", "url"), ("html", "html"))) + """)
SELECT "column", count(*) FILTER (WHERE trim(value) <> '') AS filled, round(count(*) FILTER (WHERE trim(value) <> '') * 100 / count(*), 2) AS fill_pct,
  count(DISTINCT value) FILTER (WHERE trim(value) <> '') AS n_distinct, max(length(value)) AS max_length, round(count(*) FILTER (WHERE regexp_matches(value, '^https?://')) * 100 / count(*), 2) AS url_pct
FROM v GROUP BY "column"
"""
_AT = "list_sort(list(length(value)) FILTER (WHERE value <> ''))[1 + CAST(round_even((count(*) FILTER (WHERE value <> '') - 1) * {p}, 0) AS INTEGER)]"
_SHARE = "coalesce(round(count(*) FILTER (WHERE value <> '' AND regexp_matches(value, '{r}')) * 100 / nullif(count(*) FILTER (WHERE value <> ''), 0), 2), 0)"
SQL["profile_pages"] = "WITH r AS (" + " UNION ALL ".join(_COL.format(n=n, e=n) for n in ("page_id", "url", "html")) + r"""),
v AS (SELECT "column", regexp_replace(coalesce(value, ''), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS value FROM r)
SELECT "column", count(*) FILTER (WHERE value <> '') AS filled, round(count(*) FILTER (WHERE value <> '') * 100 / count(*), 2) AS fill_pct,
  count(DISTINCT value) FILTER (WHERE value <> '') AS n_distinct, round(count(DISTINCT value) FILTER (WHERE value <> '') / count(*), 4) AS distinct_ratio,
  min(length(value)) FILTER (WHERE value <> '') AS least, max(length(value)) FILTER (WHERE value <> '') AS most, CAST(floor(avg(length(value)) FILTER (WHERE value <> '')) AS BIGINT) AS mean,
""" + f"  {_SHARE.format(r='(?i)^https?://')} AS url_pct, {_SHARE.format(r='^[0-9]{4}-[0-9]{2}-[0-9]{2}')} AS date_pct, " + ", ".join(f"{_AT.format(p=p)} AS {k}" for k, p in (("p05", 0.05), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95))) + ' FROM v GROUP BY "column"'
_NTH = "list_sort(list(n_chars))[1 + CAST(round_even((count(*) - 1) * {p}, 0) AS INTEGER)]"
SQL["percentiles_nearest"] = "SELECT source, " + ", ".join(f"{_NTH.format(p=p)} AS p{int(p * 100)}" for p in (0.1, 0.5, 0.9)) + ", min(n_chars) AS least, max(n_chars) AS most, CAST(floor(avg(n_chars)) AS BIGINT) AS mean FROM documents GROUP BY source"
SQL["topk_hosts"] = """
WITH h AS (SELECT regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host FROM pages), n AS (SELECT host, count(*) AS n FROM h GROUP BY host)
SELECT host, n, round(n * 100 / sum(n) OVER (), 2) AS share_pct FROM n ORDER BY n DESC, host LIMIT 10
"""
SQL["stratified_sample"] = """
WITH d AS (SELECT doc_id, lang, source, n_chars, sha256(CAST(doc_id AS VARCHAR)) AS h FROM documents),
s1 AS (SELECT * FROM d WHERE n_chars > 3000 ORDER BY h LIMIT 40), r1 AS (SELECT * FROM d WHERE doc_id NOT IN (SELECT doc_id FROM s1)),
s2 AS (SELECT * FROM r1 WHERE lang = 'fr' ORDER BY h LIMIT 25), r2 AS (SELECT * FROM r1 WHERE doc_id NOT IN (SELECT doc_id FROM s2)),
s3 AS (SELECT * FROM r2 WHERE source = 'src0' ORDER BY h LIMIT 15), r3 AS (SELECT * FROM r2 WHERE doc_id NOT IN (SELECT doc_id FROM s3)),
s4 AS (SELECT * FROM r3 ORDER BY h LIMIT 30)
SELECT doc_id, lang, source, n_chars, 'long' AS stratum FROM s1 UNION ALL SELECT doc_id, lang, source, n_chars, 'french' FROM s2
UNION ALL SELECT doc_id, lang, source, n_chars, 'first_source' FROM s3 UNION ALL SELECT doc_id, lang, source, n_chars, 'rest' FROM s4
"""
SQL["score_precision"] = """
WITH g AS (SELECT lang, CAST(quality = CAST(n_chars > 500 AS INTEGER) AS INTEGER) AS ok FROM documents JOIN labels USING (doc_id))
SELECT lang, count(*) AS n, sum(ok)::BIGINT AS correct, round(avg(ok), 6) AS precision, CAST(round(avg(ok), 6) >= 0.9 AS INTEGER) AS passed FROM g GROUP BY lang
"""
SQL["funnel"] = "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users, round(quantile_cont(value, 0.5), 6) AS median_value FROM events GROUP BY event_type"
SQL["qa_checks"] = f"""
SELECT 'orders_without_lines' AS "check", count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'shipped_before_order', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate
UNION ALL SELECT 'null_currency', count(*) FROM ({DEALS}) WHERE value_currency IS NULL
UNION ALL SELECT 'repeated_lines', count(*) FROM ({SQL["having_dupes"]})
"""
SQL["set_difference"] = """
WITH a AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0), b AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 5 = 0)
SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
"""
SQL["lineage"] = """
SELECT n_name, count(DISTINCT c_custkey) AS n_customers, count(o_orderkey) AS n_orders FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey LEFT JOIN orders ON c_custkey = o_custkey GROUP BY n_name
"""
