"""The engine's queries over the driver's tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.functions import derive, text
from factmill.operators import cluster, ledger, participants, relational
from factmill.operators.shared import dealt
from factmill.plans.domain import claims, deals, view
from factmill.plans.domain import ledger as claims_ledger

Query = Callable[[SparkSession, str], DataFrame]
FOUND: dict[str, Query] = {}
c = F.col


def query(f: Query) -> Query:
    FOUND[f.__name__] = f
    return f


FIELDS = ["quantity", "price", "discount", "tax"]


def _long(spark, sf_dir, fields=FIELDS):
    # claims travel once and as they are: a few of them, as here, are less than the states of their fields. Exploded rows stay where they are dealt
    rows = claims_ledger(spark, sf_dir).repartition("txn")
    ids = ["txn", "source", "tier", "confidence", "seq", "filed"]
    told = F.array(*[F.struct(F.lit(f).alias("field"), c(f).alias("value")) for f in fields])
    return rows.select(*ids, F.inline(told)).where("value IS NOT NULL")


# ---- resolution


@query
def resolve_flagship(spark, sf_dir):
    won = ledger.resolved(_long(spark, sf_dir), ["txn", "field"])
    wide = won.groupBy("txn").agg(*[F.max(F.when(c("field") == f, c("value"))).alias(f) for f in FIELDS], F.sum("flagged").alias("n_conflicts"))
    d = deals(spark, sf_dir).select("deal_id", derive.status(c("history"), F.lit(None)).alias("status"))
    return wide.join(d, c("txn") == c("deal_id")).select("txn", *FIELDS, c("n_conflicts").cast("long").alias("n_conflicts"), "status")


@query
def resolve_manual_override(spark, sf_dir):
    e = view(spark, sf_dir, "events")
    tier = F.when(c("event_type") == "click", "T1").when(c("event_type") == "view", "T2").otherwise("T9")
    rows = e.select(c("user_id").alias("txn"), F.lit("value").alias("field"), "value", tier.alias("tier"), F.lit(None).cast("string").alias("confidence"), c("event_id").alias("seq"), (c("event_type") == "purchase").alias("manual"))
    return ledger.resolved(rows, ["txn", "field"], manual=c("manual")).select("txn", F.round("value", 6).alias("value"), "flagged", "n_seen")


@query
def resolve_boolean(spark, sf_dir):
    rows = claims_ledger(spark, sf_dir).withColumn("flag", (c("discount") > 0.05).cast("int").cast("double")).withColumn("field", F.lit("flag"))
    return ledger.resolved(rows, ["txn", "field"], value="flag", boolean=True).select("txn", "flag", "flagged", "n_seen")


def _typed(spark, sf_dir):
    rows = claims_ledger(spark, sf_dir)
    keep = ["txn", "source", "tier", "confidence", "seq"]
    amounts = rows.select(*keep, F.lit("price").alias("field"), c("price").alias("value"), F.lit(None).cast("string").alias("text"))
    kinds = rows.select(*keep, F.lit("currency").alias("field"), F.lit(None).cast("double").alias("value"), c("currency").alias("text"))
    return amounts.unionByName(kinds)


@query
def typed_sibling_pick(spark, sf_dir):
    own = ledger.by_sibling(_typed(spark, sf_dir), "price", "currency", "USD")
    return ledger.resolved(own, ["txn"]).select("txn", "value", "flagged")


@query
def anchor_qualifiers(spark, sf_dir):
    rows = _typed(spark, sf_dir)
    won = ledger.resolved(rows.where("field = 'price'"), ["txn"])
    own = ledger.anchored(rows, won, "price", "currency")
    return ledger.resolved(own.drop("value").withColumnRenamed("text", "currency"), ["txn"], value="currency").select("txn", "currency", "flagged")


@query
def ledger_diff(spark, sf_dir):
    rows = claims_ledger(spark, sf_dir).select(c("part").alias("txn"), F.lit("quantity").alias("field"), c("quantity").alias("value"), c("quantity").cast("int").cast("string").alias("text"), "filed", F.struct("seq", "txn").alias("seq"))
    return ledger.differences(rows, ["1"])


@query
def field_priority(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    return ledger.by_priority(o, ["o_custkey"], F.substring("o_orderpriority", 1, 1), [c("o_orderdate"), c("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query
def ledger_values_exploded(spark, sf_dir):
    rows = view(spark, sf_dir, "orders").select("o_orderkey", F.array(F.struct(c("o_totalprice").alias("amount"), F.lit("USD").alias("currency")), F.struct(F.lit(None).cast("double").alias("amount"), c("o_orderstatus").alias("currency"))).alias("values"))
    out = ledger.exploded(rows, ["o_orderkey"], "values", "value.", ["amount", "currency"])
    return out.where("field = 'currency' OR value IS NOT NULL").select("o_orderkey", "fact_key", "field", F.when(c("field") == "currency", c("value")).alias("value"))


@query
def ledger_insert_ignore(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select(c("o_custkey").alias("txn"), c("o_orderstatus").alias("text"), c("o_orderkey").alias("seq"))
    return ledger.inserted(o.where("seq % 3 = 0").groupBy("txn", "text").agg(F.min("seq").alias("seq")), o.where("seq % 3 <> 0"), ["txn", "text"])


# ---- derivations


@query
def derive_multiples(spark, sf_dir):
    d = deals(spark, sf_dir)
    m = derive.multiples(c("event"), c("value_amount"), c("value_currency"), c("financials_currency"), c("announced"), revenue=(c("revenue"), c("revenue_period"), c("revenue_end")), ebitda=(c("ebitda"), c("ebitda_period"), c("ebitda_end")))
    return d.select("deal_id", m.alias("m")).select("deal_id", "m.*")


@query
def derive_ev_bridge(spark, sf_dir):
    d = deals(spark, sf_dir).withColumn("equity", derive.equity_value(c("event"), c("value_type"), c("value_amount"))).withColumn("implied", derive.implied_equity(c("equity"), c("pct")))
    d = d.withColumn("nd", derive.net_debt(c("reported_net_debt"), c("debt_currency"), c("total_debt"), c("debt_currency"), c("debt_as_of"), c("cash"), c("debt_currency"), c("cash_as_of")))
    d = d.withColumn("ev", derive.implied_ev(c("value_type"), c("value_amount"), c("implied"), c("value_currency"), c("nd")))
    return d.select("deal_id", "equity", c("implied").alias("implied_equity"), c("nd.value").alias("net_debt"), c("nd.basis").alias("net_debt_basis"), c("ev.value").alias("implied_ev"), c("ev.basis").alias("ev_basis"))


@query
def derive_transaction_value(spark, sf_dir):
    minor = derive.minority(c("event"), c("pct"), c("transition"))
    d = deals(spark, sf_dir).withColumn("equity", derive.equity_value(c("event"), c("value_type"), c("value_amount"))).withColumn("minor", minor)
    below = c("minor") == 1
    d = d.withColumn("tv", derive.transaction_value(c("event"), c("value_type"), c("value_amount"), c("equity"), c("value_currency"), c("total_debt"), c("debt_currency"), ~below & c("event").isin(derive.CONTROL), below))
    d = d.withColumn("size", derive.transaction_size(c("event"), c("round_size"), c("tv.value")))
    return d.select("deal_id", c("tv.value").alias("transaction_value"), c("tv.basis").alias("value_basis"), c("size.value").alias("transaction_size"), c("size.basis").alias("size_basis"), derive.unanimous(c("value_currency"), c("debt_currency")).alias("currency"))


@query
def derive_flags(spark, sf_dir):
    d = deals(spark, sf_dir)
    return d.select(
        "deal_id", derive.minority(c("event"), c("pct"), c("transition")).alias("is_minority"),
        derive.take_private(c("event"), c("target_status"), c("target_type"), c("acquirer_type"), c("private_outcome")).alias("is_take_private"),
        derive.secondary_buyout(c("event"), c("said_secondary"), c("buyer_sponsor"), c("seller_sponsor")).alias("is_secondary"),
        derive.status(c("history"), F.when(c("deal_id") % 9 == 0, c("announced"))).alias("status"),
        text.precision(c("revenue_end")).alias("revenue_precision"), text.precision(c("ebitda_end")).alias("ebitda_precision"),
    )


@query
def derive_consideration(spark, sf_dir):
    form = lambda x: F.when(x % 6 == 0, "CASH").when(x % 6 == 1, "ACQUIRER_STOCK").when(x % 6 == 2, "EARNOUT").when(x % 6 == 3, "CVR").when(x % 6 == 4, "OTHER")
    rows = view(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(form(c("l_linenumber") + c("l_orderkey"))).alias("forms"))
    return rows.select("l_orderkey", derive.consideration_type(c("forms")).alias("consideration"), derive.has_form(c("forms"), "EARNOUT").alias("has_earnout"), derive.has_form(c("forms"), "CVR").alias("has_cvr"))


# ---- names, labels, texts


@query
def clean_claims(spark, sf_dir):
    d = claims(spark, sf_dir).withColumn("round", text.funding_round(c("label")))
    return d.select("id", text.percentage(c("pct")).alias("pct"), "round", text.round_stage(c("round")).alias("stage"), text.reason_code(c("reason"), c("relevant")).alias("reason"), text.proceeds(c("uses")).alias("uses"))


@query
def clean_names(spark, sf_dir):
    d = claims(spark, sf_dir).withColumn("parsed", text.name_list(c("names")))
    return d.select("id", text.company_name(c("company")).alias("company"), F.array_join("parsed.names", "|").alias("names"), c("parsed.status").alias("status"))


@query
def text_money_ticker(spark, sf_dir):
    d = claims(spark, sf_dir).withColumn("m", text.money(c("news")))
    return d.select("id", F.size("m").cast("long").alias("n_mentions"), F.get("m", 0)["amount"].alias("first_amount"), F.get("m", 1)["amount"].alias("second_amount"), text.ticker(c("news")).alias("ticker"))


@query
def dedup_content_hash(spark, sf_dir):
    d = view(spark, sf_dir, "documents").select("doc_id", text.content_hash(c("text")).alias("hash"))
    return d.groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies"))


@query
def dedup_url_then_hash(spark, sf_dir):
    p = view(spark, sf_dir, "pages").where("trim(url) <> ''").select("page_id", "url", text.content_hash(c("html")).alias("hash"))
    p = relational.first_by(p, ["url"], ["page_id"])
    return relational.first_by(p, ["hash"], ["page_id"])


@query
def body_quality(spark, sf_dir):
    p = view(spark, sf_dir, "pages")
    body = F.regexp_replace("html", "<[^>]*>", " ")
    marker = F.when(c("page_id") % 7 == 0, "Access denied ").when(c("page_id") % 7 == 2, "We use cookies here ").when(c("page_id") % 7 == 3, "Attention Required! now ").otherwise("")
    return p.select("page_id", text.body_rejection(F.concat(marker, body), F.when(c("page_id") % 2 == 0, c("html"))).alias("reason"))


@query
def body_quality_whole(spark, sf_dir):
    p = view(spark, sf_dir, "pages")
    return p.select("page_id", text.body_rejection(F.regexp_replace("html", "<[^>]*>", " "), c("html")).alias("reason"))


@query
def html_title(spark, sf_dir):
    return view(spark, sf_dir, "pages").select("page_id", text.html_title(c("html")).alias("title"), F.regexp_extract("url", r"^https?://([^/:?#]+)", 1).alias("host"))


# ---- clusters and joins


@query
def cluster_islands(spark, sf_dir):
    e = view(spark, sf_dir, "events").where("event_type = 'purchase'").select("event_id", "user_id", c("ts").cast("date").alias("day"))
    out = cluster.islands(e, "user_id", "day", 1)
    return out.groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n_events"), F.min("event_id").alias("first_event"), F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day")).withColumn("island", c("island").cast("long"))


@query
def cluster_fuzzy(spark, sf_dir):
    names = view(spark, sf_dir, "part").select(F.lower("p_name").alias("name"), "p_partkey")
    typo = names.unionByName(names.where("p_partkey % 5 = 0").withColumn("name", F.concat(F.col("name"), F.lit("s"))))
    cluster.shared_checkpoints(spark)
    labels = cluster.components(cluster.similar_names(typo))
    own = typo.groupBy("name").agg(F.min("p_partkey").alias("first_part"), F.count(F.lit(1)).alias("n_rows"))
    joined = own.join(labels, own.name == labels.node, "left").withColumn("cluster", F.coalesce("label", "name"))
    return joined.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_names"), F.sum("n_rows").alias("n_rows"), F.min("first_part").alias("first_part"), cluster.cluster_id(F.collect_set("name"), F.lit(None).cast("string"), F.min("first_part")).alias("cluster_id"))


@query
def nearest_filing(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select(c("o_orderkey").alias("k"), c("o_orderdate").cast("date").alias("day"))
    rows = view(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("k"), c("l_shipdate").cast("date").alias("filed"), c("l_partkey").alias("part"))
    return relational.nearest(o, rows, "k", "day", "filed", "part", 30, 7).withColumn("day", c("day").cast("string"))


@query
def semi_triggered(spark, sf_dir):
    seen = view(spark, sf_dir, "lineitem").where("l_discount > 0.09").select(c("l_orderkey").alias("o_orderkey"))
    return view(spark, sf_dir, "orders").join(seen, "o_orderkey", "left_semi").select("o_orderkey", "o_orderstatus")


@query
def anti_unlabelled(spark, sf_dir):
    return view(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(view(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query
def left_on_predicate(spark, sf_dir):
    good = view(spark, sf_dir, "labels").where("quality = 1").select("doc_id", "toxic")
    return view(spark, sf_dir, "documents").select("doc_id", "lang").join(good, "doc_id", "left")


@query
def scalar_counts(spark, sf_dir):
    n = view(spark, sf_dir, "orders").groupBy(c("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"), F.count_distinct("o_orderstatus").alias("n_states"))
    cust = view(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(n, "c_custkey", "left")
    return cust.select("c_custkey", "c_mktsegment", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), F.coalesce("n_states", F.lit(0)).alias("n_states"))


@query
def having_dupes(spark, sf_dir):
    return dealt(view(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_partkey").alias("n_parts")).where("n > 1 AND n_parts > 1")


@query
def flag_pivot(spark, sf_dir):
    has = lambda kind: F.max(F.when(c("event_type") == kind, 1).otherwise(0)).alias(f"has_{kind}")
    return view(spark, sf_dir, "events").groupBy("user_id").agg(has("click"), has("view"), has("purchase"))


@query
def uniqlist(spark, sf_dir):
    t = view(spark, sf_dir, "conversations")
    n = t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    return relational.first_seen_list(t, ["conv_id"], c("role"), c("turn"), "roles").join(n, "conv_id")


@query
def json_agg(spark, sf_dir):
    rows = view(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("t"))
    return rows.select("conv_id", F.to_json(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["turn"].alias("turn")))).alias("turns"))


@query
def coverage(spark, sf_dir):
    d = deals(spark, sf_dir)
    names = ["pct", "total_debt", "cash", "reported_net_debt", "value_currency", "transition"]
    return d.select(*[c(n).cast("string").alias(n) for n in names]).unpivot([], names, "column", "value").groupBy("column").agg(F.count("value").alias("filled"))


# ---- sinks as snapshots


@query
def upsert_owned_columns(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), c("o_orderstatus").alias("state"), c("o_totalprice").alias("price"), c("o_orderpriority").alias("note"))
    old = o.where("id % 4 <> 0").withColumn("version", F.lit(1))
    new = o.where("id % 2 = 0").withColumn("state", F.when(c("id") % 3 == 0, F.lit(None)).otherwise(F.lit("X"))).withColumn("price", c("price") + 1)
    return relational.upserted(old, new, "id", ["state", "price"], "version")


@query
def soft_delete_latest(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), c("o_orderstatus").alias("state"))
    old = o.where("id % 4 <> 0").withColumn("is_current", F.lit(1))
    return relational.superseded(old, o.where("id % 2 = 0").withColumn("state", F.lit("N")), "id")


@query
def replace_children(spark, sf_dir):
    rows = view(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    new = rows.where("l_orderkey % 10 = 0 AND l_linenumber = 1").withColumn("l_quantity", c("l_quantity") + 100)
    return relational.replaced(rows, new, "l_orderkey")


@query
def update_from_join(spark, sf_dir):
    cust = view(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    last = view(spark, sf_dir, "orders").groupBy(c("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal")).where("c_custkey % 2 = 0")
    return relational.updated(cust, last, "c_custkey", ["c_acctbal"])


# ---- participants


@query
def participant_entities(spark, sf_dir):
    rows = view(spark, sf_dir, "conversations").select(c("conv_id").cast("string").alias("txn"), c("role").alias("name"), c("turn").alias("seq"))
    return participants.entities(rows)


@query
def investor_collapse(spark, sf_dir):
    rows = view(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("txn"), F.concat(F.lit("Fund "), c("l_suppkey") % 7, F.lit(", Inc.")).alias("name"), (c("l_returnflag") == "R").alias("is_lead"), F.when(c("l_linestatus") == "F", (c("l_linenumber") % 2).cast("int")).alias("is_new"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("seq"))
    return participants.investors(rows)


@query
def parent_names(spark, sf_dir):
    rows = view(spark, sf_dir, "orders").select(c("o_custkey").alias("txn"), F.concat(F.lit("Parent "), c("o_orderkey") % 3).alias("name"), c("o_orderkey").alias("seq"))
    return participants.parents(rows)


# ---- profiles, samples, scores


@query
def profile_columns(spark, sf_dir):
    return relational.profile(view(spark, sf_dir, "pages").select("page_id", "url", "html"), ["page_id", "url", "html"])


@query
def profile_pages(spark, sf_dir):
    return relational.full_profile(view(spark, sf_dir, "pages").select("page_id", "url", "html"), ["page_id", "url", "html"])


@query
def percentiles_nearest(spark, sf_dir):
    d = view(spark, sf_dir, "documents")
    rest = d.groupBy("source").agg(F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.floor(F.avg("n_chars")).cast("long").alias("mean"))
    return relational.nearest_ranks(d, "source", "n_chars", {f"p{int(p * 100)}": p for p in (0.1, 0.5, 0.9)}).join(rest, "source")


@query
def topk_hosts(spark, sf_dir):
    return relational.top(view(spark, sf_dir, "pages").select(F.regexp_extract("url", r"^https?://([^/:?#]+)", 1).alias("host")), "host", 10)


@query
def stratified_sample(spark, sf_dir):
    d = view(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    strata = [("long", c("n_chars") > 3000, 40), ("french", c("lang") == "fr", 25), ("first_source", c("source") == "src0", 15), ("rest", F.lit(True), 30)]
    return relational.stratified(d, strata, "doc_id")


@query
def score_precision(spark, sf_dir):
    d = view(spark, sf_dir, "documents").join(view(spark, sf_dir, "labels"), "doc_id")
    guess = d.select("quality", (c("n_chars") > 500).cast("int").alias("guess"), "lang")
    return guess.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum((c("quality") == c("guess")).cast("int")).alias("correct"), F.round(F.avg((c("quality") == c("guess")).cast("double")), 6).alias("precision")).withColumn("passed", (c("precision") >= 0.9).cast("int"))


@query
def funnel(spark, sf_dir):
    return view(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("n_users"), F.round(F.percentile("value", F.lit(0.5)), 6).alias("median_value"))


@query
def qa_checks(spark, sf_dir):
    o, rows = view(spark, sf_dir, "orders"), view(spark, sf_dir, "lineitem")
    one = lambda name, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")
    early = rows.join(o, c("l_orderkey") == c("o_orderkey")).where("l_shipdate < o_orderdate")
    return one("orders_without_lines", o.join(rows, c("o_orderkey") == c("l_orderkey"), "left_anti")).unionByName(one("shipped_before_order", early)).unionByName(one("null_currency", deals(spark, sf_dir).where("value_currency IS NULL"))).unionByName(one("repeated_lines", having_dupes(spark, sf_dir)))


@query
def set_difference(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return relational.disagreements(o.where("o_orderkey % 3 = 0"), o.where("o_orderkey % 5 = 0"))


@query
def lineage(spark, sf_dir):
    n, cust, o = view(spark, sf_dir, "nation"), view(spark, sf_dir, "customer"), view(spark, sf_dir, "orders")
    return n.join(cust, c("n_nationkey") == c("c_nationkey"), "left").join(o, c("c_custkey") == c("o_custkey"), "left").groupBy("n_name").agg(F.count_distinct("c_custkey").alias("n_customers"), F.count("o_orderkey").alias("n_orders"))
