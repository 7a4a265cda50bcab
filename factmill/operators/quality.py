"""Checks of the warehouse, scores against gold labels, remediation plans and review sheets.

Each check gives rows (check, txn, detail), so that a report is a union and a count.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factmill.functions import vocab
from factmill.functions.extracted import is_group_label
from factmill.operators.cluster import similarity
from factmill.operators.relational import joined_list
from factmill.operators.shared import dealt, left_joined

SEATS = {"target_name": ("TARGET", ["TARGET"]), "acquirer_name": ("BUYER", ["ACQUIRER", "BUYER_PLATFORM"]), "parent_seller_name": ("SELLER", ["PARENT_SELLER"]), "acquirer_sponsor_name": ("BUYER", ["BUYER_SPONSOR"])}
# Fixed value: names that stand for a group.
SYNTHETIC_GROUP = r"(?i)^(buyer group|investor group|seller group|consortium|acquirer group)$|(\bbuyer group\b|\binvestor group\b|\bseller group\b|\bconsortium\b)"
FUNDING_FAMILY = ["VC_ROUND", "GROWTH_EQUITY", "VENTURE_DEBT", "MINORITY_INVESTMENT"]
STRING_MATCH = 90.0


def _found(name: str, rows: DataFrame, detail: Column) -> DataFrame:
    return rows.select(F.lit(name).alias("check"), F.col("txn").cast("string").alias("txn"), detail.cast("string").alias("detail"))


def _all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def missing_seats(records: DataFrame, participants: DataFrame) -> DataFrame:
    """Named parties of a record that no current participant takes; a group's generic label is an exception of its own."""
    at = lambda column, side, roles: F.max((F.col("side") == side) & F.col("role").isin(roles)).alias(f"__{column}")
    seated = dealt(participants.where("is_current = 1").select(F.col("txn").alias("__t"), "side", "role"), "__t").groupBy("__t").agg(*[at(column, *seat) for column, seat in SEATS.items()])
    rules = []
    for column in SEATS:
        name = F.when(is_group_label(F.col(column)), "acquirer_group_label").otherwise(f"{column}_without_seat") if column == "acquirer_name" else F.lit(f"{column}_without_seat")
        lost = (F.trim(F.coalesce(column, F.lit(""))) != "") & ~F.coalesce(f"__{column}", F.lit(False))
        rules += [F.when(lost, F.struct(name.alias("check"), F.col(column).cast("string").alias("detail")))]
    rows = records.select("txn", *SEATS).join(seated, F.col("txn") == F.col("__t"), "left").select("txn", F.explode(F.array_compact(F.array(*rules))).alias("r"))
    return rows.select("r.check", F.col("txn").cast("string").alias("txn"), "r.detail")


def repeated(rows: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Keys that more than one row bears; nulls are equal."""
    n = dealt(rows.select("txn", *keys), "txn").groupBy("txn", *keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _found(name, n, F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.col("n").cast("string")))


def synthetic_entities(entities: DataFrame, evidence: list[str]) -> DataFrame:
    """Entities named like a group of which no column tells that they are organisations."""
    bare = F.forall(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in evidence]), lambda v: v == "") if evidence else F.lit(True)
    return _found("synthetic_group_entity", entities.where(F.col("name").rlike(SYNTHETIC_GROUP) & bare), F.col("name"))


def lost_facts(records: DataFrame, ledger: DataFrame, columns: list[str]) -> DataFrame:
    """Fields that were observed though the record's column is null: one pass over each, joined by (txn, field)."""
    empty = records.select("txn", F.explode(F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda x: x.isNotNull())).alias("field"))
    seen = ledger.where((F.col("is_current") == 1) & ~F.coalesce(F.trim("text"), F.lit("")).isin("", "null")).select("txn", "field").distinct()
    return _found("fact_lost", empty.join(seen, ["txn", "field"], "left_semi"), F.col("field"))


def record_checks(records: DataFrame, retired: list[str], counted: list[str]) -> DataFrame:
    """Dates out of order, assets without their type and the other way, retired fields, records that are nearly empty."""
    assets = F.coalesce(F.lower("target_type") == "assets", F.lit(False))
    filled = sum((F.when(F.col(c).isNotNull() & ~F.col(c).cast("string").isin("", "0"), 1).otherwise(0) for c in counted), F.lit(0))
    least = max(6, int(0.12 * len(counted)))
    rules = [
        F.when(F.col("closed_date") < F.col("announced_date"), F.struct(F.lit("closed_before_announced").alias("check"), F.concat_ws("|", "closed_date", "announced_date").alias("detail"))),
        F.when(assets & (F.coalesce("asset_type", F.lit("")) == ""), F.struct(F.lit("assets_without_type").alias("check"), F.lit("").alias("detail"))),
        F.when(~assets & (F.coalesce("asset_type", F.lit("")) != ""), F.struct(F.lit("type_without_assets").alias("check"), F.col("asset_type").alias("detail"))),
        F.when(F.coalesce("target_name", F.lit("")) == "", F.struct(F.lit("no_target").alias("check"), F.lit("").alias("detail"))),
        *[F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != "0"), F.struct(F.lit("retired_field").alias("check"), F.lit(c).alias("detail"))) for c in retired],
        F.when(filled < least, F.struct(F.lit("nearly_empty").alias("check"), filled.cast("string").alias("detail"))),
    ]
    rows = records.select("txn", F.explode(F.array_compact(F.array(*rules))).alias("r"))
    return rows.select("r.check", F.col("txn").cast("string").alias("txn"), "r.detail")


def cardinality(sources: DataFrame, extractions: DataFrame, records: DataFrame) -> DataFrame:
    """check, n_left, n_right: sources against extractions, and clusters against records."""
    n = lambda df, count, check, side: df.agg(count.alias("n")).select(F.lit(check).alias("check"), F.lit(side).alias("side"), "n")
    parts = [
        n(sources, F.count_distinct("source"), "sources_extractions", 0), n(extractions, F.count(F.lit(1)), "sources_extractions", 1),
        n(extractions, F.count_distinct("txn"), "clusters_records", 0), n(records, F.count(F.lit(1)), "clusters_records", 1),
    ]
    return _all(parts).groupBy("check").agg(F.max(F.when(F.col("side") == 0, F.col("n"))).alias("n_left"), F.max(F.when(F.col("side") == 1, F.col("n"))).alias("n_right"))


def currency_gap(records: DataFrame) -> DataFrame:
    """name, n: enterprise values that rest on a net debt whose currency can't be known, and the counts around them."""
    calculated = F.col("ev").isNotNull() & F.col("ev_basis").isNotNull() & (F.col("ev_basis") != "STATED")
    debt, ours, theirs = F.col("net_debt").isNotNull(), F.col("net_debt_currency"), F.col("deal_currency")
    rules = {
        "with_ev": F.col("ev").isNotNull(), "stated_ev": F.col("ev").isNotNull() & (F.col("ev_basis") == "STATED"), "calculated_ev": calculated, "with_net_debt": debt,
        "currency_mismatch": ours != theirs, "missing_net_debt_currency": debt & ours.isNull(), "at_risk": calculated & debt & (ours.isNull() | theirs.isNull()), "calculated_without_net_debt": calculated & ~debt,
    }
    wide = records.agg(*[F.count(F.when(rule, 1)).alias(name) for name, rule in rules.items()])
    return wide.unpivot([], list(rules), "name", "n")


def family_integrity(records: DataFrame) -> DataFrame:
    """Fundings whose size claims to be a transaction's value."""
    return _found("funding_sized_by_value", records.where((F.col("size_basis") == "TRANSACTION_VALUE") & F.col("event").isin(FUNDING_FAMILY)), F.col("event"))


def trace(sources: DataFrame, extractions: DataFrame, records: DataFrame) -> DataFrame:
    """source, url, extraction, status, event, cluster, txn: from each source to its record; a source without rows stays."""
    e = extractions.select(F.col("source").alias("__s"), "extraction", "status", "event", F.col("txn").alias("cluster"))
    r = dealt(records.where("is_current = 1").select("txn"), "txn").distinct()
    rows = left_joined(sources.join(dealt(e, "__s"), F.col("source") == F.col("__s"), "left"), r, "cluster", "txn")
    return rows.select("source", "url", "extraction", F.coalesce("status", F.lit("(no staging row)")).alias("status"), "event", "cluster", "txn")


# ---- scores against gold labels


def first_match(gold: DataFrame, extractions: DataFrame, records: DataFrame) -> DataFrame:
    """Each gold label with the record of its source's first extraction that has one."""
    own = extractions.join(records, "txn").groupBy("source").agg(F.min_by(F.struct(*records.columns), "extraction").alias("__r"))
    return gold.join(own.withColumnRenamed("source", "__s"), F.col("source") == F.col("__s"), "inner").drop("__s")


def equal(gold: Column, made: Column, kind: str) -> Column:
    """Typed equality; strings by token-set ratio, with case."""
    if kind != "string":
        return vocab.equal(gold, made, kind)
    g, m = vocab.present(gold), vocab.present(made)
    return F.when(g.isNull() & m.isNull(), True).when(g.isNull() | m.isNull(), False).otherwise(similarity(g, m) >= STRING_MATCH)


def scores(pairs: DataFrame, fields: dict[str, tuple[str, float | None]], spot: dict[str, str] | None = None) -> DataFrame:
    """field, n, correct, precision, passed: each field of pairs (``gold_f``, ``made_f``) by its kind, against its target.

    Fields of ``spot`` count only where the gold label says something, and have no target.
    """
    every = [(f, k, t, False) for f, (k, t) in fields.items()] + [(f, k, None, True) for f, k in (spot or {}).items()]
    told = pairs.select(*[F.when(F.lit(not blank) | vocab.present(F.col(f"gold_{f}")).isNotNull(), equal(F.col(f"gold_{f}"), F.col(f"made_{f}"), k).cast("int")).alias(f) for f, k, _, blank in every])
    long = told.unpivot([], [f for f, *_ in every], "field", "ok").groupBy("field").agg(F.count("ok").alias("n"), F.sum("ok").alias("correct"), F.round(F.avg("ok"), 6).alias("precision"))
    target = F.coalesce(*[F.when(F.col("field") == f, F.lit(t)) for f, _, t, _ in every if t is not None], F.lit(None).cast("double"))
    return long.withColumn("passed", (F.col("precision") >= target).cast("int"))


# ---- remediation and review


def remediation(rows: DataFrame, approvals: DataFrame, unresolved: DataFrame, events: list[str], tolerance: float = 0.5) -> DataFrame:
    """txn, target, staged, state, canonical, note: which rows an approved amount corrects.

    ``rows`` has txn, event, target, staged and round_size; only those without a size and with a staged amount
    are in scope. ``approvals`` (key, staged, round_size, note, seq) match by name: equal, or the key within
    the name; the first counts. A staged amount that changed since the approval is left alone.
    """
    scope = rows.where(F.col("event").isin(events) & F.col("round_size").isNull() & F.col("staged").isNotNull())
    name = F.lower(F.trim("target"))
    a = approvals.select(F.lower(F.trim("key")).alias("__k"), F.col("staged").alias("__staged"), F.col("round_size").alias("__size"), F.col("note").alias("__note"), "seq")
    u = unresolved.select(F.lower(F.trim("key")).alias("__k"), F.col("reason").alias("__why"), "seq")
    first = lambda df, cols: scope.join(df, F.contains(name, F.col("__k"))).groupBy("txn").agg(F.min_by(F.struct(*cols), "seq").alias("__m")).select(F.col("txn").alias("__t"), "__m.*")
    out = scope.join(first(a, ["__staged", "__size", "__note"]), F.col("txn") == F.col("__t"), "left").drop("__t").join(first(u, ["__why"]), F.col("txn") == F.col("__t"), "left")
    state = F.when(F.col("__why").isNotNull(), "unresolved").when(F.col("__size").isNull(), "not_approved").when(F.abs(F.col("staged") - F.col("__staged")) > tolerance, "staged_changed").otherwise("planned")
    return out.select("txn", "target", "staged", state.alias("state"), F.when(state == "planned", F.col("__size")).alias("canonical"), F.coalesce("__why", "__note").alias("note"))


def _listed(value: Column, order: Column) -> Column:
    return joined_list(value, order, " | ")


def advisor_sheet(advisors: DataFrame) -> DataFrame:
    """txn, buy_side, sell_side, unassigned: advisors as ``name (specialty)``, in the order in which they are told."""
    label = F.concat(F.col("name"), F.coalesce(F.concat(F.lit(" ("), F.nullif(F.col("specialty"), F.lit("")), F.lit(")")), F.lit("")))
    on = lambda rule: _listed(F.when(rule, label), F.col("seq"))
    side = F.coalesce(F.upper("side"), F.lit(""))
    return advisors.groupBy("txn").agg(on(side == "BUY_SIDE").alias("buy_side"), on(side == "SELL_SIDE").alias("sell_side"), on(~side.isin("BUY_SIDE", "SELL_SIDE")).alias("unassigned"))


def investor_sheet(investors: DataFrame) -> DataFrame:
    """txn, investors, leads, amounts: leads first, then by rank."""
    own = investors.withColumn("name", F.trim("name")).where("name <> ''")
    order = F.struct((-F.coalesce(F.col("is_lead"), F.lit(0))).alias("l"), F.coalesce("rank", F.lit(-1)).alias("r"), F.col("seq"))
    label = F.concat(F.col("name"), F.coalesce(F.concat(F.lit(" ("), F.nullif(F.trim("type"), F.lit("")), F.lit(")")), F.lit("")))
    paid = F.when(F.col("amount").isNotNull(), F.trim(F.concat(F.col("name"), F.lit(": "), F.col("amount").cast("decimal(38,2)").cast("string"), F.lit(" "), F.coalesce("currency", F.lit("")))))
    return own.groupBy("txn").agg(_listed(label, order).alias("investors"), _listed(F.when(F.col("is_lead") == 1, F.col("name")), order).alias("leads"), _listed(paid, order).alias("amounts"))


def review_sheets(records: DataFrame, advisors: DataFrame, investors: DataFrame, sources: DataFrame, rejected: DataFrame) -> dict[str, DataFrame]:
    """Sheets for reviewers: deals, fundings and rejected sources."""
    urls = sources.groupBy("txn").agg(_listed(F.col("url"), F.col("seq")).alias("urls"), F.count_distinct("url").alias("n_sources"))
    named = lambda df: df.withColumnRenamed("txn", "__t")

    def beside(rows: DataFrame, other: DataFrame) -> DataFrame:
        blank = {c: F.coalesce(c, F.lit(0 if c == "n_sources" else "")) for c in other.columns if c != "txn"}
        return rows.join(named(other), F.col("txn") == F.col("__t"), "left").drop("__t").withColumns(blank)

    rows = beside(beside(records, advisor_sheet(advisors)), urls)
    funding = F.col("event").isin(FUNDING_FAMILY)
    return {
        "deals": rows.where(~funding | F.col("event").isNull()),
        "fundings": beside(rows.where(funding), investor_sheet(investors)),
        "rejections": rejected.select("source", "url", "title", "reason").orderBy("reason", "source"),
    }
