"""Ledger writers: what an extraction's row and an agreement's sections say, as observations.

Each row's claims are put together in one array and exploded once: a single pass over the
rows without a shuffle, however many groups of fields take part. What repeats within a row is
dropped in the array, the first group's claim staying. JSON that is kept whole has its keys in
order and its nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factmill.functions import extracted
from factmill.functions.extracted import NUMERIC, items, kind, number, parsed, word
from factmill.functions.scanners import bound, dated_as_of
from factmill.operators.shared import dealt, left_joined

# The fields of each extraction stage, in the order in which they are written.
CLASSIFIED_FIELDS = [
    "deal_type", "v2_event_type", "event_history_type", "recap_type", "combination_structure", "spin_split_type", "spin_split_type_v2", "distribution_mechanism",
    "target_type", "target_type_v2", "event_type", "target_status",
]
FUNDING_FIELDS = [
    "round_label", "round_size", "pre_money_valuation", "post_money_valuation", "valuation_currency", "round_currency", "facility_size", "total_raised_to_date",
    "is_extension_round", "round_price_direction", "is_bridge_round", "use_of_proceeds", "has_board_seat", "board_seat_notes", "consideration_type",
]
DEAL_FIELDS = [
    "target_name", "target_domain", "target_ticker", "acquirer_name", "acquirer_domain", "acquirer_ticker", "acquirer_type", "parent_seller_name", "parent_seller_ticker",
    "target_description", "asset_type", "acquirer_description", "acquirer_sponsor_name", "parent_seller_description", "announced_date", "closed_date", "signing_date",
    "value_amount", "value_currency", "value_type", "per_share_price", "round_size", "pct_acquired", "stake_transition_type", "offer_mechanism", "sponsor_transaction_role",
    "is_secondary_buyout", "is_merger_of_equals", "is_going_private_outcome", "target_revenue", "target_revenue_period_type", "target_revenue_period_end", "target_ebitda",
    "target_ebitda_period_type", "target_ebitda_period_end", "financials_currency", "total_debt", "total_debt_currency", "cash_st", "cash_st_currency",
    "balance_sheet_as_of_date", "acquirer_type_v2", "announced_date_precision", "closed_date_precision", "signing_date_precision", "rumor_date",
    "target_revenue_period_type_v2", "target_ebitda_period_type_v2", "financials_disclosure_status", "transaction_terms_disclosure_status",
]
TERMS_FIELDS = [
    "deal_attitude", "approach_type", "competing_bid", "regulatory_approvals_required", "has_go_shop", "go_shop_period_days", "target_fee_amount", "target_fee_percentage",
    "acquirer_fee_amount", "acquirer_fee_percentage",
]
PARTY_FIELDS = {
    "acquirers": "acquirer_party", "buy_side_sponsors": "buy_side_sponsor_party", "parent_sellers": "parent_seller_party", "parent_acquirers": "parent_acquirer_party",
    "sell_side_sponsors": "sell_side_sponsor_party", "sellers": "seller_party", "jv_partners": "jv_partner_party",
}
PROVIDER_FIELD, MARKER = "financing_provider_party", "__source_row_present"
CONSIDERATION_ATTRIBUTES = ["per_share_amount", "amount", "exchange_ratio"]
READY = ["LC_EXTRACTED", "CLUSTERED", "AGGREGATED"]

# What of an agreement's answers isn't an observation, and names that are defined terms or blanks.
NOT_OBSERVED = ["model_confidence", "notes", "prompt_version", "consideration_components", "securities", "parties"]
DEFINED_TERM = r"(?i)^(Parent|Company|Purchaser|Seller|Buyer|Target|Acquirer|SPAC|Sponsor|Issuer|Holdco|Topco|Bidco|Merger\s+Sub|Sub|Acquireco|Acquisitionco|AcquireCo)$"
PLACEHOLDER = r"(?i)\[|\]|…|\[[A-Z][^\]]*\]"
# Canonical columns and the observations that they come from.
CANONICAL = {
    "merger_structure": "merger_structure", "acquirer_merger_sub_name": "party.MERGER_SUB", "target_fee_amount": "target_termination_fee", "target_fee_percentage": "target_termination_fee_pct",
    "acquirer_fee_amount": "acquirer_termination_fee", "acquirer_fee_percentage": "acquirer_termination_fee_pct", "has_go_shop": "has_go_shop", "go_shop_period_days": "go_shop_period_days",
    "regulatory_approvals_required": "regulatory_approvals_required",
}
_CLAIM = "array<struct<field:string,text:string,number:double,fact_key:string,stage:string,version:string>>"


def _claim(field, text: Column, num=None, key=None) -> Column:
    s = lambda v: F.lit(v).cast("string") if v is None or isinstance(v, str) else v
    return F.struct(s(field).alias("field"), text.alias("text"), (F.lit(None).cast("double") if num is None else num).alias("number"), s(key).alias("fact_key"))


def _json(**fields: Column) -> Column:
    """JSON text with its keys in order; nulls stay."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in sorted(fields.items())]), {"ignoreNullFields": "false"})


def plain(value: Column) -> Column:
    """A number as text without a fraction that says nothing."""
    return F.when(value == F.floor(value), F.floor(value).cast("long").cast("string")).otherwise(value.cast("string"))


# ---- claims of one row, each an array


def fields(rows: DataFrame, names: list[str]) -> Column:
    """One claim for each of the columns that are there and not null; flags are '1' / '0' and 1.0 / 0.0."""
    out = []
    for name in names:
        if name in rows.columns:
            c, type_ = F.col(name), rows.schema[name].dataType.typeName()
            if type_ == "boolean":
                out.append(_claim(name, F.when(c, "1").when(~c, "0"), c.cast("int").cast("double")))
            else:
                out.append(_claim(name, c.cast("string"), None if type_ == "string" else c.cast("double")))
    return F.filter(F.array(*out), lambda x: x["text"].isNotNull())


def values(observations: Column) -> Column:
    """Four claims for each stated value, keyed by its place, and the value whole."""
    def one(x: Column, i: Column) -> Column:
        key = F.concat(F.lit("value_observations["), i, F.lit("]"))
        amount = number(x, "$.amount")
        w = lambda k: word(x, f"$.{k}")
        whole = _json(amount=amount, **{k: w(k) for k in extracted.VALUE_KEYS[1:]})
        own = [_claim("value_amount", plain(amount), amount, key), _claim("value_currency", w("currency"), None, key), _claim("value_type", w("type"), None, key), _claim("value_qualifier", F.coalesce(F.nullif(w("qualifier"), F.lit("")), w("basis")), None, key), _claim("value_observation", whole, None, key)]
        return F.filter(F.array(*own), lambda c: c["text"].isNotNull())

    objects = F.filter(items(parsed(observations), "$"), lambda x: kind(x, "$") == "OBJECT")
    return F.flatten(F.transform(objects, one))


def multiple_key(type_: Column, basis: Column, end: Column) -> Column:
    """The canonical key of a stated multiple; parts that aren't stated are blank."""
    return F.concat(F.lit("multiple."), type_, F.lit("."), F.coalesce(basis, F.lit("")), F.lit("."), F.coalesce(end, F.lit("")))


def multiples(reported: Column) -> Column:
    """Two claims for each stated multiple: it whole, and its number under its canonical key."""
    def one(x: Column, i: Column) -> Column:
        key, value = F.concat(F.lit("reported_multiples["), i, F.lit("]")), number(x, "$.multiple_value")
        w = lambda k: word(x, f"$.{k}")
        whole = _json(multiple_type=w("multiple_type"), multiple_value=value, **{k: w(k) for k in ("period_basis", "period_end_date", "numerator_value_type", "as_reported_text")})
        name = multiple_key(F.nullif(w("multiple_type"), F.lit("")), w("period_basis"), w("period_end_date"))
        return F.filter(F.array(_claim("reported_multiple", whole, None, key), _claim(name, F.when(name.isNotNull(), plain(value)), value, key)), lambda c: c["text"].isNotNull())

    return F.flatten(F.transform(F.filter(items(parsed(reported), "$"), lambda x: kind(x, "$") == "OBJECT"), one))


def parties(column: str, field: str) -> Column:
    """One claim for each named party of an array, keyed by its place: its name, and its type if the array tells types."""
    def one(x: Column, i: Column) -> Column:
        key, name = F.concat(F.lit(f"{column}["), i, F.lit("]")), F.nullif(word(x, "$.name"), F.lit(""))
        typed = F.when(kind(x, "$.type").isNotNull(), _json(name=name, type=word(x, "$.type"))).otherwise(_json(name=name))
        return _claim(field, F.when(name.isNotNull(), typed), None, key)

    own = F.transform(F.filter(items(parsed(F.col(column)), "$"), lambda x: kind(x, "$") == "OBJECT"), one)
    return F.filter(own, lambda c: c["text"].isNotNull())


def consideration(components: Column) -> Column:
    """The components whole, and the numbers of each form."""
    def one(x: Column) -> Column:
        form = F.coalesce(F.nullif(word(x, "$.form"), F.lit("")), F.lit("UNKNOWN"))
        own = [_claim(F.concat(F.lit("consideration."), form, F.lit(f".{a}")), plain(number(x, f"$.{a}")), number(x, f"$.{a}")) for a in CONSIDERATION_ATTRIBUTES]
        return F.filter(F.array(*own), lambda c: c["text"].isNotNull())

    whole = F.filter(F.array(_claim("consideration_components", components)), lambda c: c["text"].isNotNull())
    return F.concat(whole, F.flatten(F.transform(F.filter(items(parsed(components), "$"), lambda x: kind(x, "$") == "OBJECT"), one)))


# ---- rows of the ledger


def _staged(claims: Column, stage: str, version) -> Column:
    v = F.lit(None).cast("string") if version is None else version
    return F.transform(claims, lambda c: F.struct(c["field"].alias("field"), c["text"].alias("text"), c["number"].alias("number"), c["fact_key"].alias("fact_key"), F.lit(stage).alias("stage"), v.alias("version"))).cast(_CLAIM)


def observations(staging: DataFrame, stage: str, classified: bool = False, deal: bool = False, terms: bool = False, funding: bool = False) -> DataFrame:
    """All observations of staging rows for the groups asked for.

    ``staging`` has txn, extraction, source, tier, source_type, confidence, published, the prompt versions
    dt_version, hc_version and lc_version, and whichever fields there are; arrays are JSON text. Every
    row gives a marker. With ``stage`` BACKFILL all are stamped so, else each by its own stage.
    Funding comes before the deal's fields, as both have the round's size and the first stays.
    """
    own = lambda name: "BACKFILL" if stage == "BACKFILL" else name
    there = lambda c: c in staging.columns
    groups = [_staged(F.array(_claim(MARKER, F.lit("1"))), stage, None)]
    if classified:
        groups.append(_staged(fields(staging, CLASSIFIED_FIELDS), own("DT_CLASSIFY"), F.col("dt_version")))
    if funding:
        groups.append(_staged(fields(staging, FUNDING_FIELDS), own("FUNDING_HC_EXTRACT"), F.col("hc_version")))
    if deal:
        parts = [fields(staging, DEAL_FIELDS)]
        parts += [values(F.col("value_observations"))] if there("value_observations") else []
        parts += [multiples(F.col("reported_multiples"))] if there("reported_multiples") else []
        parts += [parties(c, f) for c, f in PARTY_FIELDS.items() if there(c)]
        groups += [_staged(p, own("HC_EXTRACT"), F.col("hc_version")) for p in parts]
    if terms:
        parts = [fields(staging, TERMS_FIELDS)]
        parts += [parties("financing_providers", PROVIDER_FIELD)] if there("financing_providers") else []
        parts += [consideration(F.col("consideration_components"))] if there("consideration_components") else []
        groups += [_staged(p, own("LC_EXTRACT"), F.col("lc_version")) for p in parts]
    same = lambda a, b: (a["field"] == b["field"]) & (a["text"] == b["text"]) & a["fact_key"].eqNullSafe(b["fact_key"])
    # only the round's size, which two groups have, and equal components can come twice: other claims needn't be looked for
    twice = lambda c: (c["field"] == "round_size") | c["field"].startswith("consideration.")
    once = lambda all_: F.filter(all_, lambda c, i: ~twice(c) | ~F.exists(F.slice(all_, 1, i), lambda e: same(e, c)))
    keys = ["txn", "extraction", "source", "tier", "source_type", "published"]
    rows = staging.select(*keys, "confidence", F.explode(bound(F.concat(*groups), once)).alias("c"))
    confidence = F.when(F.col("c.field") == MARKER, F.coalesce("confidence", F.lit("MEDIUM"))).otherwise(F.col("confidence"))
    filing = F.when(F.col("source_type").startswith("SEC_"), F.col("source_type"))
    return rows.select(*keys, confidence.alias("confidence"), filing.alias("filing_type"), "c.*")


def backfilled(staging: DataFrame) -> DataFrame:
    """All groups of the rows that are clustered and ready."""
    return observations(staging.where(F.col("txn").isNotNull() & F.col("status").isin(READY)), "BACKFILL", True, True, True, True)


def with_transactions(ledger: DataFrame, staging: DataFrame) -> DataFrame:
    """Observations without a transaction take that of their extraction."""
    known = dealt(staging.select(F.col("extraction").alias("__e"), F.col("txn").alias("__t")), "__e")
    return ledger.join(known, F.col("extraction") == F.col("__e"), "left").withColumn("txn", F.coalesce("txn", "__t")).drop("__e", "__t")


def with_provenance(ledger: DataFrame, documents: DataFrame) -> DataFrame:
    """What observations from documents lack of provenance: filing type, source type, tier, stage, the agreement's date."""
    docs = documents.select(F.col("document").alias("__d"), F.col("filing_type").alias("__f"), dated_as_of(F.col("raw_text")).cast("string").alias("__a"))
    rows = left_joined(ledger, docs, "document", "__d")
    there = F.col("document").isNotNull()
    fill = {"filing_type": F.col("__f"), "source_type": F.col("__f"), "tier": F.lit("T1"), "stage": F.lit("AGREEMENT_EXTRACT"), "agreement_dated_as_of": F.col("__a")}
    return rows.select(*[F.coalesce(F.col(c), F.when(there, fill[c])).alias(c) if c in fill else F.col(c) for c in ledger.columns])


# ---- agreements


def _legal_name(name: Column) -> Column:
    return F.nullif(F.trim(F.when(~F.trim(name).rlike(DEFINED_TERM) & ~name.rlike(PLACEHOLDER), name)), F.lit(""))


def agreement_observations(results: DataFrame) -> DataFrame:
    """Observations of section results: (txn, document, section, filing_type, filed, answer) to field, text, number, as_of.

    Scalars as they are, but for unknown structures; securities, components and parties under compound
    names. Names that are defined terms or blanks to fill in aren't observed.
    """
    keys, key, x, y = ["txn", "document", "section", "filing_type", "filed"], F.col("__key"), F.col("__x"), F.col("__y")
    security, component, party = (key == name for name in ("securities", "consideration_components", "parties"))
    scalar = ~(security | component | party)
    # members, elements and their values become rows, so that each is read by compiled columns, and as few as can be: a read of a
    # variant costs most. What is exploded is a column of before, and rows of nothing are dropped last: a filter would work its column out a second time below
    members = results.select(*keys, F.try_variant_get(parsed(F.col("answer")), "$", "map<string,variant>").alias("__m")).select(*keys, F.explode_outer("__m").alias("__key", "__value"))
    members = members.where(security | component | party | ~key.isin(NOT_OBSERVED))
    each = members.withColumn("__x", F.when(scalar, F.array("__value")).otherwise(items(F.col("__value"), "$"))).select(*keys, "__key", F.explode_outer("__x").alias("__x"))

    def told(value: Column, *field: Column, as_of: Column | None = None) -> Column:
        return F.struct(F.concat(*field).alias("field"), value.alias("y"), (F.lit(None).cast("string") if as_of is None else as_of).alias("as_of"))

    part = lambda path: F.try_variant_get(x, path, "variant")
    form, role, shares_class = F.coalesce(word(x, "$.form"), F.lit("UNKNOWN")), F.nullif(word(x, "$.role"), F.lit("")), F.nullif(word(x, "$.security_class"), F.lit(""))
    shares = told(part("$.shares_outstanding"), F.lit("shares_outstanding."), F.coalesce(word(x, "$.security_type"), F.lit("UNKNOWN")), F.coalesce(F.concat(F.lit("."), shares_class), F.lit("")), as_of=word(x, "$.shares_outstanding_as_of"))
    each = each.withColumn("__type", F.when(component, form).when(party, role))
    values = F.when(scalar, F.array(told(x, key))).when(security, F.array(shares)).when(party, F.array(told(part("$.name"), F.lit("party."), F.col("__type"))))
    values = values.otherwise(F.array(*[told(part(f"$.{a}"), F.lit("consideration."), F.col("__type"), F.lit(f".{a}")) for a in CONSIDERATION_ATTRIBUTES]))
    said = each.select(*keys, "__key", values.alias("__v")).select(*keys, "__key", F.explode_outer("__v").alias("__v"))
    said = said.select(*keys, "__key", F.col("__v.field").alias("__field"), F.col("__v.as_of").alias("__as_of"), F.col("__v.y").alias("__y")).withColumn("__kind", kind(y, "$"))

    k, n, said_word = F.col("__kind"), F.col("__n"), F.col("__word")
    said = said.withColumn("__n", F.when(~party & k.isin(NUMERIC), F.try_variant_get(y, "$", "double")).when(scalar & (k == "BOOLEAN"), F.try_variant_get(y, "$", "boolean").cast("int").cast("double")))
    said = said.withColumn("__word", F.when(party | (scalar & n.isNull() & ~k.isin("ARRAY", "OBJECT", "VOID")), word(y, "$")))
    text = F.when(party, F.when(F.col("__field").isNotNull(), _legal_name(said_word))).when(k == "BOOLEAN", F.when(n == 1, "True").when(n == 0, "False")).otherwise(F.coalesce(plain(n), said_word))
    text = F.when((key == "merger_structure") & (said_word == "UNKNOWN"), None).otherwise(text)
    rows = said.select(*keys, F.array(F.struct(F.col("__field").alias("field"), text.alias("text"), n.alias("number"), F.col("__as_of").alias("as_of"))).alias("__c"))
    rows = rows.select(*keys, F.explode_outer("__c").alias("c")).where("c.text IS NOT NULL").select(*keys, "c.*")
    return rows.distinct().withColumn("tier", F.lit("T1")).withColumn("stage", F.lit("AGREEMENT_EXTRACT"))


def applied_rows(record: DataFrame, results: DataFrame, ranks: dict[str, dict[str, int]]) -> DataFrame:
    """The record with what agreements say of its columns, and conflicts: array<struct<field, old, new>>.

    ``results`` as above with section_type. Recitals give the structure and the first merger
    subsidiary with a legal name, termination and conditions their own columns, consideration its
    components whole. Of several documents the best-ranked filing type for the column counts
    (``ranks``: column to filing type to rank; none is worst), then the latest; columns without
    ranks take the latest. One aggregate tells all columns of a record, combined before its shuffle.
    """
    results = results.withColumn("__v", parsed(F.col("answer")))  # a column of its own, so that it is read once
    v = F.col("__v")
    flag = lambda path: F.when(kind(v, path) == "BOOLEAN", F.try_variant_get(v, path, "boolean").cast("int").cast("string"))
    amount = lambda path: plain(number(v, path))
    subs = F.filter(items(v, "$.parties"), lambda x: word(x, "$.role") == "MERGER_SUB")
    structure = F.when(word(v, "$.merger_structure") != "UNKNOWN", F.nullif(word(v, "$.merger_structure"), F.lit("")))
    whole = F.when(F.size(items(v, "$.consideration_components")) > 0, F.to_json(F.try_variant_get(v, "$.consideration_components", "variant")))
    told = {
        "RECITALS": {"merger_structure": structure, "acquirer_merger_sub_name": _legal_name(word(F.get(subs, 0), "$.name"))},
        "TERMINATION_FEES": {
            "target_fee_amount": amount("$.target_termination_fee"), "target_fee_percentage": amount("$.target_termination_fee_pct"), "acquirer_fee_amount": amount("$.acquirer_termination_fee"),
            "acquirer_fee_percentage": amount("$.acquirer_termination_fee_pct"), "has_go_shop": flag("$.has_go_shop"), "go_shop_period_days": amount("$.go_shop_period_days"),
        },
        "CONDITIONS_TO_CLOSING": {"regulatory_approvals_required": flag("$.regulatory_approvals_required")},
        "CONSIDERATION": {"consideration_components": whole},
    }
    names = [c for own in told.values() for c in own if c in record.columns]
    values = {c: F.when(F.col("section_type") == s, value) for s, own in told.items() for c, value in own.items() if c in names}
    rows = results.select("txn", "document", "section", "filed", "filing_type", *[v.alias(f"__{c}") for c, v in values.items()])

    def last(column: str) -> Column:
        own = ranks.get(column)
        rank = F.coalesce(*[F.when(F.col("filing_type") == t, n) for t, n in own.items()], F.lit(1 << 30)) if own is not None else F.lit(0)
        at = F.struct((-rank).alias("rank"), "filed", "document", "section")
        return F.max_by(f"__{column}", F.when(F.col(f"__{column}").isNotNull(), at)).alias(f"__{column}")

    wide = rows.groupBy(F.col("txn").alias("__t")).agg(*[last(c) for c in names])
    joined = record.join(wide, F.col("txn") == F.col("__t"), "left")
    text = lambda c: plain(F.col(c)) if record.schema[c].dataType.typeName() not in ("string", "boolean") else F.col(c).cast("string")
    pairs = [F.struct(F.lit(c).alias("field"), text(c).alias("old"), F.col(f"__{c}").alias("new")) for c in names]
    clash = F.filter(F.array(*pairs), lambda p: p["old"].isNotNull() & p["new"].isNotNull() & (p["old"] != p["new"]))
    return joined.select(*[F.coalesce(F.col(f"__{c}").try_cast(record.schema[c].dataType.simpleString()), F.col(c)).alias(c) if c in names else F.col(c) for c in record.columns], clash.alias("conflicts"))


def applied(record: DataFrame, results: DataFrame, ranks: dict[str, dict[str, int]]) -> tuple[DataFrame, DataFrame]:
    """The record as ``applied_rows`` gives it, and the conflicts as rows: (txn, field, old, new)."""
    rows = applied_rows(record, results, ranks)
    return rows.drop("conflicts"), rows.select("txn", F.explode("conflicts").alias("p")).select("txn", "p.*")


def securities(results: DataFrame) -> DataFrame:
    """Security rows of capitalisation sections, one for each security with a type."""
    one = lambda x: F.struct(
        word(x, "$.security_type").alias("security_type"), word(x, "$.security_type_as_reported").alias("as_reported"), word(x, "$.security_class").alias("security_class"),
        number(x, "$.shares_outstanding").alias("shares"), word(x, "$.shares_outstanding_as_of").alias("as_of"), number(x, "$.weighted_avg_strike_price").alias("strike"), F.nullif(F.substring(word(x, "$.notes"), 1, 500), F.lit("")).alias("notes"),
    )
    listed = F.filter(F.transform(F.filter(items(parsed(F.col("answer")), "$.securities"), lambda x: kind(x, "$") == "OBJECT"), one), lambda s: F.coalesce(s["security_type"], F.lit("")) != "")
    return results.where("section_type = 'CAPITALIZATION'").select("txn", "document", "section", F.explode(listed).alias("s")).select("txn", "document", "section", "s.*")


def cleared(record: DataFrame, ledger: DataFrame, canonical: dict[str, str] | None = None) -> DataFrame:
    """The record without values whose observations are gone; consideration needs any of its compound fields.

    ``ledger`` has txn, field and is_current.
    """
    canonical = CANONICAL if canonical is None else canonical
    live = ledger.where("is_current = 1").groupBy(F.col("txn").alias("__t")).agg(
        *[F.max(F.col("field") == f).alias(f"__{c}") for c, f in canonical.items()], F.max(F.col("field").startswith("consideration.")).alias("__consideration_components"),
    )
    rows = record.join(live, F.col("txn") == F.col("__t"), "left")
    owned = [*canonical, "consideration_components"]
    return rows.select(*[F.when(F.col(f"__{c}"), F.col(c)).alias(c) if c in owned else F.col(c) for c in record.columns])
