"""Validation and cleaning of extraction answers: JSON objects read as variants, all native.

Rules that make an answer unusable give a short reason (null: none), the first that holds; the
others clean: items that can't stand are dropped, and values outside a vocabulary become null or
its catch-all. Arrays come back as arrays of structs, empty where the answer has none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factmill.functions.scanners import bound
from factmill.functions.vocab import mapped

# Vocabularies of the deal classifier's answers.
EVENT_TYPES = ["ACQUISITION", "SPIN_OFF", "SPLIT_OFF", "JOINT_VENTURE", "RECAPITALIZATION", "VC_ROUND", "GROWTH_EQUITY", "VENTURE_DEBT", "PIPE", "UNKNOWN"]
HISTORIES = ["ANNOUNCED", "CLOSED", "AMENDED", "TERMINATED"]
LEGACY_HISTORIES = ["ANNOUNCEMENT", "CLOSE", "AMENDMENT", "TERMINATION"]
TARGET_STATUSES = ["PUBLIC", "PRIVATE", "SUBSIDIARY_OF_PUBLIC", "SUBSIDIARY_OF_PRIVATE", "UNKNOWN"]
RECAPS = ["DIVIDEND", "EQUITY", "LEVERAGED", "SPONSOR_RECAP"]
COMBINATIONS = ["MERGER", "REVERSE_MERGER", "DE_SPAC"]
TARGET_KINDS = ["standalone_company", "business_unit", "subsidiary", "assets", "STANDALONE_COMPANY", "BUSINESS_UNIT", "SUBSIDIARY", "ASSETS"]
LEGACY_SPINS = {"SPLIT": "SPLIT_OFF"}

# Required keys and vocabularies of the deal extraction's answers.
DEAL_KEYS = [
    "target", "acquirer", "parent_seller", "dates", "value", "value_observations", "features", "target_financials", "acquirers",
    "buy_side_sponsors", "parent_sellers", "parent_acquirers", "sell_side_sponsors", "sellers", "jv_partners", "reported_multiples",
    "model_confidence", "deal", "financials_disclosure_status", "transaction_terms_disclosure_status",
]
PARTY_ARRAYS = ["acquirers", "buy_side_sponsors", "parent_sellers", "parent_acquirers", "sell_side_sponsors", "sellers", "jv_partners"]
VALUE_TYPES = ["EQUITY_VALUE", "TRANSACTION_VALUE", "ENTERPRISE_VALUE", "MARKET_CAPITALIZATION", "UNDISCLOSED"]
RETIRED_VALUE_TYPES = ["MARKET_CAPITALIZATION"]
VALUE_KEYS = ["amount", "currency", "type", "basis", "qualifier", "evidence"]
DISCLOSURES = ["DISCLOSED", "UNDISCLOSED", "UNKNOWN"]
TRANSITIONS = [
    "NEW_MINORITY_STAKE", "NEW_MAJORITY_STAKE", "FULL_ACQUISITION", "MINORITY_ACQUIRING_MAJORITY", "MAJORITY_ACQUIRE_REMAINING",
    "MINORITY_ACQUIRING_REMAINING", "MAJORITY_INCREASING_STAKE", "MINORITY_INCREASING_STAKE",
]
ASSET_TYPES = [
    "REAL_ESTATE", "INFRASTRUCTURE", "ENERGY", "NATURAL_RESOURCES", "INTELLECTUAL_PROPERTY", "DATA", "FACILITY", "EQUIPMENT",
    "CONTRACTS_OR_RIGHTS", "BRAND_OR_PRODUCT", "OTHER",
]
PRECISIONS = ["exact", "month", "quarter", "year"]
BUYER_TYPES = [
    "strategic_corporate", "private_equity", "pe_portfolio", "venture_capital", "growth_equity", "sovereign_wealth_fund", "pension_fund",
    "hedge_fund", "family_office", "individual", "management", "employee_group", "spac", "other_financial_sponsor", "unknown",
]
RETIRED_BUYER_TYPES = {"consortium": "unknown", "CONSORTIUM": "unknown"}
MULTIPLE_TYPES = ["EV_REVENUE", "EV_EBITDA", "EV_EBIT", "EV_FCF", "PE", "PB", "PTBV"]
ENTERPRISE_MULTIPLES = ["EV_REVENUE", "EV_EBITDA", "EV_EBIT", "EV_FCF"]
MULTIPLE_PERIODS = ["LTM", "NTM", "ANNUAL", "QUARTERLY"]

# Required keys and vocabularies of the funding and the terms extraction, and of rationales.
FUNDING_KEYS = ["company", "investors", "round", "dates", "financials_disclosure_status", "transaction_terms_disclosure_status", "model_confidence"]
INVESTOR_TYPES = ["vc_firm", "growth_equity", "corporate_vc", "family_office", "hedge_fund", "sovereign_wealth_fund", "angel", "accelerator", "lender", "unknown"]
PRICE_DIRECTIONS = ["UP", "DOWN", "FLAT"]
TERMS_KEYS = ["advisors", "consideration_components", "flags", "go_shop", "termination_fees", "model_confidence"]
FORMS = ["CASH", "ACQUIRER_STOCK", "TARGET_STOCK", "EARNOUT", "CVR", "CONTINGENT_CONSIDERATION", "DEBT_ASSUMED", "RETAINED_EQUITY", "OTHER"]
ATTITUDES, APPROACHES = ["FRIENDLY", "HOSTILE"], ["SOLICITED", "UNSOLICITED"]
SPECIALTIES = [
    "financial_advisory", "legal", "accounting", "fairness_opinion", "regulatory", "tax", "proxy_solicitation", "information_agent",
    "communications", "financing_advisory",
]
ADVISOR_TYPES, ADVISED_PARTIES, SIDES = ["FINANCIAL", "LEGAL", "OTHER"], ["TARGET", "ACQUIRER", "PARENT_SELLER", "BOTH", "UNKNOWN"], ["BUY_SIDE", "SELL_SIDE"]
RATIONALES = [
    "SCALE_CONSOLIDATION", "GEOGRAPHIC_EXPANSION", "PRODUCT_OR_TECH_CAPABILITY", "VERTICAL_INTEGRATION", "MARKET_DIVERSIFICATION",
    "TALENT_ACQUISITION", "FINANCIAL_OR_ARBITRAGE", "OTHER",
]
RATIONALE_KEYS = ["rationale", "secondary_rationales", "supporting_excerpt_index", "model_confidence", "notes"]
GROUP_LABELS = (
    r"(?i)^(buyer group|investor group|seller group|consortium|acquirer group)$"
    r"|(\bgroup\s+(led|formed|organized|comprised)\s+by\b)|(\b(consortium|investor group|buyer group)\s+led\s+by\b)|(\bconsortium\b)"
)


# ---- reading variants


def parsed(answer: Column) -> Column:
    """The answer as a variant; null if it isn't JSON."""
    return F.try_parse_json(answer)


NUMERIC = ["BIGINT", "DOUBLE", "DECIMAL", "FLOAT", "INT", "SMALLINT", "TINYINT"]


def kind(v: Column, path: str) -> Column:
    """ARRAY, OBJECT, STRING, BOOLEAN, a numeric type, VOID for a JSON null; null if there is nothing."""
    return F.regexp_extract(F.schema_of_variant(v if path == "$" else F.try_variant_get(v, path, "variant")), "^[A-Z]+", 0)


def word(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def number(v: Column, path: str) -> Column:
    """A JSON number; strings and booleans aren't."""
    return F.when(kind(v, path).isin(NUMERIC), F.try_variant_get(v, path, "double"))


def items(v: Column, path: str) -> Column:
    """The elements of an array, as variants; empty if it isn't one."""
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def entries(v: Column, path: str) -> Column:
    """An object's members, as a map; null if it isn't one."""
    return F.try_variant_get(v, path, "map<string,variant>")


def not_list(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "array<variant>").isNull()


def _outside(value: Column, words: list[str]) -> Column:
    return value.isNotNull() & ~value.isin(words)


def _reasons(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that holds."""
    return F.coalesce(*[F.when(rule, name) for name, rule in rules])


def _missing(v: Column, keys: list[str]) -> Column:
    return F.size(F.array_except(F.array(*map(F.lit, keys)), F.coalesce(F.map_keys(entries(v, "$")), F.array().cast("array<string>")))) > 0


def judged(rows: DataFrame, answers: dict[str, tuple[str, Callable[[Column], Column]]]) -> DataFrame:
    """rows with a reason for each of ``answers``: name to the column of an answer and its rules; every answer is read once, as a column of its own."""
    rows = rows.select("*", *[parsed(F.col(a)).alias(f"__{name}") for name, (a, _) in answers.items()])
    return rows.select("*", *[rules(F.col(f"__{name}")).alias(name) for name, (_, rules) in answers.items()]).drop(*[f"__{n}" for n in answers])


# ---- classification


def spin_type(value: Column) -> Column:
    return mapped(value, LEGACY_SPINS)


def _resolved_event(event: Column, legacy: Column, mechanism: Column) -> Column:
    split = F.when(mechanism.eqNullSafe(F.lit("EXCHANGE_OFFER")), "SPLIT_OFF").otherwise("SPIN_OFF")
    return F.when(event.isin(EVENT_TYPES), event).when(legacy == "SPIN_SPLIT", split).when(legacy.isin(EVENT_TYPES), legacy).otherwise(event)


def classification_reason(answer: Column) -> Column:
    """Why a deal classification can't be used: vocabularies, and what only some events may carry."""
    return bound(parsed(answer), classification_rules)


def classification_rules(v: Column) -> Column:
    event, legacy = word(v, "$.v2_event_type"), word(v, "$.deal_type")
    resolved = _resolved_event(event, legacy, word(v, "$.distribution_mechanism"))
    old = word(v, "$.event_type")
    recap, combination, target = word(v, "$.recap_type"), word(v, "$.combination_structure"), word(v, "$.target_type")
    spins = F.coalesce(resolved.isin("SPIN_OFF", "SPLIT_OFF"), F.lit(False)) | F.coalesce(legacy == "SPIN_SPLIT", F.lit(False))
    return _reasons(
        ("not_json", v.isNull()),
        ("event_type", _outside(event, EVENT_TYPES)), ("deal_type", _outside(legacy, [*EVENT_TYPES, "SPIN_SPLIT"])), ("no_event", resolved.isNull() & legacy.isNull()),
        ("history", ~F.coalesce(word(v, "$.event_history_type").isin(HISTORIES), F.lit(False)) & ~F.coalesce(old.isin(*HISTORIES, *LEGACY_HISTORIES), F.lit(False))),
        ("target_status", ~F.coalesce(word(v, "$.target_status").isin(TARGET_STATUSES), F.lit(False))),
        ("recap_type", F.when(resolved == "RECAPITALIZATION", _outside(recap, RECAPS)).otherwise(recap.isNotNull())),
        ("spin_fields", ~spins & (word(v, "$.spin_split_type").isNotNull() | word(v, "$.distribution_mechanism").isNotNull())),
        ("combination", combination.isNotNull() & ~(F.coalesce(resolved == "ACQUISITION", F.lit(False)) & combination.isin(COMBINATIONS))),
        ("target_type", _outside(target, TARGET_KINDS)),
    )


# ---- deals


def deal_reason(answer: Column) -> Column:
    """Why a deal extraction can't be used. Items of lists aren't judged here: bad ones are dropped when cleaned."""
    return bound(parsed(answer), deal_rules)


def deal_rules(v: Column) -> Column:
    values = items(v, "$.value_observations")
    flags = [F.coalesce(kind(v, f"$.features.{f}"), F.lit("VOID")) for f in ("is_secondary_buyout", "is_merger_of_equals", "is_going_private_outcome")]
    odd_flag = F.lit(False)
    for f in flags:
        odd_flag = odd_flag | ~f.isin("VOID", "BOOLEAN")
    parties = F.lit(False)
    for key in PARTY_ARRAYS:
        parties = parties | not_list(v, f"$.{key}")
    dates = F.lit(False)
    for f in ("announced", "closed", "signing"):
        dates = dates | _outside(word(v, f"$.dates.{f}_date_precision"), PRECISIONS)
    undisclosed = lambda f: ~F.coalesce(word(v, f"$.{f}").isin(DISCLOSURES), F.lit(False))
    keys = lambda x: F.map_keys(entries(x, "$"))
    return _reasons(
        ("not_json", v.isNull()), ("missing", _missing(v, DEAL_KEYS)), ("value_type", _outside(word(v, "$.value.type"), VALUE_TYPES)),
        ("value_list", not_list(v, "$.value_observations")),
        ("value_item", F.exists(values, lambda x: entries(x, "$").isNull())),
        ("value_keys", F.exists(values, lambda x: F.size(F.array_except(F.coalesce(keys(x), F.array().cast("array<string>")), F.array(*map(F.lit, VALUE_KEYS)))) > 0)),
        ("value_item_type", F.exists(values, lambda x: F.coalesce(_outside(word(x, "$.type"), VALUE_TYPES), F.lit(False)))),
        ("party_list", parties), ("multiple_list", not_list(v, "$.reported_multiples")),
        ("features", entries(v, "$.features").isNull()), ("feature_flag", odd_flag),
        ("financials_disclosure", undisclosed("financials_disclosure_status")), ("terms_disclosure", undisclosed("transaction_terms_disclosure_status")),
        ("transition", _outside(word(v, "$.deal.stake_transition_type"), TRANSITIONS)), ("offer", _outside(word(v, "$.deal.offer_mechanism"), ["TENDER_OFFER"])),
        ("sponsor_role", _outside(word(v, "$.deal.sponsor_transaction_role"), ["PLATFORM", "ADD_ON"])), ("asset_type", _outside(word(v, "$.target.asset_type"), ASSET_TYPES)),
        ("date_precision", dates),
    )


def buyer_type(value: Column) -> Column:
    """Retired words to unknown, legacy capitals to the vocabulary; other words as they are."""
    own = mapped(value, RETIRED_BUYER_TYPES)
    return F.when(F.lower(own).isin(BUYER_TYPES) & (own == F.upper(own)), F.lower(own)).otherwise(own)


def _named(v: Column, path: str) -> Column:
    """Elements with a name, which may be strings: struct(name, item)."""
    name = lambda x: F.trim(F.when(kind(x, "$") == "STRING", word(x, "$")).when(kind(x, "$") == "OBJECT", word(x, "$.name")))
    return F.filter(F.transform(items(v, path), lambda x: F.struct(name(x).alias("name"), x.alias("item"))), lambda x: F.coalesce(x["name"], F.lit("")) != "")


def parties(answer: Column, key: str) -> Column:
    """array<struct<name, type>> of one party array; only buyers have a type, null outside the vocabulary."""
    def typed(x: Column) -> Column:
        own = buyer_type(F.when(kind(x["item"], "$") == "OBJECT", word(x["item"], "$.type"))) if key == "acquirers" else F.lit(None).cast("string")
        return F.struct(x["name"].alias("name"), F.when(own.isin(BUYER_TYPES), own).alias("type"))

    return F.transform(_named(parsed(answer), f"$.{key}"), typed)


def providers(answer: Column) -> Column:
    """Names of the financing providers."""
    return F.transform(_named(parsed(answer), "$.financing_providers"), lambda x: x["name"])


def stated_multiples(answer: Column) -> Column:
    """Multiples of a known type with a number above zero; an unknown period becomes null, and the type decides the numerator."""
    kept = F.filter(items(parsed(answer), "$.reported_multiples"), lambda x: word(x, "$.multiple_type").isin(MULTIPLE_TYPES) & F.coalesce(number(x, "$.multiple_value") > 0, F.lit(False)))
    return F.transform(kept, lambda x: F.struct(
        word(x, "$.multiple_type").alias("multiple_type"), number(x, "$.multiple_value").alias("multiple_value"),
        F.when(word(x, "$.period_basis").isin(MULTIPLE_PERIODS), word(x, "$.period_basis")).alias("period_basis"), word(x, "$.period_end_date").alias("period_end_date"),
        F.when(word(x, "$.multiple_type").isin(ENTERPRISE_MULTIPLES), "implied_enterprise_value").otherwise("implied_equity_value").alias("numerator_value_type"),
        word(x, "$.as_reported_text").alias("as_reported_text"),
    ))


def _value(x: Column) -> Column:
    text = lambda k: word(x, f"$.{k}").alias(k)
    return F.struct(number(x, "$.amount").alias("amount"), *[text(k) for k in VALUE_KEYS[1:]])


def value_observations(answer: Column) -> Column:
    """Stated values with an amount or a type; retired types are dropped."""
    kept = F.filter(items(parsed(answer), "$.value_observations"), lambda x: (kind(x, "$") == "OBJECT") & (word(x, "$.amount").isNotNull() | word(x, "$.type").isNotNull()) & ~F.coalesce(word(x, "$.type").isin(RETIRED_VALUE_TYPES), F.lit(False)))
    return F.transform(kept, _value)


def primary_value(answer: Column) -> Column:
    """struct(amount, currency, type, qualifier, per_share_price): the first stated value that isn't retired, else the answer's own value."""
    v = parsed(answer)
    first = F.get(F.filter(items(v, "$.value_observations"), lambda x: (kind(x, "$") == "OBJECT") & (F.size(F.coalesce(F.json_object_keys(F.to_json(x)), F.array().cast("array<string>"))) > 0) & ~F.coalesce(word(x, "$.type").isin(RETIRED_VALUE_TYPES), F.lit(False))), 0)
    retired = F.coalesce(word(v, "$.value.type").isin(RETIRED_VALUE_TYPES), F.lit(False))
    own = lambda get, k: F.when(first.isNotNull(), get(first, f"$.{k}")).when(~retired, get(v, f"$.value.{k}")).alias(k)
    return F.struct(own(number, "amount"), own(word, "currency"), own(word, "type"), own(word, "qualifier"), number(v, "$.value.per_share_price").alias("per_share_price"))


def subordinate(answer: Column, target_type: Column, event: Column) -> Column:
    """struct(asset_type, jv_partners, private_outcome): facts that only some deals may carry.

    An asset type needs assets as the target, partners a joint venture; a private outcome that
    is denied is unstated.
    """
    v = parsed(answer)
    partners = F.transform(parties(answer, "jv_partners"), lambda p: p["name"])
    return F.struct(
        F.when(target_type == "assets", word(v, "$.target.asset_type")).alias("asset_type"),
        F.when(event == "JOINT_VENTURE", partners).otherwise(F.array().cast("array<string>")).alias("jv_partners"),
        F.when(F.try_variant_get(v, "$.features.is_going_private_outcome", "boolean"), 1).alias("private_outcome"),
    )


# ---- fundings, terms, rationales


def funding_reason(answer: Column) -> Column:
    return bound(parsed(answer), funding_rules)


def funding_rules(v: Column) -> Column:
    undisclosed = lambda f: ~F.coalesce(word(v, f"$.{f}").isin(DISCLOSURES), F.lit(False))
    return _reasons(
        ("not_json", v.isNull()), ("missing", _missing(v, FUNDING_KEYS)), ("financials_disclosure", undisclosed("financials_disclosure_status")),
        ("terms_disclosure", undisclosed("transaction_terms_disclosure_status")), ("investor_list", ~F.coalesce(kind(v, "$.investors") == "ARRAY", F.lit(False))),
        ("investor_type", F.exists(items(v, "$.investors"), lambda x: F.coalesce(_outside(word(x, "$.investor_type"), INVESTOR_TYPES), F.lit(False)))),
        ("price_direction", _outside(word(v, "$.round.round_price_direction"), PRICE_DIRECTIONS)),
    )


def terms_reason(answer: Column) -> Column:
    return bound(parsed(answer), terms_rules)


def terms_rules(v: Column) -> Column:
    parts = items(v, "$.consideration_components")
    no_shop = ~F.coalesce(F.try_variant_get(v, "$.go_shop.has_go_shop", "boolean"), F.lit(False))
    return _reasons(
        ("not_json", v.isNull()), ("missing", _missing(v, TERMS_KEYS)), ("advisor_list", not_list(v, "$.advisors")), ("component_list", not_list(v, "$.consideration_components")),
        ("component", F.exists(parts, lambda x: F.coalesce(kind(x, "$") != "OBJECT", F.lit(True)))),
        ("form", F.exists(parts, lambda x: ~F.coalesce(word(x, "$.form").isin(FORMS), F.lit(False)))),
        ("go_shop", no_shop & word(v, "$.go_shop.go_shop_period_days").isNotNull()),
        ("attitude", _outside(word(v, "$.flags.deal_attitude"), ATTITUDES)), ("approach", _outside(word(v, "$.flags.approach_type"), APPROACHES)),
    )


def advisors(answer: Column) -> Column:
    """Advisors with a name: array<struct<name, type, advised_party, specialty, advised_party_name, advised_side>>.

    Each fact stands alone: a specialty or side outside its vocabulary is null, the old type
    follows from the specialty or else is kept or OTHER, the old party is kept or UNKNOWN.
    """
    kept = F.filter(items(parsed(answer), "$.advisors"), lambda x: (kind(x, "$") == "OBJECT") & (F.trim(F.coalesce(word(x, "$.name"), F.lit(""))) != ""))

    def one(x: Column) -> Column:
        said = F.coalesce(F.nullif(word(x, "$.advisor_specialty"), F.lit("")), word(x, "$.specialty"))
        specialty = F.when(said.isin(SPECIALTIES), said)
        old = word(x, "$.type")
        return F.struct(
            F.trim(word(x, "$.name")).alias("name"),
            F.when(specialty == "financial_advisory", "FINANCIAL").when(specialty == "legal", "LEGAL").when(specialty.isNotNull(), "OTHER").when(old.isin(ADVISOR_TYPES), old).otherwise("OTHER").alias("type"),
            F.when(word(x, "$.advised_party").isin(ADVISED_PARTIES), word(x, "$.advised_party")).otherwise("UNKNOWN").alias("advised_party"),
            specialty.alias("specialty"), F.nullif(F.trim(word(x, "$.advised_party_name")), F.lit("")).alias("advised_party_name"),
            F.when(word(x, "$.advised_side").isin(SIDES), word(x, "$.advised_side")).alias("advised_side"),
        )

    return F.transform(kept, one)


def rationale(answer: Column) -> Column:
    """struct(reason, rationale, secondary): the validated rationale and up to two others from the vocabulary."""
    v = parsed(answer)
    first = word(v, "$.rationale")
    reason = _reasons(
        ("not_json", v.isNull()), ("missing", _missing(v, RATIONALE_KEYS)), ("rationale", ~F.coalesce(first.isin(RATIONALES), F.lit(False))),
        ("secondary_list", ~F.coalesce(kind(v, "$.secondary_rationales"), F.lit("VOID")).isin("VOID", "ARRAY")),
    )
    others = F.filter(F.transform(items(v, "$.secondary_rationales"), lambda x: word(x, "$")), lambda w: w.isin(RATIONALES) & (w != first))
    return F.struct(reason.alias("reason"), F.when(reason.isNull(), first).alias("rationale"), F.when(reason.isNull(), F.slice(others, 1, 2)).alias("secondary"))


def is_group_label(name: Column) -> Column:
    """Whether a name stands for a group rather than an organisation."""
    return F.coalesce(F.trim(name).rlike(GROUP_LABELS), F.lit(False))
