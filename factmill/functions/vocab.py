"""Vocabulary maps, display formats, typed comparison and lenient JSON, as column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legacy words and what they are now.
LEGACY_EVENTS = {"ANNOUNCEMENT": "ANNOUNCED", "CLOSE": "CLOSED", "AMENDMENT": "AMENDED", "TERMINATION": "TERMINATED"}
EVENTS = ["ANNOUNCED", "CLOSED", "AMENDED", "TERMINATED"]
LEGACY_PERIODS = {"FY": "ANNUAL", "CY": "ANNUAL", "TTM": "LTM", "QUARTER": "QUARTERLY"}
TARGET_TYPES = {"STANDALONE_COMPANY": "standalone_company", "BUSINESS_UNIT": "business_unit", "SUBSIDIARY": "subsidiary", "ASSETS": "assets"}
RETIRED_BUYERS = {"consortium": "unknown"}
BLANKS = ["", "none", "null"]
TOLERANCE = 0.01


def mapped(value: Column, table: dict[str, str]) -> Column:
    """The table's word, or the value itself."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), value), value)


def lifecycle(current: Column, legacy: Column) -> Column:
    """The event history, from the current field or else the legacy one."""
    old = mapped(legacy, LEGACY_EVENTS)
    return F.when(current.isin(EVENTS), current).when(old.isin(EVENTS), old).otherwise(current)


def event_type(current: Column, legacy: Column, mechanism: Column, valid: list[str]) -> Column:
    split = F.when(mechanism == "EXCHANGE_OFFER", "SPLIT_OFF").otherwise("SPIN_OFF")
    return F.when(current.isin(valid), current).when(legacy == "SPIN_SPLIT", split).when(legacy.isin(valid), legacy).otherwise(current)


def period(value: Column) -> Column:
    """UNKNOWN is null."""
    return F.nullif(mapped(value, LEGACY_PERIODS), F.lit("UNKNOWN"))


def shown_multiple(value: Column, quality: Column) -> Column:
    """Two decimals, NM where the multiple isn't meaningful, blank for null."""
    return F.when(value.isNull(), "").when(quality == "NM", "NM").otherwise(F.format_string("%.2f", value))


def symbol(ticker: Column) -> Column:
    """A ticker without its exchange."""
    return F.trim(F.element_at(F.split(ticker, ":"), -1))


def present(value: Column) -> Column:
    text = F.trim(value.cast("string"))
    return F.when(~F.lower(text).isin(BLANKS), text)


def equal(gold: Column, made: Column, kind: str) -> Column:
    """Typed equality: enum and date without case, numeric within 1 % of gold; two blanks are equal."""
    g, p = present(gold), present(made)
    same = F.upper(g) == F.upper(p)
    if kind == "numeric":
        gn, pn = g.try_cast("double"), p.try_cast("double")
        close = F.when(gn == 0, pn == 0).otherwise(F.abs(gn - pn) / F.abs(F.nullif(gn, F.lit(0.0))) <= TOLERANCE)
        same = F.when(gn.isNotNull() & pn.isNotNull(), close).otherwise(same)
    return F.when(g.isNull() & p.isNull(), True).otherwise(F.coalesce(same, F.lit(False)))


def lenient_json(text: Column) -> Column:
    """The JSON object in an answer: inside a fence, or from the first brace to the last; null if it doesn't parse."""
    body = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(F.from_json(body, "map<string,string>").isNotNull() & (body != ""), body)


def shown_number(value: Column) -> Column:
    """Whole numbers without a fraction, blank for null."""
    return F.when(value.isNull(), "").when(value == F.floor(value), F.floor(value).cast("long").cast("string")).otherwise(value.cast("string"))


def shown_flag(value: Column) -> Column:
    """Y, N or blank."""
    return F.when(value.isNull(), "").when(value.cast("int") != 0, "Y").otherwise("N")


def shown_pair(kind: Column, end: Column) -> Column:
    """A period as its kind and end, as far as they are told."""
    return F.concat_ws(" / ", F.nullif(F.trim(kind), F.lit("")), F.nullif(F.trim(end), F.lit("")))


def shown_multiples(ltm: Column, ntm: Column) -> Column:
    """``LTM=x.x`` and ``NTM=x.x``, as far as they are told."""
    one = lambda name, v: F.when(v.isNotNull(), F.concat(F.lit(f"{name}="), F.format_string("%.1f", F.round(v, 1)), F.lit("x")))
    return F.concat_ws(" | ", one("LTM", ltm), one("NTM", ntm))


def shown_period(kind: Column, end: Column) -> Column:
    """A period as gold labels write it: FY2024, CY2024, LTM and NTM with the day, Q3 2024."""
    k, year = F.upper(kind), F.substring(end, 1, 4)
    month = F.substring(end, 6, 2).try_cast("int")
    quarter = F.when(month.isNotNull(), F.concat(F.lit("Q"), (F.floor((month - 1) / 3) + 1).cast("string"), F.lit(" "), year)).otherwise(F.concat(F.lit("Q "), end))
    told = (
        F.when(k.isin("FY", "FISCAL_YEAR"), F.concat(F.lit("FY"), year)).when(k.isin("CY", "CALENDAR_YEAR"), F.concat(F.lit("CY"), year))
        .when(k.isin("LTM", "TTM", "NTM"), F.concat(k, F.lit(" "), end)).when(k == "QUARTER", quarter).otherwise(F.concat(kind, F.lit(" "), end))
    )
    return F.when(F.coalesce(kind, F.lit("")).isin("", "UNKNOWN"), end).when(F.coalesce(end, F.lit("")) == "", kind).otherwise(told)


def canonical_json(text: Column) -> Column:
    """JSON with its keys in order, so that equal values are equal texts; other texts as they are."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def notes_with(notes: Column, key: str, value: Column) -> Column:
    """Notes, a JSON object, with one entry set to a JSON value; nested values stay as they are.

    Notes that aren't an object are kept under ``raw``.
    """
    v = F.try_parse_json(notes)
    own = F.when(F.schema_of_variant(v).startswith("OBJECT"), F.try_variant_get(v, "$", "map<string,variant>"))
    raw = F.when(F.trim(notes) != "", F.create_map(F.lit("raw"), F.try_variant_get(F.try_parse_json(F.to_json(F.array(notes))), "$[0]", "variant")))
    old, new = F.coalesce(F.map_filter(own, lambda k, x: k != key), raw), F.create_map(F.lit(key), F.try_parse_json(value))
    return canonical_json(F.to_json(F.when(old.isNull(), new).otherwise(F.map_concat(old, new))))
