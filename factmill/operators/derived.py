"""Rows and inputs derived from resolved facts: metrics, multiples, balance sheets, percentages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factmill.functions.extracted import ENTERPRISE_MULTIPLES, number, parsed, word
from factmill.functions.text import precision
from factmill.operators.writers import multiple_key

METRICS = {"REVENUE": "target_revenue", "EBITDA": "target_ebitda"}
BALANCE_SHEET_PERIOD = "POINT_IN_TIME"


def metric_rows(facts: DataFrame) -> DataFrame:
    """One row for each stated metric with its own currency and period, none of them calculated.

    ``facts`` has txn and, for each metric's column, its amount and ``_currency``, ``_period_type`` and
    ``_period_end`` beside it.
    """
    rows = [F.struct(
        F.lit(kind).alias("metric_type"), F.col(c).alias("value"), F.col(f"{c}_currency").alias("currency"), F.col(f"{c}_period_type").alias("period_type"),
        F.col(f"{c}_period_end").alias("period_end"), precision(F.col(f"{c}_period_end")).alias("precision"), F.lit(0).alias("is_calculated"),
    ) for kind, c in METRICS.items()]
    return facts.select("txn", F.explode(F.filter(F.array(*rows), lambda r: r["value"].isNotNull())).alias("r")).select("txn", "r.*")


def multiple_rows(resolved: DataFrame, kept: DataFrame) -> DataFrame:
    """One row for each resolved key ``multiple.TYPE.BASIS.END``, with the words behind its value.

    ``resolved`` has txn, field, value and flagged; flagged keys give none. ``kept`` has txn, seq and text, the
    multiples kept whole; of several that state the value the first counts.
    """
    v = F.col("__v")
    told = F.struct(multiple_key(word(v, "$.multiple_type"), word(v, "$.period_basis"), word(v, "$.period_end_date")).alias("field"), number(v, "$.multiple_value").alias("value"), word(v, "$.as_reported_text").alias("words"))
    # a generator: the conditions of the join below it would read the text again, each for itself
    said = kept.select("txn", "seq", parsed(F.col("text")).alias("__v")).select("txn", "seq", F.inline(F.array(told)))
    words = said.groupBy("txn", "field", "value").agg(F.min_by(F.struct("words"), "seq")["words"].alias("as_reported"))
    part = lambda i: F.nullif(F.regexp_extract("field", r"^multiple\.([^.]*)\.([^.]*)\.(.*)$", i), F.lit(""))
    rows = resolved.where(F.col("field").rlike(r"^multiple\.[^.]*\.[^.]*\.") & (F.col("flagged") == 0) & F.col("value").isNotNull()).join(words, ["txn", "field", "value"], "left")
    return rows.select(
        "txn", part(1).alias("multiple_type"), "value", part(2).alias("period_basis"), part(3).alias("period_end"), precision(part(3)).alias("precision"),
        F.when(part(1).isin(ENTERPRISE_MULTIPLES), "implied_enterprise_value").otherwise("implied_equity_value").alias("numerator"), F.lit("as_reported").alias("source_flag"), "as_reported",
    )


def balance_sheet(debt: Column, debt_currency: Column, debt_as_of: Column, cash: Column, cash_currency: Column, cash_as_of: Column, manual: dict[str, Column]) -> Column:
    """struct of debt and cash with the currency and date that their own sources state.

    What isn't extracted comes from the existing record (``manual``: total_debt, total_debt_currency,
    cash_st, cash_st_currency, as_of). The date to store is the one both share, or that of the only amount.
    """
    blank = lambda c: F.nullif(c, F.lit(""))
    d, c = (F.coalesce(own.cast("double"), manual[k].cast("double")) for own, k in ((debt, "total_debt"), (cash, "cash_st")))
    da = F.coalesce(blank(debt_as_of), F.when(d.isNotNull(), manual["as_of"]))
    ca = F.coalesce(blank(cash_as_of), F.when(c.isNotNull(), manual["as_of"]))
    stored = F.when(d.isNotNull() & c.isNotNull(), F.when(da.eqNullSafe(ca), da)).when(d.isNotNull(), da).otherwise(ca)
    return F.struct(
        d.alias("total_debt"), F.coalesce(blank(debt_currency), manual["total_debt_currency"]).alias("total_debt_currency"), da.alias("total_debt_as_of"),
        c.alias("cash_st"), F.coalesce(blank(cash_currency), manual["cash_st_currency"]).alias("cash_st_currency"), ca.alias("cash_st_as_of"),
        stored.alias("as_of"), F.when(d.isNotNull() | c.isNotNull(), BALANCE_SHEET_PERIOD).alias("period_type"),
    )


def percentage(pct: Column) -> Column:
    """struct(pct, source): stated only, never assumed."""
    return F.struct(pct.cast("double").alias("pct"), F.when(pct.isNotNull(), "stated").alias("source"))


def explicit(flag: Column) -> Column:
    """1 for a flag that is said, else 0."""
    return F.coalesce((flag.cast("double") != 0).cast("int"), F.lit(0))


def investment_amount() -> Column:
    """One investor's own cheque: no source states it of a transaction, so it is null."""
    return F.lit(None).cast("double")


def stated_enterprise_value(value: Column, kind: Column) -> Column:
    """struct(value, basis): the old enterprise value, where it is stated."""
    there = (kind == "ENTERPRISE_VALUE") & (value > 0)
    return F.struct(F.when(there, value.cast("double")).alias("value"), F.when(there, "STATED").alias("basis"))
