"""Column builders for the valuation model of a resolved deal.

Each function reads named columns of the row and gives one column or a struct. Amounts
are doubles; nothing is assumed where a source is silent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event families, stake transitions, buyers of take-privates, consideration forms.
FUNDING = ["VC_ROUND", "GROWTH_EQUITY", "VENTURE_DEBT"]
CONTROL = ["ACQUISITION", "MERGER"]
PURCHASES = ["ACQUISITION", "MERGER", "REVERSE_MERGER"]
MINORITY_TRANSITIONS = ["NEW_MINORITY_STAKE", "MINORITY_ACQUIRING_MAJORITY", "MAJORITY_ACQUIRE_REMAINING", "MAJORITY_INCREASING_STAKE", "MINORITY_INCREASING_STAKE"]
PRIVATE_BUYERS = ["private_equity", "pe_portfolio", "management", "employee_group", "other_financial_sponsor"]
TERM_FORMS = ["EARNOUT", "CVR", "CONTINGENT_CONSIDERATION", "DEBT_ASSUMED", "RETAINED_EQUITY"]
STOCK_FORMS = ["ACQUIRER_STOCK", "TARGET_STOCK"]

_none = lambda kind="double": F.lit(None).cast(kind)


def usable(left: Column, right: Column) -> Column:
    """Both currencies known and equal."""
    return F.coalesce((left == right) & (left != ""), F.lit(False))


def status(event_history: Column, closed_date: Column) -> Column:
    return F.when(event_history == "TERMINATED", "TERMINATED").when(closed_date.isNotNull() | (event_history == "CLOSED"), "CLOSED").otherwise("PENDING")


def consideration_type(forms: Column) -> Column:
    """From an array of component forms: what was offered, terms set aside."""
    offered = F.array_except(F.filter(forms, lambda f: f.isNotNull()), F.array(*map(F.lit, TERM_FORMS)))
    within = lambda *allowed: F.forall(offered, lambda f: f.isin(*allowed))
    return F.when(F.coalesce(F.size(offered), F.lit(0)) <= 0, _none("string")).when(within("CASH"), "CASH").when(within(*STOCK_FORMS), "STOCK").when(within("CASH", *STOCK_FORMS), "CASH_AND_STOCK").otherwise("OTHER")


def has_form(forms: Column, form: str) -> Column:
    return F.coalesce(F.array_contains(forms, form), F.lit(False)).cast("int")


def minority(event: Column, pct: Column, transition: Column) -> Column:
    return F.when(event == "MINORITY_INVESTMENT", 1).when(pct.isNotNull(), (pct < 50).cast("int")).when(transition.isin(MINORITY_TRANSITIONS), 1).otherwise(0)


def take_private(event: Column, target_status: Column, target_type: Column, acquirer_type: Column, outcome: Column) -> Column:
    yes = (event == "ACQUISITION") & (target_status == "PUBLIC") & (F.lower(F.trim(target_type)) == "standalone_company") & F.lower(F.trim(acquirer_type)).isin(PRIVATE_BUYERS) & (F.coalesce(outcome, F.lit(0)) != 0)
    return F.coalesce(yes, F.lit(False)).cast("int")


def secondary_buyout(event: Column, explicit: Column, buyer_sponsor: Column, seller_sponsor: Column) -> Column:
    both = event.isin(CONTROL) & (buyer_sponsor == 1) & (seller_sponsor == 1)
    return F.coalesce((F.coalesce(explicit, F.lit(0)) != 0) | both, F.lit(False)).cast("int")


def unanimous(*currencies: Column) -> Column:
    """The one currency present, null if there are none or several."""
    found = F.array_distinct(F.array_compact(F.array(*currencies)))
    return F.when(F.size(found) == 1, F.get(found, 0))


def equity_value(event: Column, value_type: Column, amount: Column) -> Column:
    return F.when(~F.coalesce(event.isin(FUNDING), F.lit(False)) & (value_type == "EQUITY_VALUE") & (amount > 0), amount)


def equity_with_basis(event: Column, value_type: Column, amount: Column) -> Column:
    """struct(value, basis): the equity value of the stake, and STATED where there is one."""
    value = equity_value(event, value_type, amount).cast("double")
    return F.struct(value.alias("value"), F.when(value.isNotNull(), "STATED").alias("basis"))


def implied_equity(equity: Column, pct: Column) -> Column:
    """Grossed up to the whole company by a stated percentage."""
    return F.when((equity > 0) & (pct > 0), F.when(pct < 100, F.round(equity / (pct / 100), 2)).otherwise(equity))


def net_debt(reported: Column, reported_ccy: Column, debt: Column, debt_ccy: Column, debt_as_of: Column, cash: Column, cash_ccy: Column, cash_as_of: Column) -> Column:
    """struct(value, currency, as_of, basis): reported, else debt less cash of one balance sheet."""
    same = debt.isNotNull() & cash.isNotNull() & usable(debt_ccy, cash_ccy) & usable(debt_as_of, cash_as_of)
    pack = lambda v, c, a, b: F.struct(v.alias("value"), c.alias("currency"), a.alias("as_of"), b.alias("basis"))
    text = _none("string")
    return (
        F.when(reported.isNotNull(), pack(reported, reported_ccy, text, F.lit("REPORTED")))
        .when(same, pack(F.round(debt - cash, 2), debt_ccy, debt_as_of, F.lit("CALCULATED_TOTAL_DEBT_MINUS_CASH_ST")))
        .otherwise(pack(_none(), text, text, text))
    )


def implied_ev(value_type: Column, amount: Column, equity: Column, equity_ccy: Column, debt: Column) -> Column:
    """struct(value, basis); ``debt`` is the struct of ``net_debt``."""
    stated = (value_type == "ENTERPRISE_VALUE") & (amount > 0)
    able = equity.isNotNull() & debt["value"].isNotNull() & usable(equity_ccy, debt["currency"])
    basis = F.when(debt["basis"] == "REPORTED", "IMPLIED_EQUITY_PLUS_REPORTED_NET_DEBT").otherwise("IMPLIED_EQUITY_PLUS_CALCULATED_NET_DEBT")
    pack = lambda v, b: F.struct(v.alias("value"), b.alias("basis"))
    return F.when(stated, pack(amount, F.lit("STATED"))).when(able, pack(F.round(equity + debt["value"], 2), basis)).otherwise(pack(_none(), _none("string")))


def transaction_value(event: Column, value_type: Column, amount: Column, equity: Column, equity_ccy: Column, debt: Column, debt_ccy: Column, control: Column, below_control: Column) -> Column:
    """struct(value, basis): stated, else equity by control status, with gross debt where it may be added."""
    pack = lambda v, b: F.struct(v.alias("value"), F.lit(b).alias("basis"))
    none = F.struct(_none().alias("value"), _none("string").alias("basis"))
    return (
        F.when(event.isin(FUNDING), none)
        .when((value_type == "TRANSACTION_VALUE") & (amount > 0), pack(amount, "STATED"))
        .when(equity.isNull(), none)
        .when(below_control, pack(equity, "EQUITY_BELOW_CONTROL"))
        .when(~control, none)
        .when(debt.isNotNull() & usable(equity_ccy, debt_ccy), pack(F.round(equity + debt, 2), "EQUITY_PLUS_TOTAL_DEBT"))
        .otherwise(pack(equity, "EQUITY_VALUE_ONLY"))
    )


def transaction_size(event: Column, round_size: Column, value: Column) -> Column:
    """struct(value, basis): round size for funding, transaction value for purchases, nothing else."""
    pack = lambda v, b: F.struct(v.alias("value"), F.lit(b).alias("basis"))
    return F.when(event.isin(FUNDING) & (round_size > 0), pack(round_size, "ROUND_SIZE")).when(event.isin(PURCHASES) & (value > 0), pack(value, "TRANSACTION_VALUE")).otherwise(F.struct(_none().alias("value"), _none("string").alias("basis")))


def multiples(event: Column, ev: Column, ccy: Column, fin_ccy: Column, announced: Column, **metrics: tuple[Column, Column, Column]) -> Column:
    """struct of ev_to_<metric>_ltm/_ntm and multiple_quality; a metric is (value, period type, period end)."""
    ranges = {"revenue": (0.1, 50.0), "ebitda": (1.0, 100.0)}  # fixed values
    mismatch = F.coalesce((ccy != fin_ccy) & (ccy != "") & (fin_ccy != ""), F.lit(False))
    base = F.coalesce((ev > 0) & ~F.coalesce(event.isin(FUNDING), F.lit(False)), F.lit(False))
    fields, good, bad = [], F.lit(False), F.lit(False)
    day = lambda c: F.try_to_date(F.substring(F.trim(c), 1, 10), "yyyy-MM-dd")
    for name, (value, period, end) in metrics.items():
        p = F.upper(period)
        end_day = F.when(F.trim(end).rlike("^[0-9]{4}$"), F.try_to_date(F.concat(F.trim(end), F.lit("-12-31")), "yyyy-MM-dd")).otherwise(day(end))
        age = F.datediff(day(announced), end_day)
        ltm = F.coalesce(p.isin("LTM", "TTM") | ((p == "ANNUAL") & age.between(0, 455)), F.lit(False))
        ntm = F.coalesce(p == "NTM", F.lit(False))
        usable_here = base & F.coalesce(value > 0, F.lit(False)) & (ltm | ntm)
        multiple = F.round(ev / value, 2)
        lo, hi = ranges[name]
        inside = F.coalesce(multiple.between(lo, hi), F.lit(False))
        good = good | (usable_here & ~mismatch & inside)
        bad = bad | (usable_here & (mismatch | ~inside))
        fields += [F.when(usable_here & ~mismatch & which, multiple).alias(f"ev_to_{name}_{slot}") for slot, which in (("ltm", ltm), ("ntm", ntm & ~ltm))]
    return F.struct(*fields, F.when(good, "CALCULATED").when(bad, "NM").otherwise("NOT_CALCULABLE").alias("multiple_quality"))
