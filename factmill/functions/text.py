"""Column builders for normalisation and scanning of names, labels and page text.

Patterns are ASCII and free of look-around, so that any engine reads them alike. All
functions give null for null unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factmill.functions.scanners import bound

_WS = r"[\x20\x09-\x0D]+"

# Markers of interstitial pages, in the order in which they are tried.
DECISIVE_MARKERS = [
    "please be advised that this page is unavailable", "access to this page has been denied",
    "request unsuccessful. incapsula incident id", "incapsula incident id", "attention required!",
    "checking your browser before accessing", "verifying you are human", "enable javascript and cookies to continue",
    "please enable javascript to continue", "unusual traffic from your computer network", "cloudflare ray id",
    "ddos protection by", "pardon our interruption", "one more step before you continue", "http error 403", "error 1020",
]
GENERIC_MARKERS = [
    "this page is unavailable", "access denied", "your request has been blocked", "verify you are a human",
    "are you a robot", "please enable cookies", "automated queries", "captcha", "bot protection",
    "rate limit exceeded", "too many requests", "403 forbidden",
]
WEAK_MARKERS = [
    "temporarily unavailable", "service unavailable", "page not found", "an error occurred", "try again later",
    "open a support ticket", "support team", "javascript is disabled", "your browser is not supported",
    "subscribe to continue reading", "sign in to continue", "accept all cookies", "we use cookies", "cookie policy",
]

# Relevancy reason codes and their aliases.
REASON_CODES = [
    "ACQUISITION_ANNOUNCEMENT", "MERGER_ANNOUNCEMENT", "CARVE_OUT_OR_DIVESTITURE", "SPIN_OFF_OR_SPLIT", "TAKE_PRIVATE",
    "REVERSE_MERGER", "JOINT_VENTURE", "MINORITY_INVESTMENT", "DEAL_CLOSE_OR_COMPLETION", "DEAL_AMENDMENT_OR_TERMINATION",
    "AMBIGUOUS_BUT_LIKELY_DEAL", "VC_ROUND_OR_FUNDING", "RECAPITALIZATION", "PIPE", "PRODUCT_OR_COMMERCIAL", "PERSONNEL",
    "EARNINGS_OR_FINANCIAL_REPORTING", "BUYBACK_OR_DIVIDEND", "DEBT_OR_NON_DEAL_FINANCING", "REGULATORY_OR_COMPLIANCE",
    "MARKETING_OR_COMMENTARY", "RUMOR_OR_SPECULATION", "IPO_OR_DIRECT_LISTING", "OTHER_NOT_RELEVANT",
]
REASON_ALIASES = {
    "ACQUISITION_ANNOUNCEMENT": ["ACQUISITION", "ACQUISITION_ANNOUNCED", "ASSET_PURCHASE"],
    "MERGER_ANNOUNCEMENT": ["MERGER", "MERGER_ANNOUNCED"],
    "CARVE_OUT_OR_DIVESTITURE": ["DIVESTITURE", "CARVE_OUT"],
    "SPIN_OFF_OR_SPLIT": ["SPIN_OFF", "SPINOFF", "SPLIT"],
    "DEAL_CLOSE_OR_COMPLETION": ["DEAL_CLOSE", "DEAL_COMPLETION", "COMPLETION", "CLOSED"],
    "DEAL_AMENDMENT_OR_TERMINATION": ["TERMINATION", "TERMINATED", "AMENDMENT"],
    "VC_ROUND_OR_FUNDING": ["FUNDING", "VC_ROUND", "SEED", "PRE_SEED", "ANGEL", "GROWTH_EQUITY"],
    "RECAPITALIZATION": ["RECAP", "DIVIDEND_RECAP", "DIVIDEND_RECAPITALIZATION"],
    "PIPE": ["PIPE_FINANCING", "PIPE_TRANSACTION", "PIPE_OFFERING", "PIPE_INVESTMENT", "PRIVATE_INVESTMENT_IN_PUBLIC_EQUITY"],
}

# Uses of proceeds; words that make a percentage a bound, and those that only hedge it.
PROCEEDS_USES = [
    "HIRING", "PRODUCT_AND_TECHNOLOGY", "MANUFACTURING_AND_SUPPLY_CHAIN", "GO_TO_MARKET", "MARKET_EXPANSION",
    "FACILITIES_AND_EQUIPMENT", "REGULATORY_AND_COMPLIANCE", "ACQUISITIONS", "DEBT_REPAYMENT", "WORKING_CAPITAL",
    "GENERAL_CORPORATE", "OTHER",
]
PERCENT_BOUNDS = [
    "-", "–", "—", "+", " to ", "between", "at least", "at most", "no less", "no more", "more than", "less than",
    "greater than", "up to", "over ", "under ", "above", "below", "minimum", "maximum", "or more", "or less",
]
PERCENT_HEDGES = ["approximately", "approx.", "approx", "about", "roughly", "circa", "~"]

# Fixed value: legal suffixes of company names.
LEGAL_SUFFIX = (
    r"[,\s]*(inc\.?|incorporated|corp\.?|corporation|co\.?|company|ltd\.?|limited|llc\.?|l\.l\.c\.?|lp\.?|l\.p\.?|plc\.?|p\.l\.c\.?|"
    r"ag|s\.a\.?|s\.p\.a\.?|s\.a\.s\.?|s\.r\.l\.?|gmbh|bv|nv|holdings?|holding|group)\.?\s*$"
)


def squeezed(text: Column) -> Column:
    """White space collapsed to single blanks, trimmed."""
    return F.trim(F.regexp_replace(text, _WS, " "))


def content_hash(text: Column) -> Column:
    """SHA-256 of the squeezed, lower-cased text."""
    return F.sha2(F.lower(squeezed(text)), 256)


def company_name(name: Column) -> Column:
    """A name without parentheses, up to six legal suffixes, joiners and a leading article; blank for null."""
    out = F.regexp_replace(F.lower(F.trim(F.coalesce(name, F.lit("")))), r"\([^)]*\)", " ")
    for _ in range(6):
        out = F.trim(F.regexp_replace(out, LEGAL_SUFFIX, ""))
    out = F.regexp_replace(F.concat(F.lit(" "), F.regexp_replace(out, _WS, "  "), F.lit(" ")), r" (and|&|\+) ", " ")
    return F.regexp_replace(squeezed(out), "^the ", "")


def reason_code(code: Column, relevant: Column) -> Column:
    """The canonical reason code; never null."""
    c = F.upper(F.trim(F.coalesce(code, F.lit(""))))
    out = F.when(c.isin(REASON_CODES), c)
    for canonical, aliases in REASON_ALIASES.items():
        out = out.when(c.isin(aliases), F.lit(canonical))
    out = out.when(relevant & c.startswith("SERIES_"), F.lit("VC_ROUND_OR_FUNDING"))
    out = out.when(F.concat(c, F.lit("_ANNOUNCEMENT")).isin(REASON_CODES), F.concat(c, F.lit("_ANNOUNCEMENT")))
    return out.otherwise(F.when(relevant, "AMBIGUOUS_BUT_LIKELY_DEAL").otherwise("OTHER_NOT_RELEVANT"))


def percentage(raw: Column) -> Column:
    """A stated percentage in (0, 100]; ranges, bounds and other text give null."""
    text = F.lower(F.trim(F.regexp_replace(F.trim(raw), "%+$", "")))
    bounded = F.lit(False)
    for marker in PERCENT_BOUNDS:
        bounded = bounded | text.contains(marker)
    bare = F.lit(None).cast("string")
    for hedge in reversed(PERCENT_HEDGES):
        bare = F.when(text.startswith(hedge), F.trim(F.substring(text, len(hedge) + 1, 1000))).otherwise(F.coalesce(bare, text))
    value = F.when(bare.rlike(r"^[0-9]+(\.[0-9]*)?$|^\.[0-9]+$"), bare.try_cast("double"))
    return F.when(~bounded & (value > 0) & (value <= 100), value)


def proceeds(raw: Column) -> Column:
    """Vocabulary values of a comma list, in order, once each; null if none is left."""
    parts = F.transform(F.split(raw, ","), lambda p: F.upper(F.trim(p)))
    kept = F.array_distinct(F.filter(parts, lambda p: p.isin(PROCEEDS_USES)))
    return F.nullif(F.array_join(kept, ", "), F.lit(""))


def funding_round(label: Column) -> Column:
    """PRE_SEED, SEED, ANGEL or SERIES_x[n] from a round's wording, else null."""
    text = F.regexp_replace(F.lower(F.trim(label)), r"( extension| round| financing| funding)(\s|extension|round|financing|funding)*$", "")
    text = F.trim(text)
    letter = F.regexp_extract(text, r"^series[\s\-_]*([a-z])[\s\-_]*([0-9]*)$", 1)
    number = F.regexp_extract(text, r"^series[\s\-_]*([a-z])[\s\-_]*([0-9]*)$", 2)
    return (
        F.when(text.rlike(r"^pre[\s\-_]*seed$"), "PRE_SEED").when(text == "seed", "SEED").when(text == "angel", "ANGEL")
        .when((letter != "") & ~number.startswith("0"), F.concat(F.lit("SERIES_"), F.upper(letter), number))
    )


def round_stage(canonical: Column) -> Column:
    """The broad stage of a canonical round."""
    letter = F.when(canonical.startswith("SERIES_"), F.substring(canonical, 8, 1))
    return (
        F.when(canonical == "PRE_SEED", "PRE_SEED").when(canonical.isin("SEED", "ANGEL"), "SEED")
        .when(letter == "A", "EARLY_STAGE").when(letter.isin("B", "C"), "GROWTH").when(letter > "C", "LATE_STAGE")
    )


def _first(text: Column, markers: list[str], prefix: str) -> Column:
    """The first marker, in order, that the text holds."""
    return F.concat(F.lit(prefix), F.get(F.filter(F.array(*map(F.lit, markers)), lambda m: F.contains(text, m)), 0))


def html_title(html: Column) -> Column:
    """The text of the title element, squeezed, null if there is none."""
    found = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.nullif(squeezed(F.regexp_replace(found, "<[^>]+>", " ")), F.lit(""))


def body_rejection(text: Column, html: Column) -> Column:
    """Why a body can't be used: empty, block_page:..., too_short:n; null if it can."""

    def judged(c: Column) -> Column:
        flat, head = c["flat"], c["head"]
        blocked = F.coalesce(
            _first(head, DECISIVE_MARKERS, "block_page:body:"),
            F.when(F.length(flat) < 1500, _first(head, GENERIC_MARKERS, "block_page:short_body_marker:")),
            F.when(F.length(flat) < 600, _first(flat, WEAK_MARKERS, "block_page:short_body_marker:")),
            _first(c["title"], DECISIVE_MARKERS + GENERIC_MARKERS, "block_page:title:"),
        )
        short = F.when(c["n"] < 100, F.concat(F.lit("too_short:"), c["n"]))
        return F.when(c["n"].isNull() | (flat == ""), F.lit("empty")).otherwise(F.coalesce(blocked, short))

    whole = F.struct(F.lower(squeezed(text)).alias("flat"), F.length(text).alias("n"), F.lower(html_title(html)).alias("title"))
    return bound(whole, lambda c: bound(F.struct(c["flat"].alias("flat"), F.substring(c["flat"], 1, 500).alias("head"), c["n"].alias("n"), c["title"].alias("title")), judged))


def money(text: Column) -> Column:
    """Array of (currency, amount) for each mention of money, in order."""
    mention = r"(?i)(US\$|\$)\s?([0-9][0-9,]*(?:\.[0-9]+)?)\s*(billion|bn|million|mm|m\b|k\b|thousand)?"
    scale = lambda m: F.when(m.isin("billion", "bn"), 1e9).when(m.isin("million", "mm", "m"), 1e6).when(m.isin("k", "thousand"), 1e3).otherwise(1.0)
    parts = F.arrays_zip(F.regexp_extract_all(text, F.lit(mention), 2).alias("n"), F.regexp_extract_all(text, F.lit(mention), 3).alias("m"))
    return F.transform(parts, lambda p: F.struct(F.lit("USD").alias("currency"), (F.regexp_replace(p["n"], ",", "").try_cast("double") * scale(F.lower(p["m"]))).alias("amount")))


def ticker(text: Column) -> Column:
    """The symbol of the first exchange:symbol mention, null if there is none."""
    return F.nullif(F.regexp_extract(text, r"\((?:NYSE|NASDAQ|Nasdaq|LSE|TSX)\s*:\s*([A-Z]{1,5})\)", 1), F.lit(""))


def precision(period_end: Column) -> Column:
    """year, month or exact, read off the text's shape."""
    t = F.trim(period_end)
    return F.when(t.rlike("^[0-9]{4}$"), "year").when(F.length(t) == 7, "month").when(F.length(t) >= 10, "exact")


# Joiners that make a list of names ambiguous, and pieces that belong to the name before a comma.
UNSAFE_JOINERS = r"(?i)\b(together with|alongside|including|plus|led by|consisting of|comprised of)\b|/"
SUFFIX_PIECES = ["co", "company", "corp", "corporation", "inc", "incorporated", "llc", "lp", "llp", "ltd", "limited", "plc"]


def clean_name(name: Column) -> Column:
    """Squeezed, without quotes around it; null for blank."""
    return F.nullif(F.regexp_replace(squeezed(name), r"^[ '\"]+|[ '\"]+$", ""), F.lit(""))


def _safe_piece(p: Column) -> Column:
    bare = F.regexp_replace(p, "[^A-Za-z0-9]", "")
    words = F.size(F.filter(F.split(F.regexp_replace(p, "[^A-Za-z0-9]+", " "), " "), lambda w: w != ""))
    return (words >= 2) | ((words == 1) & bare.rlike("^[A-Z0-9]{2,}$") & bare.rlike("[A-Z]"))


def name_list(value: Column) -> Column:
    """Struct(names, status, reason): a flat list of names, split only where that is safe."""
    name = clean_name(value)
    cut = lambda by: F.filter(F.transform(F.split(name, by), clean_name), lambda p: p.isNotNull())
    suffix = lambda p: F.lower(F.regexp_replace(p, "[^A-Za-z0-9]", "")).isin(SUFFIX_PIECES)
    told = lambda names, reason=None: F.struct(names.alias("names"), F.lit("UNREVIEWED" if reason is None else "NEEDS_REVIEW").alias("status"), F.lit(reason).cast("string").alias("reason"))
    whole = F.array(name)

    def parts(p: Column, otherwise: Column) -> Column:
        return F.when((F.size(p) > 1) & F.forall(p, _safe_piece), told(p)).otherwise(otherwise)

    commas, ands = cut(","), cut(r"(?i)\s+and\s+")
    return (
        F.when(name.isNull(), told(F.array().cast("array<string>")))
        .when(name.rlike(UNSAFE_JOINERS), told(whole, "ambiguous joiner"))
        .when(name.contains(";"), parts(cut(";"), told(whole, "unsafe list by semicolon")))
        .when(name.contains(",") & (F.size(commas) == 2) & suffix(F.get(commas, 1)), told(whole))
        .when(name.contains(",") & F.exists(F.slice(commas, 2, 1 << 20), suffix), told(whole, "comma before a legal suffix"))
        .when(name.contains(","), parts(commas, told(whole, "unsafe list by comma")))
        .when(F.size(ands) > 2, told(whole, "list of several by and"))
        .otherwise(parts(ands, told(whole)))
    )
