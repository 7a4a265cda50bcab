"""Signals of news and pages as column builders: parties, amounts, structures, blocks, metadata.

Spans between matches come from splitting a text at the matches: the pieces before and after the
k-th match are all that belongs to it, so nothing needs positions or Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from factmill.functions.scanners import bound, last_of_each

# Exchanges, phrases of regulated companies and of public ones.
EXCHANGE_TICKER = r"(?i)\b(NYSE|NASDAQ|NYSE American|OTCQB|OTCQX|AMEX)\s*[:]\s*([A-Z]{1,5})\b"
REGULATOR_PHRASES = ["Form 8-K", "files with the SEC", "Securities and Exchange Commission", "Exchange Act", "Regulation FD"]
PUBLIC_PHRASES = ["publicly traded", "common stock"]
NEAR = 200

# Item codes by event, the best first.
ITEM_PRIORITY = {"ANNOUNCEMENT": ["1.01", "8.01"], "CLOSE": ["2.01", "8.01"], "TERMINATION": ["1.02", "8.01"], "AMENDMENT": ["1.01", "2.01", "8.01"]}

# What tells the kind of a press exhibit, in order of precedence.
PRESENTATION = r"(?i)\b(investor\s+presentation|presentation|slide\s+deck|supplemental\s+slides|conference\s+call|transcript|prepared\s+remarks|fact\s+sheet)\b"
PRESS = r"(?i)\b(press\s+release|news\s+release|joint\s+press\s+release|for\s+immediate\s+release)\b"
DEAL_NEWS = r"(?i)\b(announces?|announced|to\s+acquire|to\s+be\s+acquired|merger\s+agreement|definitive\s+agreement|transaction)\b"

# Amounts of money, with what qualifies them, and ranges of amounts.
QUALIFIER = (
    r"(?:in\s+excess\s+of|more\s+than|no\s+less\s+than|at\s+least|greater\s+than|north\s+of|upwards\s+of|over|approximately|approx\.?|about|around|nearly|almost|"
    r"roughly|up\s+to|as\s+much\s+as|~)"
)
MONEY = rf"(?i)((?:{QUALIFIER})\s+)?(US\$|\$|€|£|¥)\s?(\d[\d,]*(?:\.\d+)?)\s*(billion|bn|million|mm|m\b|k\b|thousand)?"
RANGE = (
    r"(?i)(?:between\s+)?(?:US\$|\$|€|£|¥)\s?\d[\d,]*(?:\.\d+)?\s*(?:billion|bn|million|mm|m\b)?\s*(?:to|-|–|—|and)\s*"
    r"(?:US\$|\$|€|£|¥)?\s?\d[\d,]*(?:\.\d+)?\s*(?:billion|bn|million|mm|m\b)"
)
# What binds an amount to a financing round; which of these tell the round's total; an investor's own check.
BINDING = [
    r"rais\w*\s+(?:a\s+|an\s+|its\s+)?(?:new\s+)?<AMT>",
    r"secur\w*\s+(?:a\s+|an\s+|its\s+)?<AMT>",
    r"clos\w*\s+(?:on\s+|of\s+)?(?:its\s+)?(?:a\s+)?<AMT>",
    r"<AMT>\s+(?:in|of)\s+(?:new\s+)?(?:series\s+[a-k]|seed|pre-seed|funding|financing|growth|capital|venture|equity|primary)",
    r"<AMT>\s+series\s+[a-k]\b",
    r"<AMT>\s+(?:seed|pre-seed)\s+(?:round|funding|financing)",
    r"(?:series\s+[a-k]|seed|pre-seed|financing|funding)\s*(?:round)?\s*(?:of|totall?ing|worth|at)\s+<AMT>",
    r"(?:investment|financing|raise|round|infusion)\s+(?:of|totall?ing)\s+<AMT>",
    r"invest\w*\s+<AMT>\s+(?:in|into)\b",
    r"<AMT>\s+(?:growth\s+)?(?:equity\s+)?investment\b",
    r"announc\w*\s+<AMT>\s+(?:in|of)\b",
    r"total\s+(?:series\s+[a-k]|seed|pre-seed|round|financing)\s+to\s+<AMT>",
]
ROUND_TOTAL = [
    r"total\s+(?:series\s+[a-k]|seed|pre-seed|round|financing)\s+to\s+<AMT>",
    r"rais\w*\s+(?:a\s+|an\s+|its\s+)?(?:new\s+)?<AMT>",
    r"(?:series\s+[a-k]|seed|pre-seed|financing|funding)\s*(?:round)?\s*(?:of|totall?ing|worth|at)\s+<AMT>",
    r"clos\w*\s+(?:on\s+|of\s+)?(?:its\s+)?(?:a\s+)?<AMT>",
    r"<AMT>\s+(?:in|of)\s+(?:new\s+)?(?:series\s+[a-k]|seed|pre-seed|funding|financing)",
    r"<AMT>\s+series\s+[a-k]",
]
CHECK_SHAPED = [
    r"(?:has\s+)?made\s+(?:a\s+)?<AMT>",
    r"invest\w*\s+<AMT>\s+(?:in|into)",
    r"<AMT>\s+(?:growth\s+)?(?:equity\s+)?investment\s+in",
    r"committed\s+<AMT>",
]
# What takes an amount out of the running, in order of precedence, and what it then is.
SCOPES = {
    "NOT_ROUND_INVESTOR_SCOPE": r"(assets?\s+under\s+management|\bAUM\b|manages?\b|managing\s+(?:over|more)|firm\s+with|fund\s+(?:with|of|size)|portfolio\s+(?:of|companies)|across\s+its|since\s+inception|has\s+invested|deployed|under\s+management)",
    "NOT_ROUND_CUMULATIVE": r"(to\s+date|total\w*\s+rais\w*|bringing\s+(?:its\s+|the\s+)?total(?!\s+(?:series\s+[a-k]|seed|pre-seed|round|financing))|cumulativ\w*|lifetime|since\s+\d{4}|previously\s+rais\w*|prior\s+round|to\s+date\b)",
    "NOT_ROUND_VALUATION": r"(valuation|valu(?:ing|ed)\s+(?:the\s+\w+\s+)?at|post-?money|pre-?money|market\s+cap\w*|enterprise\s+value)",
}
SECONDARY = r"(acquired?\s+the\s+[\d.]+\s*%\s*(stake\s+)?held\s+by|purchas\w*\s+the\s+stake\s+held\s+by|secondary\s+(sale|purchase|transaction|offering)|from\s+existing\s+(share|stock)holders|tender\s+offer|bought\s+out)"
FACILITY = r"(credit\s+facility|debt\s+facility|term\s+loan|revolving|venture\s+debt|loan\s+facility|debt\s+financing)"
INVESTOR_CHECK = r"(invest\w*\s+<AMT>\s+(?:in|into)\b|committed\s+<AMT>)"
LOWER_BOUND = r"(?i)\A(?:in\s+excess\s+of|more\s+than|no\s+less\s+than|at\s+least|greater\s+than|north\s+of|upwards\s+of|over)\z"
RUMOURED = r"(reportedly|rumou?red|is\s+said\s+to|are\s+said\s+to|said\s+to\s+have|sources?\s+(?:said|say|told)|people\s+familiar|according\s+to\s+(?:people|sources)|unconfirmed)"

# What binds the acronym of a private investment in public equity, its long form, and the events that it overrides.
ACRONYM_BINDING = [
    r"<PIPE>\s+(?:financing|offering|transaction|investment|placement|deal|round|subscription|purchase\s+agreement|securities\s+purchase)",
    r"<PIPE>\s+(?:investors?|purchasers?|participants?|shares?|units?|proceeds|commitments?)",
    r"[(\[]\s*[\"'“‘]?<PIPE>[\"'”’]?\s*[)\]]",
]
# Not fixed values but a departure: the acronym after a preposition or an amount counts whatever follows it. With a word
# boundary behind the mark, which ends in no word character, these would hold only where a letter follows at once.
ACRONYM_AFTER = [
    r"(?:in|through|via|by\s+way\s+of)\s+(?:a\s+|the\s+)?<PIPE>",
    r"(?:\$|US\$|€|£)\s?\d[\d,]*(?:\.\d+)?\s*(?:billion|bn|million|mm|m)?\s+<PIPE>",
]
LONG_FORM = r"(?i)private\s+investments?\s+in\s+public\s+equit(?:y|ies)"
OVERRIDABLE = ["UNKNOWN", "VC_ROUND", "GROWTH_EQUITY", "VENTURE_DEBT"]
READ_CHARS = 14000

# Signs of a wall in place of a page, what a page has that a wall hasn't, and body rules of sites.
WALL_MARKERS = [
    "just a moment", "checking your browser", "enable javascript and cookies", "cf-browser-verification", "request unsuccessful", "incapsula incident id",
    "_incapsula_resource", "access denied", "reference #", "you have been blocked", "attention required", "are you a robot", "unusual traffic", "captcha",
    "px-captcha", "datadome", "temporarily unavailable", "scheduled maintenance", "rate limit",
]
BLOCKED_STATUS = [401, 403, 405, 406, 409, 418, 429, 503]
STRUCTURE_HINTS = ["application/ld+json", "<article", "articlebody", 'property="og:', "<h1"]
LEAST_PAGE = 3000
SITE_RULES = {
    "businesswire.com": [".bw-release-story", "[itemprop='articleBody']"],
    "prnewswire.com": [".release-body", ".col-lg-10 .release-body"],
    "globenewswire.com": ["#main-body-container", ".main-body-container"],
}
META_KEYS = ["og:title", "og:description", "og:type", "og:url", "og:site_name", "description", "author", "article:published_time", "article:modified_time", "publish-date", "date"]

# What tells of a balance sheet, and of a deal in a headline.
BALANCE_SHEET = (
    r"(?i)\btotal debt\b|\bnet debt\b|\bgross debt\b|\bindebtedness\b|\bcash and cash equivalents\b|\bcash equivalents\b|\bshort[- ]term investments\b|\bmarketable securities\b|"
    r"\bcash on hand\b|\bcash balance\b|\bdebt[- ]free\b|\bcash[- ]free\b|\bbalance sheet\b|\bleverage\b|\bborrowings\b|\boutstanding debt\b|\bterm loan\b|\bcredit facility\b|"
    r"\bassumed debt\b|\bassumption of debt\b"
)
DEAL_HEADLINE = (
    r"(?i)\b(acquir\w*|acquisition|merge\w*|merger|takeover|take-?private|buy\w*|purchase[sd]?|sells?|sold|divest\w*|carve-?out|spin-?off|spin\s?out|stake|majority|minority|"
    r"joint venture|jv|recapitali\w*|series\s+[a-z]\b|seed round|funding round|raises?|raised|investment|invests?|backs?|definitive agreement|letter of intent)\b"
)
_SENTENCE = r"(?<=[.!?])\s+"
_WORD = "[0-9A-Za-z_]"
# what RE2 makes of escapes, sets and letters where case doesn't count: the long s is an s, the Kelvin sign a k
_RE2 = {
    r"\b": f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))", r"\w": "[0-9A-Za-z_\u017f\u212a]", r"\s": r"[\t\n\f\r ]", "[a-z]": "[a-z\u017f\u212a]", "s": "[s\u017f]", "k": "[k\u212a]",
}


def as_sql_reads(pattern: str) -> str:
    """A pattern that begins with (?i) as DuckDB's expressions read it: only ASCII makes words, where Java's ``\\b`` takes letters of any script."""
    return "(?i)" + re.sub(r"\\.|\[[^\]]*\]|[sk]", lambda m: _RE2.get(m[0], m[0]), pattern.removeprefix("(?i)"))


def _first_of(text: Column, phrases: list[str]) -> Column:
    return F.coalesce(*[F.when(F.contains(F.lower(text), F.lit(p.lower())), p) for p in phrases])


def spans(sentence: Column, pattern: str, mark: str) -> Column:
    """For each match of a pattern the text around it up to its neighbours, with the match marked."""
    beside = lambda p: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x, i: F.concat(x, F.lit(mark), F.get(p, i + 1)))
    return bound(F.split(sentence, pattern), beside)


def sentences(title: Column, body: Column) -> Column:
    whole = F.substring(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(body, F.lit(""))), 1, READ_CHARS)
    return F.filter(F.transform(F.split(whole, _SENTENCE), lambda s: F.trim(s, F.lit(" \t\n\r\f\x0b"))), lambda s: s != "")


def _any(text: Column, patterns: list[str]) -> Column:
    return text.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))


# ---- filings


def public_party(text: Column, target: Column, acquirer: Column) -> Column:
    """struct(signal, side, ticker) of a text that tells of a public party, else null.

    The side is that of the one party whose name stands within NEAR characters of the first
    listing, else BOTH.
    """
    at = F.regexp_instr(text, F.lit(EXCHANGE_TICKER))
    exchange, symbol = F.upper(F.regexp_extract(text, EXCHANGE_TICKER, 1)), F.upper(F.regexp_extract(text, EXCHANGE_TICKER, 2))
    listed = symbol != ""
    def near(name: Column) -> Column:
        place = F.instr(text, name)
        return F.coalesce((F.coalesce(name, F.lit("")) != "") & (place > 0) & (F.abs(at - place) <= NEAR), F.lit(False))

    side = F.when(listed & near(target) & ~near(acquirer), "TARGET").when(listed & near(acquirer) & ~near(target), "ACQUIRER").otherwise("BOTH")
    regulator, public = _first_of(text, REGULATOR_PHRASES), _first_of(text, PUBLIC_PHRASES)
    signal = F.array_join(F.array_compact(F.array(
        F.when(listed, F.concat(exchange, F.lit(":"), symbol, F.lit(" near entity name"))), F.concat(F.lit("SEC language: '"), regulator, F.lit("'")), F.concat(F.lit("public boilerplate: '"), public, F.lit("'")),
    )), "; ")
    return F.when(signal != "", F.struct(signal.alias("signal"), side.alias("side"), F.when(listed, symbol).alias("ticker")))


def press_exhibit(label: Column, text: Column) -> Column:
    """INVESTOR_PRESENTATION, PRESS_RELEASE, DEAL_NARRATIVE or OTHER."""
    sample = F.substring(F.coalesce(text, F.lit("")), 1, 4000)
    both = F.concat(F.coalesce(label, F.lit("")), F.lit("\n"), sample)
    return (
        F.when(both.rlike(PRESENTATION), "INVESTOR_PRESENTATION").when(both.rlike(PRESS), "PRESS_RELEASE")
        .when(F.coalesce(label, F.lit("")).rlike(r"(?i)\b99[._-]?1\b") & sample.rlike(DEAL_NEWS), "DEAL_NARRATIVE").otherwise("OTHER")
    )


def best_item(codes: Column, event: Column) -> Column:
    """The item to read for an event, of those a filing has."""
    wanted = F.coalesce(*[F.when(event == e, F.array(*map(F.lit, items))) for e, items in ITEM_PRIORITY.items()], F.array(F.lit("1.01"), F.lit("8.01")))
    return F.get(F.filter(wanted, lambda c: F.array_contains(codes, c)), 0)


# ---- financing rounds


def money_mentions(text: Column) -> Column:
    """array<struct<qualifier, currency, amount>> of a text's amounts of money, in order."""
    group = lambda k: F.regexp_extract_all(text, F.lit(MONEY), F.lit(k))
    rows = F.arrays_zip(group(1).alias("q"), group(2).alias("c"), group(3).alias("n"), group(4).alias("m"))
    code = lambda c: F.when(c.isin("$", "US$"), "USD").when(c == "€", "EUR").when(c == "£", "GBP").otherwise("JPY")
    return F.transform(rows, lambda x: F.struct(F.nullif(F.trim(x["q"]), F.lit("")).alias("qualifier"), code(F.upper(x["c"])).alias("currency"), (F.regexp_replace(x["n"], ",", "").try_cast("double") * _scale(x["m"])).alias("amount")))


def _scale(unit: Column) -> Column:
    u = F.lower(F.trim(unit))
    return F.when(u.isin("billion", "bn"), 1e9).when(u.isin("million", "mm", "m"), 1e6).when(u.isin("k", "thousand"), 1e3).otherwise(1.0)


def _judged(sentence: Column) -> Column:
    """Each amount of a sentence: struct(sentence, amount, qualifier, span, reason, total, check); reason is null for a candidate."""
    group = lambda k: F.regexp_extract_all(sentence, F.lit(MONEY), k)
    rows = F.arrays_zip(spans(sentence, MONEY, "<AMT>").alias("span"), group(F.lit(1)).alias("q"), group(F.lit(3)).alias("n"), group(F.lit(4)).alias("m"))

    def one(x: Column) -> Column:
        scope = F.coalesce(*[F.when(_any(x["span"], [p]), name) for name, p in SCOPES.items()])
        reason = F.when(_any(sentence, [SECONDARY]), "NOT_ROUND_SECONDARY").when(_any(sentence, [FACILITY]), "NOT_ROUND_FACILITY").when(scope.isNotNull(), scope).when(~_any(x["span"], BINDING), "AMBIGUOUS")
        check = _any(x["span"], CHECK_SHAPED)
        return F.struct(
            sentence.alias("sentence"), (F.regexp_replace(x["n"], ",", "").try_cast("double") * _scale(x["m"])).alias("amount"), F.nullif(F.trim(x["q"]), F.lit("")).alias("qualifier"),
            x["span"].alias("span"), reason.alias("reason"), (_any(x["span"], ROUND_TOTAL) & ~check).alias("total"),
        )

    return F.when(sentence.rlike(MONEY), F.transform(rows, one))


def round_amount(title: Column, body: Column) -> Column:
    """struct(classification, amount, qualifier, normalization): what a text's amounts say of a round's size.

    An amount counts if a construction in its own span binds it to the financing and nothing there
    gives it another meaning; a round's total comes before an investor's check. Lower bounds of one
    stated amount are taken as that amount (ANCHOR); other inexact ones are DEFERRED.
    """
    def told_of(found: Column) -> Column:
        return bound(F.struct(found.alias("all"), F.filter(found, lambda x: x["reason"].isNull()).alias("tied")), lambda c: bound(F.struct(F.size(c["all"]).alias("n"), F.size(c["tied"]).alias("n_tied"), F.get(c["all"], 0).alias("first"), F.coalesce(F.get(F.filter(c["tied"], lambda x: x["total"]), 0), F.get(c["tied"], 0)).alias("best")), _round))

    return bound(F.flatten(F.array_compact(F.transform(sentences(title, body), _judged))), told_of)


def _round(c: Column) -> Column:
    best, first, said = c["best"], c["first"], c["best"]["sentence"]
    check = _any(best["span"], [INVESTOR_CHECK]) & ~_any(said, [r"(round|rais\w*|financing)"])
    ranged, rumoured = said.rlike(RANGE), _any(said, [RUMOURED])
    floor = F.coalesce(best["qualifier"].rlike(LOWER_BOUND), F.lit(False)) & ~ranged & ~rumoured
    inexact = best["qualifier"].isNotNull() | ranged
    told = lambda kind, amount, qualifier=None, normal=None: F.struct(
        (F.lit(kind) if isinstance(kind, str) else kind).alias("classification"), (amount if amount is not None else F.lit(None).cast("double")).alias("amount"),
        (qualifier if qualifier is not None else F.lit(None).cast("string")).alias("qualifier"), F.lit(normal).cast("string").alias("normalization"),
    )
    return (
        F.when(c["n"] <= 0, told("NO_AMOUNT_DISCLOSED", None)).when(c["n_tied"] == 0, told(first["reason"], first["amount"]))
        .when(check, told("INVESTOR_CHECK_ONLY", best["amount"])).when(floor, told("LOWER_BOUND_NORMALIZED", best["amount"], best["qualifier"], "ANCHOR"))
        .when(inexact, told("NON_EXACT_AMOUNT", best["amount"], F.coalesce(best["qualifier"], F.lit("range")), "DEFERRED")).otherwise(told("ROUND_SIZE_CANDIDATE", best["amount"]))
    )


# ---- private investments in public equity


def structure(title: Column, body: Column) -> Column:
    """struct(form, evidence): EXPANDED or ACRONYM and the sentence that says so; null if none does."""
    binding = "|".join(f"(?:{p})" for p in ACRONYM_BINDING + ACRONYM_AFTER)

    def told(said: Column) -> Column:
        long = F.get(F.filter(said, lambda s: s.rlike(LONG_FORM)), 0)
        short = F.get(F.filter(said, lambda s: s.rlike(r"\bPIPE\b") & F.exists(spans(s, r"\bPIPE\b", "<PIPE>"), lambda x: x.rlike(binding))), 0)
        return bound(F.struct(long.alias("long"), short.alias("short")), lambda f: F.when(f["long"].isNotNull() | f["short"].isNotNull(), F.struct(F.when(f["long"].isNotNull(), "EXPANDED").otherwise("ACRONYM").alias("form"), F.substring(F.coalesce(f["long"], f["short"]), 1, 400).alias("evidence"))))

    return bound(sentences(title, body), told)


def routed(event: Column, title: Column, body: Column) -> Column:
    """struct(event, status, form, evidence, corroborated): where a classified row goes.

    A classifier's own PIPE is kept and corroborated; only the events that such a deal is
    mistaken for give way to what the text says.
    """
    def decided(found: Column) -> Column:
        own = F.coalesce(event == "PIPE", F.lit(False))
        out = own | F.coalesce(event.isin(OVERRIDABLE) & found.isNotNull(), F.lit(False))
        return F.struct(
            F.when(out, "PIPE").otherwise(event).alias("event"), F.when(out, "RECOGNIZED_NOT_PROFILED").otherwise("CLASSIFIED").alias("status"),
            F.when(own, "CLASSIFIER").when(out, found["form"]).alias("form"), F.when(out, found["evidence"]).alias("evidence"), F.when(out, found.isNotNull()).alias("corroborated"),
        )

    return bound(structure(title, body), decided)


# ---- pages


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def site_rules(url: Column) -> Column:
    """The selectors of a site's article body, subdomains included; empty for other sites."""
    at = host(url)
    rule = F.coalesce(*[F.when((at == d) | at.endswith("." + d), F.array(*map(F.lit, rules))) for d, rules in SITE_RULES.items()])
    return F.coalesce(rule, F.array().cast("array<string>"))


def wall(html: Column, status: Column) -> Column:
    """Why a response is a wall rather than a page; null if it isn't."""
    head, low = F.lower(F.substring(html, 1, 8000)), F.lower(html)
    marker = F.get(F.filter(F.array(*map(F.lit, WALL_MARKERS)), lambda m: F.contains(head, m)), 0)
    hinted = F.exists(F.array(*map(F.lit, STRUCTURE_HINTS)), lambda m: F.contains(low, m))
    return (
        F.when(status.isin(BLOCKED_STATUS), F.concat(F.lit("status "), status.cast("string"))).when(F.coalesce(html, F.lit("")) == "", F.lit("empty body"))
        .when(marker.isNotNull(), F.concat(F.lit("marker: "), marker)).when(~hinted & (F.length(html) < LEAST_PAGE), F.concat(F.lit("no article structure and only "), F.length(html), F.lit(" bytes")))
    )


def linked_data(html: Column) -> Column:
    """The page's linked-data blocks that parse, as JSON text."""
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]+type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"), 1)
    return F.filter(F.transform(blocks, lambda b: F.to_json(F.try_parse_json(F.trim(b)))), lambda b: b.isNotNull())


def metadata(html: Column) -> Column:
    """Map of the page's meta tags that matter; of a repeated one the last counts."""
    tag = r"(?i)<meta[^>]+(?:property|name)=[\"']([^\"']+)[\"'][^>]+content=[\"']([^\"']*)[\"']"
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(tag), 1).alias("k"), F.regexp_extract_all(html, F.lit(tag), 2).alias("v"))
    kept = F.filter(pairs, lambda p: F.lower(p["k"]).isin(META_KEYS))
    return F.map_from_entries(last_of_each(kept, "k"))


def best_text(candidates: Column, whole: Column) -> Column:
    """struct(text, extractor, suspect) from an array of struct(extractor, text): the longest (the first of equals);
    under a fifth of the whole page's text it is suspect. Without any, the whole text, suspect."""
    at = F.transform(F.filter(candidates, lambda x: F.length(x["text"]) > 200), lambda x, i: F.struct(F.length(x["text"]).alias("n"), (-i).alias("i"), x.alias("x")))
    best = F.array_max(F.transform(at, lambda a: F.struct(a["n"], a["i"], a["x"]["extractor"].alias("extractor"), a["x"]["text"].alias("text"))))
    raw = F.nullif(whole, F.lit(""))
    return F.when(best.isNotNull(), F.struct(best["text"].alias("text"), best["extractor"].alias("extractor"), (F.length(F.coalesce(whole, F.lit(""))) * 0.2 > best["n"]).alias("suspect"))).otherwise(
        F.struct(raw.alias("text"), F.when(raw.isNotNull(), "raw_body").alias("extractor"), F.lit(True).alias("suspect")))
