"""The observation ledger: writing it, resolving conflicts, and reading it back.

A ledger row is one claim: txn, field, value (number) or text, tier, confidence, source and
seq, the claim's place in insertion order. ``seq`` settles every "first" and "latest".
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factmill.functions.derive import unanimous
from factmill.functions.vocab import canonical_json
from factmill.operators.isolation import each_key, same_keys
from factmill.operators.shared import written

TIERS = ["T1", "T2", "T3", "T4"]


def unpivot(wide: DataFrame, ids: list[str], fields: list[str], value: str = "value") -> DataFrame:
    """One row per id and field that isn't null; a single pass, no shuffle."""
    return wide.unpivot(ids, fields, "field", value).where(F.col(value).isNotNull())


def encoded(value: Column, kind: str) -> tuple[Column, Column]:
    """A value's text and number as the ledger holds them; flags are '1' / '0' and 1.0 / 0.0."""
    if kind == "boolean":
        return F.when(value.isNotNull(), F.when(value.cast("boolean"), "1").otherwise("0")), value.cast("boolean").cast("int").cast("double")
    return value.cast("string"), value.try_cast("double") if kind == "number" else F.lit(None).cast("double")


def decoded(text: Column, number: Column, kind: str) -> Column:
    """A typed value: the number wins over the text; what can't be read is null."""
    if kind == "number":
        return F.coalesce(number, text.try_cast("double"))
    if kind == "boolean":
        return F.coalesce(number, text.try_cast("double")).cast("int")
    if kind == "json":
        return F.when(F.try_parse_json(text).isNotNull(), canonical_json(text))
    if kind == "date":
        return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")
    return F.when(F.trim(text) != "", text)


def inserted(ledger: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Insert-or-ignore on a key: new rows whose key is neither there nor earlier in the batch."""
    first = new.groupBy(*key).agg(F.min_by(F.struct(*[c for c in new.columns if c not in key]), "seq").alias("__r")).select(*key, "__r.*").select(*new.columns)
    return ledger.unionByName(first.join(ledger.select(*key).distinct(), key, "left_anti"), allowMissingColumns=True)


def exploded(rows: DataFrame, ids: list[str], array: str, prefix: str, attributes: list[str]) -> DataFrame:
    """One ledger row per element and attribute of an array of structs, keyed by position."""
    items = rows.select(*ids, F.posexplode(array).alias("pos", "item"))
    flat = items.select(*ids, F.concat(F.lit(prefix), F.col("pos")).alias("fact_key"), *[F.col(f"item.{a}").cast("string").alias(a) for a in attributes])
    return unpivot(flat, [*ids, "fact_key"], attributes)


def confidence_rank(confidence: Column) -> Column:
    """HIGH 0, MEDIUM 1, LOW 2; null counts as MEDIUM, anything else too."""
    return F.when(confidence == "HIGH", 0).when(confidence == "LOW", 2).otherwise(1)


def _per_tier() -> list[tuple[str, str]]:
    """Name and kind of each tier's columns in a state; a kind tells how two of them make one."""
    out = []
    for t in TIERS:
        out += [(f"low_{t}", "min"), (f"first_{t}", "first"), (f"seq_{t}", "min")]
        out += [x for r in range(3) for x in ((f"n_{t}{r}", "sum"), (f"top_{t}{r}", "max"))]
    return out


STATE = [("n_seen", "sum"), ("stated", "max"), ("by_hand", "last"), ("seq_hand", "max"), *_per_tier()]
"""A key's state: n_seen, stated (some value isn't null), the latest manual value, and each tier's least and first value and
counts and greatest values by rank of confidence. ``first`` and ``last`` go by the column that follows."""


def states(ledger: DataFrame, keys: list[str], value: str = "value", boolean: bool = False, manual: Column | None = None, counted: Column | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """keys and ``STATE``: what claims tell, small however many they are, and enough to resolve them or to add others.

    Rows that aren't ``counted`` don't add to n_seen; they must have no tier and no value. Of ``carried`` columns the greatest value stays.
    """
    v = F.col(value)
    counts = v.isNotNull() & ((v != 0) if boolean else F.lit(True))
    by_hand = (manual & v.isNotNull()) if manual is not None else F.lit(False)
    rows = ledger.select(*keys, v.alias("v"), F.when(counts, F.col("tier")).alias("t"), confidence_rank(F.col("confidence")).alias("r"), "seq", F.when(by_hand, F.col("seq")).alias("m"), (F.lit(True) if counted is None else counted).alias("__n"), *carried)
    aggregates = [F.count(F.when(F.col("__n"), 1)).alias("n_seen"), F.max(F.col("v").isNotNull()).alias("stated"), F.max_by("v", "m").alias("by_hand"), F.max("m").alias("seq_hand")]
    for t in TIERS:
        here = F.col("t") == t
        at = F.when(here, F.col("seq"))
        aggregates += [F.min(F.when(here, F.col("v"))).alias(f"low_{t}"), F.min_by("v", at).alias(f"first_{t}"), F.min(at).alias(f"seq_{t}")]
        for r in range(3):
            own = here & (F.col("r") == r)
            aggregates += [F.count(F.when(own, 1)).alias(f"n_{t}{r}"), F.max(F.when(own, F.col("v"))).alias(f"top_{t}{r}")]
    return rows.groupBy(*keys).agg(*aggregates, *[F.max(x).alias(x) for x in carried])


def merged_states(parts: DataFrame, keys: list[str]) -> DataFrame:
    """One state per key from several, as ``states`` makes it from all their claims; claims must not be in two of them."""
    how = {"min": F.min, "max": F.max, "sum": F.sum}
    aggregates = []
    for i, (name, kind) in enumerate(STATE):
        at = STATE[(i + 1) % len(STATE)][0]
        # a null of an extreme seq can't win: with no seq there is no value
        made = F.min_by(name, at) if kind == "first" else F.max_by(name, at) if kind == "last" else how[kind](name)
        aggregates.append(made.alias(name))
    return parts.groupBy(*keys).agg(*aggregates)


def decided(state: DataFrame, keys: list[str], value: str = "value", boolean: bool = False) -> DataFrame:
    """keys, value, flagged, n_seen and __tier (that which decides) from states; a projection."""
    tops = lambda t: F.greatest(*[F.col(f"top_{t}{r}") for r in range(3)])
    any_of = lambda t: F.col(f"low_{t}").isNotNull()
    agree = lambda t: F.col(f"low_{t}") == tops(t)

    def best(t: str) -> Column:
        """The value of the only claim of best confidence, null if there are several."""
        out = F.lit(None)
        for r in (2, 1, 0):
            out = F.when(F.col(f"n_{t}{r}") > 0, F.when(F.col(f"n_{t}{r}") == 1, F.col(f"top_{t}{r}"))).otherwise(out)
        return out

    silent = F.when(F.col("stated"), 0).cast("double") if boolean else F.lit(None)
    chosen, clash, tier = silent, F.lit(0), F.lit(None).cast("string")
    for t in reversed(TIERS):
        chosen = F.when(any_of(t), F.when(agree(t), F.col(f"low_{t}")).otherwise(F.coalesce(best(t), F.col(f"first_{t}")))).otherwise(chosen)
        clash = F.when(any_of(t), F.when(agree(t) | best(t).isNotNull(), 0).otherwise(1)).otherwise(clash)
        tier = F.when(any_of(t), F.lit(t)).otherwise(tier)
    said = F.col("seq_hand").isNotNull()
    return state.select(*keys, F.when(said, F.col("by_hand")).otherwise(chosen).alias(value), F.when(said, 0).otherwise(clash).cast("int").alias("flagged"), "n_seen", tier.alias("__tier"))


def _resolved(ledger: DataFrame, keys: list[str], value: str, boolean: bool, manual: Column | None) -> DataFrame:
    """keys, value, flagged, n_seen, __tier: see ``resolved``."""
    return decided(states(ledger, keys, value, boolean, manual), keys, value, boolean)


def resolved(ledger: DataFrame, keys: list[str], value: str = "value", boolean: bool = False, manual: Column | None = None) -> DataFrame:
    """One row per key: value, flagged (1 for a conflict settled by first come), n_seen.

    Only the first tier that states anything decides; unknown tiers never do. Inside it equal
    values agree, else a unique best confidence wins, else the first value is taken and
    flagged. The latest manual value, if any, comes before all. Zeros of a boolean state
    nothing but that the answer may be 0.

    One aggregate on the keys, combined before its only shuffle: each tier's least and first
    value, and each of its confidence ranks' count and greatest value, so a key's claims are
    never gathered however many there are.
    """
    return _resolved(ledger, keys, value, boolean, manual).drop("__tier")


def resolved_by(ledger: DataFrame, keys: list[str], resolver: Callable[[DataFrame], DataFrame], value: str = "value") -> tuple[DataFrame, DataFrame]:
    """As ``resolved``, with a resolver for conflicts; and the conflicts: keys, severity, n_claims, chosen.

    ``resolver`` gets the claims in conflict (those of the deciding tier) and answers with rows
    (keys, value) for the keys that it can settle. Others keep their first value, stay flagged
    and are MATERIAL.
    """
    won = _resolved(ledger, keys, value, False, None)
    open_ = won.where("flagged = 1").select(*keys, "__tier")
    claims = ledger.join(open_, keys).where((F.col("tier") == F.col("__tier")) & F.col(value).isNotNull()).drop("__tier")
    answers = resolver(claims).select(*keys, F.col(value).alias("__answer"), F.lit(True).alias("__settled"))
    out = won.join(answers, keys, "left")
    settled = (F.col("flagged") == 1) & F.coalesce("__settled", F.lit(False))
    out = out.select(*keys, F.when(settled, F.col("__answer")).otherwise(F.col(value)).alias(value), F.when(settled, 0).otherwise(F.col("flagged")).cast("int").alias("flagged"), "n_seen", settled.alias("__by"), (F.col("flagged") == 1).alias("__open"))
    n = claims.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_claims"))
    conflicts = out.where("__open").join(n, keys).select(*keys, F.when(F.col("__by"), "RESOLVED").otherwise("MATERIAL").alias("severity"), "n_claims", F.col(value).alias("chosen"))
    return out.select(*keys, value, "flagged", "n_seen"), conflicts


def resolved_each(ledger: DataFrame, keys: list[str], id: str, resolver: Callable[[dict, Iterator[dict]], dict | None], value: str = "value", tries: int = 2) -> tuple[DataFrame, DataFrame]:
    """As ``resolved``, with a resolver that is asked about one conflict at a time and may fail; and the conflicts.

    ``resolver`` gets the key and its claims in conflict, by seq, and answers with a dict: ``chosen`` (the id of a claim),
    ``value``, and maybe ``severity``, ``flagged`` and ``reasoning``. If it raises, answers nothing, or chooses what is no claim
    of the conflict, the key keeps its first value, is flagged and MATERIAL, and the reason is told; other
    keys are as they would be. The conflicts: keys, severity, flagged, n_claims, chosen, chosen_id, reasoning, reason, attempts.
    """
    won = written(_resolved(ledger, keys, value, False, None), "won")
    open_ = won.where("flagged = 1").select(*[F.col(k).alias(f"__{k}") for k in keys], "__tier")
    same, equal, whole = F.lit(True), F.lit(True), F.lit(True)
    for k in keys:
        same, equal, whole = same & F.col(k).eqNullSafe(F.col(f"__{k}")), equal & (F.col(k) == F.col(f"__{k}")), whole & F.col(k).isNotNull()
    # by plain keys and a tier between, claims that were dealt by key don't travel again; keys with nulls go by themselves
    decides, told = F.col("tier").between(F.col("__tier"), F.col("__tier")), ledger.where(F.col(value).isNotNull())
    claims = told.join(open_, equal & decides).select(*ledger.columns).unionByName(told.where(~whole).join(open_, same & decides).select(*ledger.columns))
    claims = written(claims, "claims")
    kind, named = ledger.schema[value].dataType, ledger.schema[id].dataType
    shape = T.StructType([T.StructField("chosen_id", named), T.StructField("answer", kind), T.StructField("severity", T.StringType()), T.StructField("review", T.BooleanType()), T.StructField("reasoning", T.StringType())])

    def asked(key: dict, own: Iterator[dict]) -> list[dict]:
        got = resolver(key, own)
        if got is None:
            raise ValueError("no answer")
        return [{"chosen_id": got["chosen"], "answer": got["value"], "severity": got.get("severity"), "review": bool(got.get("flagged")), "reasoning": got.get("reasoning")}]

    answers, failures = each_key(claims, keys, ["seq", id], asked, shape, tries)
    said = same_keys(answers.withColumn("__id", F.col("chosen_id")), claims.withColumn("__id", F.col(id)), [*keys, "__id"], "left_semi").drop("__id")
    strays = same_keys(answers, said, keys, "left_anti").select(*keys, F.lit("the answer names no claim of the conflict").alias("reason"), F.lit(1).alias("attempts"))
    told = said.withColumn("reason", F.lit(None).cast("string")).withColumn("attempts", F.lit(None).cast("int")).unionByName(failures.unionByName(strays), allowMissingColumns=True)
    n = claims.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_claims"))
    told = told.join(n.select(*[F.col(k).alias(f"__{k}") for k in keys], "n_claims"), same).drop(*[f"__{k}" for k in keys])
    own = told.select(*[F.col(k).alias(f"__{k}") for k in keys], "n_claims", "chosen_id", "answer", "severity", "review", "reasoning", "reason", "attempts")
    out = won.join(own, same, "left")
    settled = F.col("n_claims").isNotNull() & F.col("reason").isNull()
    out = out.select(
        *keys, F.when(settled, F.col("answer")).otherwise(F.col(value)).alias(value), F.when(settled, F.col("review").cast("int")).otherwise(F.col("flagged")).cast("int").alias("flagged"),
        "n_seen", "n_claims", "chosen_id", F.when(settled, F.coalesce("severity", F.lit("RESOLVED"))).otherwise("MATERIAL").alias("severity"), "reasoning", "reason", "attempts",
    )
    conflicts = out.where("n_claims IS NOT NULL").select(*keys, "severity", "flagged", "n_claims", F.col(value).alias("chosen"), "chosen_id", "reasoning", "reason", "attempts")
    return out.select(*keys, value, "flagged", "n_seen"), conflicts


def inputs(observations: DataFrame, staging: DataFrame, sources: DataFrame, ready: list[str]) -> DataFrame:
    """Observations of rows that are ready, with their transaction and provenance.

    Tier and date fall back to the source's, confidence to MEDIUM.
    """
    rows = staging.where(F.col("status").isin(ready)).select(F.col("extraction").alias("__e"), F.col("txn").alias("__txn"), F.col("source").alias("__s"))
    told = sources.select(F.col("source").alias("__src"), F.col("tier").alias("__tier"), F.col("published").alias("__published"))
    joined = observations.join(rows, F.col("extraction") == F.col("__e")).join(told, F.col("__s") == F.col("__src"), "left")
    kept = [x for x in observations.columns if x not in ("txn", "tier", "confidence", "published")]
    return joined.select(F.col("__txn").alias("txn"), F.coalesce("tier", "__tier").alias("tier"), F.coalesce("confidence", F.lit("MEDIUM")).alias("confidence"), F.col("__published").alias("published"), *kept)


def by_sibling(ledger: DataFrame, amount: str, qualifier: str, wanted: str) -> DataFrame:
    """Amount claims whose own source also states the wanted qualifier: a semi-join on (txn, source)."""
    typed = ledger.where((F.col("field") == qualifier) & (F.col("text") == wanted)).select("txn", "source")
    return ledger.where(F.col("field") == amount).join(typed, ["txn", "source"], "left_semi")


def anchored(ledger: DataFrame, winners: DataFrame, amount: str, qualifier: str) -> DataFrame:
    """Qualifier claims of the sources that supplied the winning amount, and no others."""
    sources = ledger.where(F.col("field") == amount).join(winners.select("txn", F.col("value").alias("__won")), "txn").where(F.col("value") == F.col("__won")).select("txn", "source")
    return ledger.where(F.col("field") == qualifier).join(sources, ["txn", "source"], "left_semi")


def anchored_qualifiers(ledger: DataFrame, amounts: list[str], qualifier: str) -> DataFrame:
    """txn, each amount's own qualifier (``<amount>_<qualifier>``) and the shared one, where all that are told agree.

    A qualifier is resolved anew from the sources of the amount that won. The amounts are
    resolved together, and so are their qualifiers. Every step is by transaction or finer, so claims that are dealt
    by transaction travel no more.
    """
    rows = ledger.where(F.col("field").isin(*amounts, qualifier))
    won = resolved(rows.where(F.col("field") != qualifier), ["txn", "field"])
    wins = won.groupBy(F.col("txn").alias("__t")).agg(*[F.max(F.when(F.col("field") == a, F.col("value"))).alias(f"__won_{a}") for a in amounts])
    hits = F.array(*[F.max(F.when((F.col("field") == a) & (F.col("value") == F.col(f"__won_{a}")), a)).over(Window.partitionBy("txn", "source")) for a in amounts])
    told = rows.where(F.col("source").isNotNull()).join(wins, F.col("txn") == F.col("__t")).withColumn("__hits", hits).where(F.col("field") == qualifier)
    told = told.withColumn("__amount", F.explode("__hits")).where("__amount IS NOT NULL").select("txn", "__amount", "tier", "confidence", "seq", F.col("text").alias("__q"))
    best = resolved(told, ["txn", "__amount"], value="__q")
    wide = best.groupBy("txn").agg(*[F.max(F.when(F.col("__amount") == a, F.col("__q"))).alias(f"{a}_{qualifier}") for a in amounts])
    return wide.withColumn(qualifier, unanimous(*[F.col(f"{a}_{qualifier}") for a in amounts]))


def histories(ledger: DataFrame, documents: DataFrame, rejected: list[str]) -> DataFrame:
    """txn, field, history: of fields with several values, what was told when, as JSON in order of day and document.

    Equal tellings are one, so a field's claims are gathered only as far as they differ.
    """
    live = ledger.where(~F.coalesce(F.col("text").isin(rejected), F.lit(False)))
    named = documents.select(F.col("document").alias("__d"), F.col("title").alias("title"))
    rows = live.join(named, F.col("document") == F.col("__d"), "left").groupBy("txn", "field", F.coalesce("filed", F.lit("")).alias("__filed"), "document", "text", "title").agg(F.count(F.lit(1)).alias("n"))
    told = F.struct(F.col("__filed").alias("filed"), "document", F.col("text").alias("value"), "title")
    out = rows.groupBy("txn", "field").agg(F.count_distinct("text").alias("__k"), F.to_json(F.sort_array(F.collect_list(told)), {"ignoreNullFields": "false"}).alias("history"))
    return out.where("__k > 1").drop("__k")


def differences(ledger: DataFrame, rejected: list[str]) -> DataFrame:
    """Fields with several values: first and last by date, delta, delta in %, and kind of change."""
    live = ledger.where(~F.coalesce(F.col("text").isin(rejected), F.lit(False)))
    at = F.struct(F.coalesce("filed", F.lit("")).alias("filed"), "seq")
    rows = live.groupBy("txn", "field").agg(
        F.count_distinct("text").alias("n_values"), F.min_by("value", at).alias("first_value"), F.max_by("value", at).alias("last_value"),
    ).where("n_values > 1")
    delta = F.col("last_value") - F.col("first_value")
    kind = F.when(delta > 0, "INCREASE").when(delta < 0, "DECREASE").when(delta == 0, "IDENTICAL").otherwise("DIFFERENT")
    return rows.select("txn", "field", "n_values", "first_value", "last_value", F.round(delta, 2).alias("delta"), F.round(delta / F.nullif("first_value", F.lit(0.0)) * 100, 2).alias("delta_pct"), kind.alias("change_type"))


def by_priority(rows: DataFrame, keys: list[str], priority: Column, latest: list[Column]) -> DataFrame:
    """The last write among those of best priority: lower rank first, then the greatest of ``latest``, nulls being least.

    Two aggregates, each combined before it travels, so no key is sorted in one task.
    """
    others = F.struct(*[c for c in rows.columns if c not in keys])
    last = rows.groupBy(*keys, priority.alias("__p")).agg(F.max_by(others, F.struct(*latest)).alias("__r"))
    # a null priority comes first, as nulls do
    return last.groupBy(*keys).agg(F.min_by("__r", F.struct(F.col("__p").isNotNull(), "__p")).alias("__r")).select(*keys, "__r.*").select(*rows.columns)
