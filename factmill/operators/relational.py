"""Relational operators: dedup, incremental sinks, profiles, samples, reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factmill.functions.text import content_hash
from factmill.operators.shared import shared_checkpoints


def first_by(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, nulls of order first; combined before it travels, so no key is sorted in one task."""
    others = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("__r")).select(*key, "__r.*").select(*df.columns)


def upserted(existing: DataFrame, new: DataFrame, key: str, owned: list[str], version: str) -> DataFrame:
    """A new snapshot: owned columns are the new row's, null included; others stay; the version goes up."""
    new = new.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in owned], F.lit(True).alias("__new"))
    rows = existing.join(new, F.col(key) == F.col("__k"), "full_outer")
    there = F.col("__new").isNotNull()
    columns = []
    for c in existing.columns:
        if c == key:
            columns.append(F.coalesce(key, "__k").alias(key))
        elif c == version:
            columns.append(F.when(there, F.coalesce(c, F.lit(0)) + 1).otherwise(F.col(c)).alias(c))
        else:
            columns.append((F.when(there, F.col(f"__{c}")).otherwise(F.col(c)) if c in owned else F.col(c)).alias(c))
    return rows.select(*columns)


def superseded(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Soft delete: current rows whose key comes anew lose is_current; the new rows are current."""
    again = new.select(F.col(key).alias("__k")).distinct()
    old = existing.join(again, F.col(key) == F.col("__k"), "left")
    old = old.withColumn("is_current", F.when(F.col("__k").isNotNull(), 0).otherwise(F.col("is_current"))).drop("__k")
    return old.unionByName(new.withColumn("is_current", F.lit(1)), allowMissingColumns=True)


def replaced(children: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """Children of the parents that come anew are replaced as a whole."""
    return children.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new)


def updated(df: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Update from a join: values of the source where it has a row, else the row's own."""
    other = source.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in columns])
    return df.join(other, F.col(key) == F.col("__k"), "left").select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns])


def joined_list(value: Column | str, order: Column | str, sep: str = "|") -> Column:
    """Aggregate: distinct values in first-seen order, joined; ties of order by value."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o") if isinstance(order, str) else order.alias("o"), (F.col(value) if isinstance(value, str) else value).alias("v"))))
    return F.array_join(F.array_distinct(F.transform(pairs, lambda p: p["v"])), sep)


def first_seen_list(df: DataFrame, keys: list[str], value: Column, order: Column, into: str, sep: str = "|") -> DataFrame:
    """keys, ``into``: as ``joined_list``, but values are counted once before they travel, so that a
    key's rows are never gathered, only its distinct values."""
    rows = df.select(*keys, value.alias("__v"), order.alias("__o")).where("__v IS NOT NULL").groupBy(*keys, "__v").agg(F.min("__o").alias("__o"))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__o", "__v"))), lambda p: p["__v"]), sep)
    return rows.groupBy(*keys).agg(listed.alias(into))


def nearest_ranks(df: DataFrame, key: str, value: str, ranks: dict[str, float]) -> DataFrame:
    """key and, for each p, the value at index round(p * (n - 1)), halves to even, of the sorted values.

    From counts by distinct value, so that no list of a key's rows is kept.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(key)
    counts = counts.withColumn("__upto", F.sum("__n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))).withColumn("__all", F.sum("__n").over(w))
    at = lambda p: F.min(F.when(F.col("__upto") > F.bround((F.col("__all") - 1) * F.lit(p)), F.col(value)))
    return counts.groupBy(key).agg(*[at(p).alias(k) for k, p in ranks.items()])


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: filled, fill_pct, n_distinct, max_length, url_pct. One scan, one aggregate."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    filled = F.trim("value") != ""
    return long.groupBy("column").agg(
        F.count(F.when(filled, 1)).alias("filled"), F.round(F.count(F.when(filled, 1)) * 100 / F.count(F.lit(1)), 2).alias("fill_pct"),
        F.count_distinct(F.when(filled, F.col("value"))).alias("n_distinct"), F.max(F.length("value")).cast("long").alias("max_length"),
        F.round(F.count(F.when(F.col("value").rlike("^https?://"), 1)) * 100 / F.count(F.lit(1)), 2).alias("url_pct"),
    )


LENGTHS = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


def full_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column over whole values, trimmed: filled, fill_pct, n_distinct (by hash),
    distinct_ratio, least, most, mean and nearest-rank percentiles of length, url_pct and
    date_pct of the filled. Percentiles come from counts by length, so no list of values is kept."""
    own = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "").alias(c) for c in columns]
    long = df.select(*own).unpivot([], columns, "column", "value").select(
        "column", F.length("value").cast("long").alias("n"), F.sha2("value", 256).alias("hash"), F.col("value").rlike("(?i)^https?://").alias("url"), F.col("value").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}").alias("date"),
    )
    filled = F.col("n") > 0
    part = lambda rule, of: F.coalesce(F.round(F.count(F.when(rule, 1)) * 100 / F.nullif(of, F.lit(0).cast("long")), 2), F.lit(0.0))
    n, rows = F.count(F.when(filled, 1)), F.count(F.lit(1))
    main = long.groupBy("column").agg(
        n.alias("filled"), part(filled, rows).alias("fill_pct"), F.count_distinct(F.when(filled, F.col("hash"))).alias("n_distinct"), rows.alias("__rows"),
        F.min(F.when(filled, F.col("n"))).alias("least"), F.max(F.when(filled, F.col("n"))).alias("most"), F.floor(F.avg(F.when(filled, F.col("n")))).cast("long").alias("mean"),
        part(filled & F.col("url"), n).alias("url_pct"), part(filled & F.col("date"), n).alias("date_pct"),
    ).withColumn("distinct_ratio", F.round(F.col("n_distinct") / F.col("__rows"), 4)).drop("__rows")
    w = Window.partitionBy("column")
    sizes = long.where(filled).groupBy("column", "n").agg(F.count(F.lit(1)).alias("k"))
    sizes = sizes.withColumn("upto", F.sum("k").over(w.orderBy("n").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("k").over(w))
    at = lambda p: F.min(F.when(F.col("upto") > F.bround((F.col("all") - 1) * F.lit(p)), F.col("n")))
    return main.join(sizes.groupBy("column").agg(*[at(p).alias(k) for k, p in LENGTHS.items()]), "column", "left")


def top(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent values with counts and shares in %; ties by value."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    share = F.round(F.col("n") * 100 / F.sum("n").over(Window.partitionBy()), 2)
    return counts.withColumn("share_pct", share).orderBy(F.desc("n"), key).limit(k)


def any_row(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One whole row of each key, the first in order: a bare grouping made definite."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("__r")).select(*keys, "__r.*")


def top_seen(df: DataFrame, key: str, seq: str, k: int) -> DataFrame:
    """The k most frequent values with their counts; ties by first seen."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("__first")).orderBy(F.desc("n"), "__first").limit(k).drop("__first")


def _offered(rows: DataFrame, id_column: str, groups: Column, most: int) -> DataFrame:
    """id, __h, __g and what rows tell of a group by __-names: of each group that a row belongs to the first ``most`` rows by hash.

    Each task keeps no more than that of a group before rows travel. Written, as every round reads it.
    """
    told = [c for c in rows.columns if c.startswith("__")]
    long = rows.withColumn("__h", F.sha2(F.col(id_column).cast("string"), 256)).select(id_column, "__h", *told, F.explode(groups).alias("__g"))
    nth = F.row_number().over(Window.partitionBy("__g").orderBy("__h", id_column))
    return long.withColumn("__nth", nth).where(F.col("__nth") <= most).drop("__nth").checkpoint()


def _settled(offered: DataFrame, id_column: str, steps: list[tuple[Column, Column, Column | None]]) -> DataFrame:
    """id, stratum: step after step, (label, rule, cap), the first rows of each group that no earlier step took."""
    taken = None
    for label, rule, cap in steps:
        own = offered.where(rule)
        if taken is not None:
            own = own.join(taken.select(id_column), id_column, "left_anti")
        if cap is not None:
            own = own.withColumn("__nth", F.row_number().over(Window.partitionBy("__g").orderBy("__h", id_column))).where(F.col("__nth") <= cap)
        own = own.select(id_column, label.alias("stratum"))
        taken = (own if taken is None else taken.unionByName(own)).checkpoint()
    return taken


PICKED = 300_000
"""Most rows of a sample that are sent to every task; more are joined by a shuffle."""


def stratified(df: DataFrame, strata: Iterable[tuple[str, Column, int]], id_column: str) -> DataFrame:
    """Priority-ordered sample without replacement: each stratum takes up to its cap of the rows
    that earlier strata left, in the order of a hash.

    One pass over the rows: earlier strata take no more rows than their caps together, so of each stratum as many
    more rows by hash are enough to choose from. The rounds read only these.
    """
    shared_checkpoints(df.sparkSession)
    strata = list(strata)
    total = sum(cap for *_, cap in strata)
    fits = F.array_compact(F.array(*[F.when(rule, F.lit(i)) for i, (_, rule, _) in enumerate(strata)]))
    offered = _offered(df.select(id_column, *[c for c in df.columns if c != id_column]), id_column, fits, total)
    picked = _settled(offered.select(id_column, "__h", "__g"), id_column, [(F.lit(name), F.col("__g") == i, F.lit(cap)) for i, (name, _, cap) in enumerate(strata)])
    picked = picked.select(F.col(id_column).alias("__id"), "stratum")
    return df.join(F.broadcast(picked) if total <= PICKED else picked, F.col(id_column) == F.col("__id")).drop("__id")


def review_sample(df: DataFrame, id_column: str, code: str, thin: int, first: list[tuple[str, Column, int]], catch_all: list[tuple[str, int]], floor: int, target: int, share: float, least: int) -> DataFrame:
    """A sample for review, the most telling rows first: id, stratum.

    The ``first`` strata up to their caps; every row of codes that hold ``thin`` rows at most; catch-all
    codes up to their caps; ``floor`` rows of every other code; and of these a reserved budget, the
    greater of ``least`` and ``share`` of the target, in proportion to their rows, three at least.
    No row is taken twice; rows come in the order of a hash. Rows are read twice, to count the codes and to offer
    each group's first rows, of which the parameters tell how many can be asked for.
    """
    shared_checkpoints(df.sparkSession)
    codes = df.groupBy(code).agg(F.count(F.lit(1)).alias("__k")).checkpoint()
    caught = [name for name, _ in catch_all]
    usual = (F.col("__k") > thin) & ~F.col(code).isin(caught)
    total = codes.agg(F.sum(F.when(usual, F.col("__k")))).first()[0] or 1
    reserve = max(least, round(share * target))
    taken_before = sum(cap for *_, cap in first)
    most = max([thin, taken_before + floor + max(3, reserve), *[taken_before + cap for _, cap in catch_all]])
    groups = [F.when(rule, F.lit(f"1:{name}")) for name, rule, _ in first]
    groups += [F.when((F.col("__k") <= thin) & ~F.col(code).isin(caught), F.concat(F.lit("2:"), F.col(code)))]
    groups += [F.when(F.col(code) == name, F.lit(f"3:{name}")) for name in caught] + [F.when(usual, F.concat(F.lit("4:"), F.col(code)))]
    offered = _offered(df.join(codes, code), id_column, F.array_compact(F.array(*groups)), most)
    in_group = lambda g: F.col("__g") == g
    named = lambda prefix: F.concat(F.lit(prefix), F.substr("__g", F.lit(3)))
    steps = [(F.lit(f"1:{name}"), in_group(f"1:{name}"), F.lit(cap)) for name, _, cap in first]
    steps += [(named("2:census:"), F.col("__g").startswith("2:"), None)]
    steps += [(F.lit(f"3:catch_all:{name}"), in_group(f"3:{name}"), F.lit(cap)) for name, cap in catch_all]
    steps += [(named("4:floor:"), F.col("__g").startswith("4:"), F.lit(floor))]
    steps += [(named("5:reserve:"), F.col("__g").startswith("4:"), F.greatest(F.lit(3), F.bround(F.col("__k") * reserve / total)))]
    return _settled(offered, id_column, steps)


# What a column's name tells of its role.
ROLE_NAMES = {
    "id": r"(?i)(^|_)(id|uuid|guid|key|hash)($|_)", "title": r"(?i)(title|headline|subject|name)", "body": r"(?i)(body|text|content|article|story|description|summary)",
    "url": r"(?i)(url|link|href|domain|site|source)", "date": r"(?i)(date|time|published|created|found|_at$)",
}


def column_roles(profiled: DataFrame, k: int = 3) -> DataFrame:
    """role, column, score, position: the columns that may be the id, title, body, link and date of a table.

    ``profiled`` is a full profile. Scores add what names, distinct values, lengths and shapes tell;
    only scores above zero count.
    """
    named = lambda role, n: F.when(F.col("column").rlike(ROLE_NAMES[role]), n).otherwise(0.0)
    ratio, p50, full = F.col("distinct_ratio"), F.coalesce("p50", F.lit(0)), F.col("fill_pct") == 100
    when = lambda rule, n: F.when(rule, n).otherwise(0.0)
    scores = {
        "id": ratio * 2 + named("id", 1.5) + when(full, 0.5) - when(p50 > 120, 3.0),
        "title": named("title", 1.5) + when(p50.between(20, 250), 1.0) + when(ratio > 0.5, 0.5) - when(F.col("url_pct") > 20, 2.0),
        "body": named("body", 1.0) + F.when(p50 > 400, 2.0).when(p50 > 200, 1.0).otherwise(0.0),
        "url": F.col("url_pct") / 50 + named("url", 0.5), "date": F.col("date_pct") / 50 + named("date", 0.5),
    }
    rows = profiled.select("column", F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.round(s, 2).alias("score")) for r, s in scores.items()])).alias("x")).select("x.role", "column", "x.score").where("score > 0")
    nth = F.row_number().over(Window.partitionBy("role").orderBy(F.desc("score"), "column"))
    return rows.withColumn("position", nth).where(F.col("position") <= k)


def duplicates(df: DataFrame, roles: dict[str, str], body: str | None = None) -> DataFrame:
    """role, n_values, n_distinct, repeated, rows_in_repeats for each role's column, and for whole bodies by hash."""
    low = {r: F.nullif(F.lower(F.trim(F.col(c).cast("string"))), F.lit("")) for r, c in roles.items()}
    if body:
        low["body_exact"] = F.when(F.trim(body) != "", content_hash(F.col(body)))
    long = df.select(*[v.alias(r) for r, v in low.items()]).unpivot([], list(low), "role", "v").where("v IS NOT NULL").groupBy("role", "v").agg(F.count(F.lit(1)).alias("n"))
    many = F.col("n") > 1
    return long.groupBy("role").agg(F.sum("n").alias("n_values"), F.count(F.lit(1)).alias("n_distinct"), F.count(F.when(many, 1)).alias("repeated"), F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("rows_in_repeats"))


def disagreements(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, with the side's name; repeats count."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def nearest(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str, seq: str, before: int, after: int) -> DataFrame:
    """As-of join: for each left row the right row of its key nearest in days, within
    [day - before, day + after]; ties to the smaller seq.

    Days are cut into buckets as wide as the window. Each left row looks into the few buckets
    that its window touches, so key and bucket are an equi-join and a hot key is spread by time.
    """
    width = max(1, before + after)
    bucket = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01")) / width).cast("long")
    rows = left.withColumn("__b", F.explode(F.sequence(bucket(F.date_sub(left_day, before)), bucket(F.date_add(left_day, after)))))
    other = right.withColumn("__b", bucket(F.col(right_day)))
    met = rows.join(other, [key, "__b"]).where(F.col(right_day).between(F.date_sub(left_day, before), F.date_add(left_day, after)))
    gap = F.struct(F.abs(F.datediff(right_day, left_day)).alias("days"), F.col(seq))
    return met.groupBy(*left.columns).agg(F.count(F.lit(1)).alias("n_in_window"), F.min(gap).alias("__g")).select(*left.columns, "n_in_window", F.col("__g.days").alias("days_off"), F.col(f"__g.{seq}").alias(seq))
