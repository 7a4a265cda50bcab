"""Pairs of names of a token-set ratio at or above a threshold: an exact join that common words don't blow up.

A pair scores the threshold r (as a share) in one of two ways, and each has a join of its own:

* The shared tokens make up at least r / (2 - r) of one side's characters (all of them, if its
  tokens are the other's as well). That side offers its tokens, rarest first, as long as those from there
  on are enough; the other offers all of its tokens.
* The two lines differ by few insertions and deletions. Then the bags of their 2-grams, which don't
  depend on the tokens' order as every token begins and ends with a space, share at least
  (0.5 - 1.5 (1 - r)) L + 1 elements, L being both lengths. So if a name has N elements and c is the least
  share that its length allows, the two names' rarest N - c + 1 elements have one in common.

Elements are put in global order of rarity, so common ones are offered only where nothing else can
bear the pair. A key under which too many meet is split: a pair that meets there shares further elements,
so both sides offer that key joined with each later element that can be the next shared one, and so on
for up to ``LEVELS`` elements. Only tokens that are enough by themselves aren't split; what meets there is a
pair of the result. Nothing is lost at any step, and candidates are verified by the score.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 4
HOT = 64
"""A key is split if more than the square of so many pairs would meet under it."""


def _ranked(rows: DataFrame) -> DataFrame:
    """name, n, items (the name's elements as hashes, rarest of all names first) and sizes, from (name, n, e, size)."""
    counts = rows.groupBy("e").agg(F.count(F.lit(1)).alias("k"))
    told = rows.join(counts, "e").groupBy("name", "n").agg(F.array_sort(F.collect_list(F.struct("k", "e", "size"))).alias("x"))
    return told.select("name", "n", F.transform("x", lambda x: F.xxhash64(x["e"])).alias("items"), F.transform("x", lambda x: x["size"]).alias("sizes"))


def _offered(rows: DataFrame, places: Column) -> DataFrame:
    """A row for each of these places in items: key, at, and acc, the characters that the key covers."""
    first = rows.select("*", F.explode(places).alias("at"))
    return first.select(*rows.columns, "at", F.get("items", F.col("at")).alias("key"), F.get("sizes", F.col("at")).alias("acc"))


def _joined(rows: DataFrame, places: Column) -> DataFrame:
    """A row for each place that comes next: the key joined with the element there."""
    kept = [c for c in rows.columns if c not in ("at", "key", "acc")]
    more = rows.select(*kept, "key", "acc", F.explode(places).alias("at"))
    return more.select(*kept, "at", F.xxhash64("key", F.get("items", F.col("at"))).alias("key"), (F.col("acc") + 1 + F.get("sizes", F.col("at"))).alias("acc"))


def _met(left: DataFrame, right: DataFrame | None, next_left: Callable[[int], Column], next_right: Callable[[int], Column], done: Column, rule: Column, hot: int, levels: int) -> DataFrame:
    """Pairs (a, b), not yet distinct, that meet under a key; ``right`` is None for a join with itself.

    Rows of the left for which ``done`` holds can't be split. ``rule`` sees the sides as x and y.
    """
    out, both = None, right is not None

    def pairs(one: DataFrame, other: DataFrame) -> DataFrame:
        x, y = (df.select("key", *[F.col(c).alias(f"{side}_{c}") for c in ("name", "n")]) for df, side in ((one, "x"), (other, "y")))
        return x.join(y, "key").where(rule).select(F.least("x_name", "y_name").alias("a"), F.greatest("x_name", "y_name").alias("b"))

    for level in range(1, levels + 1):
        sizes = left.groupBy("key").agg(F.count(F.lit(1)).alias("n_left"))
        if both:
            sizes = sizes.join(right.groupBy("key").agg(F.count(F.lit(1)).alias("n_right")), "key")
            many = F.col("n_left") * F.col("n_right") > hot * hot
        else:
            many = F.col("n_left") > hot
        crowded = sizes.where(many).select("key").checkpoint() if level < levels else None
        if crowded is None or not crowded.take(1):
            own = pairs(left, right if both else left)
            return own if out is None else out.unionByName(own)
        cool = left.join(crowded, "key", "left_anti").unionByName(left.where(done).join(crowded, "key", "left_semi"))
        own = pairs(cool, right if both else cool)
        out = own if out is None else out.unionByName(own)
        left = left.where(~done).join(crowded, "key", "left_semi")
        if both:
            right = right.join(left.select("key").distinct(), "key", "left_semi")
            right = _joined(right, next_right(level)).checkpoint()
        left = _joined(left, next_left(level)).checkpoint()
    return out


def _from(start: Column, end: Column) -> Column:
    """The places from start to end, without end; none if there is no such place."""
    return F.when(end > start, F.sequence(start, end - 1)).otherwise(F.array().cast("array<int>"))


def candidates(names: DataFrame, threshold: float, hot: int = HOT, levels: int = LEVELS) -> DataFrame:
    """Pairs (a, b) of distinct names, a < b, among them all that score the threshold or more; see the module."""
    r = threshold / 100
    if not 2 / 3 < r <= 1:
        raise ValueError("the threshold must be above 66.7 and at most 100")
    cover, share, least_other = r / (2 - r), 0.5 - 1.5 * (1 - r), r / (2 - r)
    tokens = F.array_sort(F.array_distinct(F.filter(F.split("name", r"(?U)\s+"), lambda t: t != "")))
    rows = names.select("name").where("name IS NOT NULL").distinct().withColumn("tokens", tokens).where(F.size("tokens") > 0)
    rows = rows.withColumn("line", F.array_join("tokens", " ")).withColumn("n", F.length("line"))

    # tokens: those from a place on cover so many characters
    words = rows.select("name", "n", F.explode("tokens").alias("e")).withColumn("size", F.length("e"))
    words = _ranked(words)
    rest = F.transform("items", lambda _, i: F.aggregate(F.slice("sizes", i + 1, F.size("sizes")), F.lit(-1), lambda s, x: s + x + 1))
    words = words.withColumn("rest", rest).withColumn("need", cover * F.col("n") - 1e-9).checkpoint()
    places = F.transform("items", lambda _, i: i)
    left = _offered(words, F.filter(places, lambda i: F.get("rest", i) >= F.col("need")))
    right = _offered(words, places)
    ahead = F.filter(places, lambda j: (j > F.col("at")) & (F.col("acc") + 1 + F.get("rest", j) >= F.col("need")))
    shared = _met(left, right, lambda _: ahead, lambda _: F.filter(places, lambda j: j > F.col("at")), F.col("acc") >= F.col("need"), F.col("x_name") != F.col("y_name"), hot, levels)

    # 2-grams: the rarest that one of the shared must be among; shorter lines can't differ at all. No pair shares fewer
    # than the shortest line that can differ, so a key may hold that many
    shortest = math.ceil(r / (2 * (1 - r)) - 1e-9) if r < 1 else 0
    levels = min(levels, math.ceil(share * (shortest + math.ceil(least_other * shortest - 1e-9)) + 1 - 1e-9))
    line = F.concat(F.lit(" "), F.col("line"), F.lit(" "))
    grams = rows.where(F.col("n") * (2 * (1 - r) / r) >= 1 - 1e-9).select("name", "n", F.explode(F.transform(F.sequence(F.lit(1), F.col("n") + 1), lambda i: F.substring(line, i, F.lit(2)))).alias("g"))
    grams = grams.groupBy("name", "n", "g").agg(F.count(F.lit(1)).cast("int").alias("k"))
    grams = grams.select("name", "n", "g", F.explode(F.sequence(F.lit(1), F.col("k"))).alias("nth"))
    grams = _ranked(grams.select("name", "n", F.concat("g", F.col("nth").cast("string")).alias("e"), F.lit(0).alias("size")))
    need = F.ceil(share * (F.col("n") + F.ceil(least_other * F.col("n") - 1e-9)) + 1 - 1e-9).cast("int")
    grams = grams.withColumn("prefix", F.size("items") - need + 1)
    grams = grams.withColumn("items", F.slice("items", F.lit(1), F.col("prefix") + levels - 1)).withColumn("sizes", F.slice("sizes", F.lit(1), F.col("prefix") + levels - 1)).checkpoint()
    near = (F.col("x_name") < F.col("y_name")) & (F.col("x_n") >= least_other * F.col("y_n") - 1e-9) & (F.col("y_n") >= least_other * F.col("x_n") - 1e-9)
    later = lambda level: _from(F.col("at") + 1, F.least(F.size("items"), F.col("prefix") + level))
    alike = _met(_offered(grams, _from(F.lit(0), F.col("prefix"))), None, later, later, F.lit(False), near, hot, levels)
    return shared.unionByName(alike).distinct()
