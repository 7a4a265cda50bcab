"""Mixing sources to target weights by packed blocks and index permutations.

1. The words of each source are packed, in a seeded order of its documents, into blocks of
   ``BLOCK`` words; a document covers the blocks that its word range touches.
2. A source's target is its weight's share of all words, at most ``MAX_EPOCHS`` times its own
   words; what is above is shared among the others by weight (water filling). The target,
   over the mean words of the source's blocks, gives its slots in the whole mix.
3. Each output shard draws how many slots each source has in it: a multinomial draw conditioned
   on the sources' totals, made by dealing the sources' slots to shards by one pseudorandom
   permutation. An unconditioned draw would leave a source of few slots far from its target.
4. A shard's counts, in the order of shards, say which of a source's slot numbers it holds. The
   j-th slot of a source takes the block that the source's own permutation of its indexes
   gives for j, starting again after each pass. No block, and so no document, is taken more
   than ``MAX_EPOCHS`` times. Blocks and documents join by (source, index).
5. Whole documents (the pipeline's stage): the words that blocks take of a document, over its
   size, are its expected copies; it gets their whole part, and one more by systematic sampling of
   the fractions within its source, in order of size. So a source's copies hold its expected
   words but for about one document, however long its documents are, and no document has more
   than ``MAX_EPOCHS`` copies.

Only DataFrame expressions are used. A hot source is spread by (source, bucket); see
``ranks``. Windows over all sources see a row for each source. Reruns agree, as every choice
is a function of the rows and the seed.

Defined results: a null or empty text has no words and takes none (as a whole document it stays
once); a null source sorts last; rows that repeat a doc_id are rows of their own, and rows equal in
doc_id, source and text share their copies; an empty table gives no rows; without any words every
target is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factmill.llm.ranks import running, spread
from factmill.llm.scratch import Scratch, small

WEIGHTS = (5, 2, 1)
"""By code point of the source, null last, repeating."""
MAX_EPOCHS = 3
BLOCK = 64
OUTPUT_SHARDS = 64
PIECE = 1 << 15
"""Most slots that are made from one row."""
STRATUM = 1.1
"""Sizes within one stratum of the sampling of copies differ by this factor at most."""
SEED = 77
WORD = r"[^\x20\x09-\x0D]+"


def permuted(rows: DataFrame, j: Column, n: Column, key: Column, into: str) -> DataFrame:
    """``into``: a permutation of 0 .. n-1, for each key, applied to j; all longs, n >= 1.

    Two affine steps whose multiplier is a prime that does not divide n, with a swap of low
    and high part between them: each is one to one, and so is the whole. Each step is a column of
    its own, so that none is written out more than once in the generated code.
    """
    names = [f"__p{k}" for k in range(6)]
    pj, pn, pk, pa, px, side = names
    primes = [1_000_003, 999_983, 999_979, 999_961, 999_959, 999_953]
    multiplier = F.coalesce(*[F.when(F.col(pn) % p != 0, F.lit(p)) for p in primes], F.lit(1)).cast("long")
    affine = lambda x, salt: (x * F.col(pa) + F.pmod(F.xxhash64(F.lit(salt), F.col(pk)), F.col(pn))) % F.col(pn)
    rows = rows.withColumns({pj: j.cast("long"), pn: n.cast("long"), pk: key}).withColumn(pa, multiplier)
    rows = rows.withColumn(side, F.greatest(F.floor(F.sqrt(F.col(pn).cast("double"))).cast("long"), F.lit(1).cast("long"))).withColumn(px, affine(F.col(pj), 1))
    low, high = F.col(px) % F.col(side), F.floor(F.col(px) / F.col(side)).cast("long")
    mixed = high * F.col(side) + F.pmod(low + F.pmod(F.xxhash64(F.lit(2), F.col(pk), high), F.col(side)), F.col(side))
    rows = rows.withColumn(px, F.when(F.col(px) < F.floor(F.col(pn) / F.col(side)).cast("long") * F.col(side), mixed).otherwise(F.col(px)))
    return rows.withColumn(into, affine(F.col(px), 3)).drop(*names)


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target from rows (source, source_size): water filling in closed form.

    In order of cap / weight, some first sources stop at their caps and the rest share what is
    left by weight, up to a level. Capping one more source raises the level as long as its cap
    lies under it and lowers it afterwards, so the greatest of these levels is the right one.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    rows = sizes.withColumn("__w", w).withColumn("__cap", F.col("source_size") * float(MAX_EPOCHS))
    up = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = (
        rows.withColumn("__caps", F.coalesce(F.sum("__cap").over(up), F.lit(0.0)))
        .withColumn("__ws", F.coalesce(F.sum("__w").over(up), F.lit(0.0)))
        .withColumn("__all", F.sum("source_size").over(everything).cast("double"))
        .withColumn("__wall", F.sum("__w").over(everything))
    )
    level = (F.col("__all") - F.col("__caps")) / (F.col("__wall") - F.col("__ws"))
    rows = rows.withColumn("__level", F.max(level).over(everything))
    return rows.select("source", "source_size", F.least(F.col("__cap"), F.col("__w") * F.col("__level")).alias("target"))


def _pieces(rows: DataFrame, amount: str, n_all: int) -> DataFrame:
    """Each row once for each of its numbers 0 .. amount - 1 (__j), made in many tasks."""
    rows = rows.where(F.col(amount) > 0).withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(amount) - 1) / PIECE).cast("long"))))
    # a number of partitions that is named isn't coalesced, however small the pieces are
    rows = rows.repartition(max(1, min(4096, n_all // PIECE + 8)), F.xxhash64(*rows.columns))
    return rows.withColumn("__j", F.explode(F.sequence(F.col("__piece") * PIECE, F.least(F.col(amount), (F.col("__piece") + 1) * PIECE) - 1))).drop("__piece")


def drawn(sources: DataFrame, n_slots: int, shards: int = OUTPUT_SHARDS, seed: int = SEED) -> DataFrame:
    """shard, source, n: how many slots each source has in each output shard.

    ``sources`` has source and n_slots, ``n_slots`` is their sum. The shards' sizes differ by one at most.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rows = sources.select("source", "n_slots", F.coalesce(F.sum("n_slots").over(order), F.lit(0)).cast("long").alias("__first"))
    total = F.lit(max(n_slots, 1)).cast("long")
    rows = permuted(_pieces(rows, "n_slots", n_slots), F.col("__first") + F.col("__j"), total, F.lit(seed).cast("long"), "__at")
    rows = rows.select(F.floor(F.col("__at") * F.lit(shards) / total).cast("int").alias("shard"), "source")
    return rows.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("n"))


def slots(counts: DataFrame, sources: DataFrame, n_slots: int, seed: int = SEED) -> DataFrame:
    """shard, source, block: one row per slot of the mix, from each shard's counts.

    ``sources`` has source and n_blocks, one row for each.
    """
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    rows = counts.withColumn("__start", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long"))
    rows = rows.join(sources.select(F.col("source").alias("__s"), "n_blocks"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    rows = _pieces(rows, "n", n_slots).withColumn("__j", F.col("__start") + F.col("__j"))
    key = F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("\0null")), F.floor(F.col("__j") / F.col("n_blocks")))
    return permuted(rows, F.col("__j") % F.col("n_blocks"), F.col("n_blocks"), key, "block").select("shard", "source", "block")


def packed(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words taken by blocks), key (of doc_id, source and text)."""
    scratch = Scratch(docs.sparkSession, "mix")
    key = F.struct(F.xxhash64(F.lit(1), "doc_id", "source", "text").alias("a"), F.xxhash64(F.lit(2), "text", "source", "doc_id").alias("b"))
    rows = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"))
    rows = scratch.table(rows, "sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__rows"))
    sources = scratch.table(totals, "sources")
    n, n_sources = (int(x or 0) for x in sources.agg(F.sum("__rows"), F.count(F.lit(1))).first())
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    sources = targets(sources.select("source", "source_size")).withColumn("n_blocks", blocks)
    sources = sources.withColumn("n_slots", F.coalesce(F.least(F.round(F.col("target") * F.col("n_blocks") / F.nullif("source_size", F.lit(0).cast("long"))), F.lit(MAX_EPOCHS) * F.col("n_blocks")), F.lit(0)).cast("long"))
    sources = scratch.table(sources, "targets")
    n_slots = int(sources.agg(F.sum("n_slots")).first()[0] or 0)

    buckets = spread(n)
    rows = rows.withColumn("__h", F.xxhash64(F.lit(seed), "doc_id", "size")).withColumn("__b", F.pmod("__h", F.lit(buckets)))
    rows = scratch.table(running(rows, ["source"], "__b", [F.col("__h"), F.col("doc_id"), F.col("size"), F.col("key")], F.col("size"), "__at").withColumn("__row", F.monotonically_increasing_id()), "placed")
    counts = scratch.table(drawn(sources, n_slots, seed=seed), "counts")
    # grows with the input: Spark can't see that from the few rows that it is exploded from, so the join is told to sort
    uses = slots(counts, sources, n_slots, seed).groupBy("source", "block").agg(F.count(F.lit(1)).alias("__uses"))
    cover = rows.where("size > 0").select("__row", "source", "__at", "size", F.explode(F.sequence(F.floor(F.col("__at") / block).cast("long"), F.floor((F.col("__at") + F.col("size") - 1) / block).cast("long"))).alias("block"))
    cover = cover.withColumn("__words", F.least(F.col("__at") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(F.col("__at"), F.col("block") * block))
    cover = cover.select("__row", F.coalesce("source", F.lit("\0null")).alias("source"), "block", "__words")
    taken = cover.join(uses.withColumn("source", F.coalesce("source", F.lit("\0null"))).hint("merge"), ["source", "block"]).groupBy("__row").agg(F.sum(F.col("__uses") * F.col("__words")).alias("taken"))
    told = small(sources.select(F.col("source").alias("__s"), "source_size", "target"), n_sources)
    return rows.join(taken, "__row", "left").join(told, F.col("source").eqNullSafe(F.col("__s")), "left").select(
        "doc_id", "source", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "key",
    )


def mix(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, key, copies: how often each document is taken as a whole."""
    scratch = Scratch(docs.sparkSession, "copies")
    rows = scratch.table(packed(docs, block, seed), "packed")
    unit = 1 << 20
    size = F.nullif("size", F.lit(0).cast("long"))
    share = F.coalesce(F.floor(F.col("taken") % size * unit / size), F.lit(0)).cast("long")
    # strata of like sizes, each dealt to buckets, so that a source is spread and its sizes are in order
    buckets = spread(rows.count())
    stratum = F.floor(F.log(F.greatest("size", F.lit(1))) / F.log(F.lit(STRATUM))).cast("long")
    rows = rows.withColumn("__h", F.xxhash64(F.lit(seed), F.lit("copies"), "key")).withColumn("__b", stratum * buckets + F.pmod("__h", F.lit(buckets)))
    rows = running(rows.withColumn("__share", share), ["source"], "__b", [F.col("size"), F.col("__h"), F.col("key"), F.col("taken")], F.col("__share"), "__upto")
    start = F.pmod(F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("\0null"))), F.lit(unit))
    passed = F.floor((F.col("__upto") + F.col("__share") + start) / unit) - F.floor((F.col("__upto") + start) / unit)
    copies = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / size) + passed)
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken", "key", copies.cast("int").alias("copies"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them; those of no words once."""
    scratch = Scratch(docs.sparkSession, "mixed")
    made = mix(docs.select("doc_id", "source", "text")).groupBy("key").agg(F.sum("copies").cast("int").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    made = scratch.table(made.where("__copies > 0").select(F.col("key.a").alias("__a"), F.col("key.b").alias("__b"), "__copies", "__rows"), "keep")
    own = docs.withColumn("__ka", F.xxhash64(F.lit(1), "doc_id", "source", "text")).withColumn("__kb", F.xxhash64(F.lit(2), "text", "source", "doc_id"))
    own = own.join(small(made, made.count()), (F.col("__ka") == F.col("__a")) & (F.col("__kb") == F.col("__b")))
    plain = [f.name for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    repeated = own.where("__rows > 1").groupBy("__a", "__b").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("__doc"), F.first("__copies").alias("__copies")).select("__doc.*", "__copies")
    out = own.where("__rows = 1").select(*docs.columns, "__copies").unionByName(repeated)
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def op6(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return packed(docs).select("doc_id", "size", "source_size", "target", "taken", "source")
