"""Benchmark decontamination: size-partitioned MinHash containment search, native expressions only.

A test item is found in a document if at least ``SHARE`` of the item's distinct word
shingles are in the document, however long that is. Items are partitioned by their number of
shingles, into sizes from one power of two to the next. All items of a partition have sketches of
one length: that many of their smallest shingle hashes (a bottom-k MinHash), where the length is
the partition's greatest n - ceil(SHARE * n) + 1. A document that lacks all of a sketch lacks
too many shingles to qualify, so no match is lost, and a long document is probed with its whole
shingle set rather than with a sketch that its length would dilute. A document doesn't probe
partitions whose items need more shingles than it has. Candidates are verified by exact shingle
containment.

All partitions are probed in one scan of the documents, and only candidates are read again.
Benchmarks are small, but their size is checked: the sketches are broadcast up to a bound,
and joined by shuffle beyond it; so are the candidates. Documents are never paired with one
another.

Shingles are ``WORDS`` lower-cased words; an item of fewer words is one shingle of all its
words, and is found where those words stand together. Shingles are compared by 64-bit hashes.
Defined results: null or empty items and texts match nothing; a null doc_id or item_id is an id
like others; rows that share a doc_id are judged one by one, and the greatest containment counts;
rows that share an item_id are one item of all their shingles; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factmill.llm.scratch import Scratch, small

WORDS = 5
SHARE_NUM, SHARE_DEN = 4, 5
_SPACES = r"[\x20\x09-\x0D]+"


def word_hashes(text: Column) -> Column:
    """64-bit hashes of a text's words in order."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPACES), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(words: Column, k: int) -> Column:
    """Distinct hashes of all runs of k words; empty if there are fewer."""
    run = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    return F.when(F.size(words) >= k, F.array_distinct(run)).otherwise(F.array().cast("array<bigint>"))


def sketched(words: DataFrame) -> DataFrame:
    """item_id, k, shingles, n, need (shingles a document must hold), part and the MinHash sketch, from (item_id, w)."""
    rows = words.where(F.size("w") > 0).withColumn("k", F.least(F.size("w"), F.lit(WORDS)))
    per_k = F.coalesce(*[F.when(F.col("k") == k, shingle_hashes(F.col("w"), k)) for k in range(1, WORDS + 1)])
    rows = rows.select("item_id", "k", F.explode_outer(per_k).alias("h")).groupBy("item_id").agg(F.max("k").alias("k"), F.array_sort(F.collect_set(F.when(F.col("k") == F.lit(WORDS), F.col("h")))).alias("full"), F.array_sort(F.collect_set("h")).alias("any"))
    rows = rows.withColumn("shingles", F.when(F.col("k") == WORDS, F.col("full")).otherwise(F.col("any"))).drop("full", "any")
    rows = rows.withColumn("n", F.size("shingles")).withColumn("need", F.expr(f"cast((n * {SHARE_NUM} + {SHARE_DEN - 1}) div {SHARE_DEN} as int)"))
    rows = rows.withColumn("part", F.floor(F.log2("n") + 1e-9).cast("int"))
    lengths = rows.groupBy("part").agg(F.max(F.col("n") - F.col("need") + 1).alias("length"))
    return rows.join(F.broadcast(lengths), "part").withColumn("sketch", F.slice("shingles", F.lit(1), F.col("length"))).drop("length")


def found_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, n_shingles (of the item), n_shared: one row for each test item found in a row of docs."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    items = scratch.table(sketched(scratch.table(benchmark.select("item_id", word_hashes(F.col("text")).alias("w")), "words")), "items")
    sizes = items.groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.size("sketch")).alias("s"), F.min("need").alias("need")).collect()
    if not sizes:
        fields = [docs.schema["doc_id"], T.StructField("text_hash", T.LongType()), benchmark.schema["item_id"], T.StructField("n_shingles", T.IntegerType()), T.StructField("n_shared", T.IntegerType())]
        return docs.sparkSession.createDataFrame([], T.StructType(fields))
    ks = sorted(r["k"] for r in sizes)
    sketch = items.select("item_id", F.col("k").alias("item_k"), "need", F.explode("sketch").alias("h"))
    sketch = small(sketch, sum(r["s"] for r in sizes))
    # words, then shingles, each in a projection of its own: used more than once, they are kept apart. explode_outer, as
    # explode would push a filter on the array's size down through both projections and work them out again for each word
    probes = docs.select("doc_id", word_hashes(F.col("text")).alias("w"))
    least = {r["k"]: r["need"] for r in sizes}
    none = F.array().cast("array<bigint>")
    of = lambda k: F.when(F.size("w") - k + 1 >= least[k], shingle_hashes(F.col("w"), k)).otherwise(none)
    probes = probes.select("doc_id", F.size("w").alias("n_words"), F.concat(*[of(k) for k in ks]).alias("d"))
    probes = probes.select("doc_id", "n_words", F.explode_outer("d").alias("h"))
    met = probes.join(sketch, "h").where(F.col("n_words") - F.col("item_k") + 1 >= F.col("need")).groupBy("doc_id", "item_id").agg(F.lit(1).alias("one")).drop("one")
    met = scratch.table(met, "candidates")
    by_doc = met.groupBy(F.col("doc_id").alias("__c_id")).agg(F.collect_set("item_id").alias("items"), F.max(F.col("item_id").isNull()).alias("null_item"))
    rows = docs.select("doc_id", "text").join(small(by_doc, met.count()), F.col("doc_id").eqNullSafe(F.col("__c_id")))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "items", "null_item", word_hashes(F.col("text")).alias("w"))
    rows = rows.select("doc_id", "text_hash", F.array(*[shingle_hashes(F.col("w"), k) for k in ks]).alias("d"), F.explode(F.when(F.col("null_item"), F.concat("items", F.array(F.lit(None)))).otherwise(F.col("items"))).alias("i"))
    whole = small(items.select(F.col("item_id"), "k", "shingles", "n", "need"), sum(r["n"] for r in sizes))
    shared = F.size(F.array_intersect("shingles", F.get("d", F.array_position(F.array(*map(F.lit, ks)), F.col("k")).cast("int") - 1)))
    rows = rows.join(whole, F.col("i").eqNullSafe(F.col("item_id"))).select("doc_id", "text_hash", "item_id", F.col("n").alias("n_shingles"), "need", shared.alias("n_shared"))
    return rows.where(F.col("n_shared") >= F.col("need")).drop("need")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_shingles (of the item), n_shared: one row for each test item found in a document."""
    return found_rows(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_shared").alias("n_shared"))


def op2(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each test item found in a document."""
    return contaminated(docs, benchmark).select("doc_id", "item_id", F.col("n_shingles").cast("long").alias("n_shingles"), F.col("n_shared").cast("long").alias("n_shared"))


def kept_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no test item; of rows that share a doc_id, or have none, only those with an item go."""
    scratch = Scratch(docs.sparkSession, "decontaminated")
    held = scratch.table(found_rows(docs, benchmark).select(F.col("doc_id").alias("__c_id"), F.col("text_hash").alias("__c_text")).distinct(), "rows")
    return docs.join(small(held, held.count()), F.col("doc_id").eqNullSafe(F.col("__c_id")) & (F.xxhash64("text") == F.col("__c_text")), "left_anti")
