"""Resolution kept up to date: states per key, of which a batch makes only those anew that it touches.

Two tables share each version: the claims, which are only added to, and the states of keys
(see ``ledger.states``), of which the newest counts. Applying a batch reads the claims of the
buckets that its keys fall in, drops claims that are known by id, and adds the new claims and one
new state for each key they touch, made of all claims of the key that aren't retracted. Keys that
a batch doesn't touch aren't written.

Known ids meet new claims by key and id. Claims are then dealt by key once, as they are: a few of
them, as keys have, are less than their states, and retractions meet them where they lie.

A claim is known by key and id: the same id under the same key is the same claim, however often and
in whatever batch it comes. A retraction counts whenever it comes, before its claim too. Claims and
states become one version together; a batch that fails leaves none of both, and may come again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.operators import ledger
from factmill.sources.versions import Versions

CLAIM = ["tier", "confidence", "seq"]


class Resolution:
    """The resolution of a growing ledger under a folder that all share.

    ``keys`` name what is resolved (such as txn and field), ``id`` the claim; ``value`` is a claim's value.
    Claims have these, tier, confidence, seq and, if ``manual`` is told, a flag by that name.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], id: str = "id", value: str = "value", boolean: bool = False, manual: str | None = None, buckets: int = 64):
        self.versions = Versions(spark, root, buckets)
        self.keys, self.id, self.value, self.boolean, self.manual = keys, id, value, boolean, manual

    def _own(self) -> list[str]:
        return [*self.keys, self.id, self.value, *CLAIM, *([self.manual] if self.manual else [])]

    def _news(self, old: DataFrame, came: DataFrame) -> DataFrame:
        """What came and isn't known: of several rows of a claim or retraction the first by seq. Old rows travel as ids."""
        known = [*self.keys, self.id, "live"]
        others = [c for c in came.columns if c not in known]
        ids = old.select(*known, *[F.lit(None).cast(came.schema[c].dataType).alias(c) for c in others], F.lit(True).alias("__old"))
        # dealt before they are grouped, as hardly any two rows of a task are one claim
        rows = ids.unionByName(came.withColumn("__old", F.lit(False))).repartition(*self.keys, self.id)
        first = rows.groupBy(*known).agg(F.max("__old").alias("__old"), F.min_by(F.struct(*others), "seq").alias("__r"))
        return first.where("NOT __old").select(*known, "__r.*").select(*came.columns)

    def _changed(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """The states of all keys of ``new``, of old and new claims that aren't retracted; a key without any has one that saw nothing, which hides the older ones."""
        tier = F.array_position(F.array(*map(F.lit, ledger.TIERS)), F.col("tier")).cast("int")
        rank = ledger.confidence_rank(F.col("confidence"))
        parts = [c for c in self._own() if c not in (*self.keys, self.id, *CLAIM)]
        told = lambda rows, came: rows.select(*self.keys, self.id, "live", *parts, tier.alias("__t"), rank.alias("__c"), "seq", F.lit(came).alias("__came"))
        rows = told(old, False).unionByName(told(new, True)).withColumn("__part", self.versions.part(*self.keys)).repartition("__part")
        # a claim and its retraction are at most two rows, and the latter's values are null
        claim = [F.max(F.when(F.col("live"), F.col(c))).alias(c) for c in (*parts, "__t", "__c", "seq")]
        each = rows.groupBy("__part", *self.keys, self.id).agg(F.min("live").alias("live"), F.max("__came").alias("__came"), *claim)
        names = lambda of, at: F.coalesce(*[F.when(at == i, F.lit(x)) for i, x in of])
        live = each.select(
            "__part", *self.keys, "live", "__came", *[F.when(F.col("live"), F.col(c)).alias(c) for c in (*parts, "seq")],
            F.when(F.col("live"), names(enumerate(ledger.TIERS, 1), F.col("__t"))).alias("tier"), names(enumerate(["HIGH", "MEDIUM", "LOW"]), F.col("__c")).alias("confidence"),
        )
        manual = F.coalesce(F.col(self.manual), F.lit(False)) if self.manual else None
        return ledger.states(live, ["__part", *self.keys], self.value, self.boolean, manual, F.col("live"), ["__came"]).where("__came").drop("__came")

    def _latest(self, states: DataFrame) -> DataFrame:
        """The newest state of each key. Dealt before they are grouped, as versions lie in files of their own."""
        others = [c for c in states.columns if c not in self.keys]
        return states.repartition(*self.keys).groupBy(*self.keys).agg(F.max_by(F.struct(*others), "changed_in").alias("s")).select(*self.keys, "s.*")

    def apply(self, claims: DataFrame, retracted: DataFrame | None = None, note: dict | None = None) -> int:
        """Adds claims, takes back those that ``retracted`` (keys, id) names, and returns the version.

        A note that the history holds already tells that this batch is in, as does a batch without news: nothing is written then.
        """
        versions, keys, known = self.versions, self.keys, [*self.keys, self.id]
        base = versions.latest()
        if note and any(versions.manifest(v)["note"] == note for v in range(base, max(0, base - 16), -1)):
            return base
        came = claims.select(*self._own()).withColumn("live", F.lit(True))
        if retracted is not None:
            # a retraction is a row without a value: it needs no look at the claim, which may not be there yet
            blank = [F.lit(None).cast(f.dataType).alias(f.name) if f.name not in known else F.col(f.name) for f in came.schema.fields if f.name != "live"]
            came = came.unionByName(retracted.select(*known).select(*blank, F.lit(False).alias("live")))
        touched = versions.buckets_of(came, *keys)
        old = versions.read("claims", base, touched, came.schema)
        new = versions.stage("claims", self._news(old, came), *keys)
        try:
            if not new.written:
                versions.forget([new])
                return base
            after = self._changed(old, new.frame).withColumn("changed_in", F.lit(base + 1).cast("long"))
            state = versions.stage("states", after, *keys)
        except BaseException:
            versions.forget([new])
            raise
        return versions.commit([new, state], base, relied_on={"claims": touched, "states": touched}, note=note)

    def states(self, version: int | None = None) -> DataFrame:
        """Each key's newest state, with the version that changed it last."""
        return self._latest(self.versions.read("states", version)).where("n_seen > 0")

    def resolved(self, version: int | None = None) -> DataFrame:
        """As ``ledger.resolved`` over all claims that aren't retracted."""
        return ledger.decided(self.states(version), self.keys, self.value, self.boolean).drop("__tier")

    def compact(self, most: int = 8) -> int:
        """One folder for each bucket that has many, and of its states the newest of each key."""
        self.versions.compact("states", most, self._latest)
        return self.versions.compact("claims", most)
