"""Entities, groups and participants of a transaction, its investors and parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factmill.functions.extracted import is_group_label
from factmill.functions.scanners import bound
from factmill.functions.text import clean_name, name_list, squeezed


def entity_name(name: Column) -> Column:
    """Lower case, & as and, anything but letters and digits as one blank."""
    return squeezed(F.regexp_replace(F.regexp_replace(F.lower(name), "&", " and "), "[^a-z0-9]+", " "))


def stable_id(prefix: str, *parts: Column) -> Column:
    """Prefix and 16 hex digits of the bar-joined parts; nulls count as blank."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, 16))


def entities(rows: DataFrame) -> DataFrame:
    """One entity per (txn, normalised name), with the first name seen and how many rows bear it."""
    own = rows.withColumn("norm", entity_name(F.col("name"))).where("norm <> ''")
    found = own.groupBy("txn", "norm").agg(F.min_by("name", F.struct("seq", "name")).alias("name"), F.count(F.lit(1)).alias("n_rows"))
    return found.select(stable_id("ent_", F.col("txn"), F.col("norm")).alias("entity_id"), "txn", "name", "n_rows")


def investors(rows: DataFrame) -> DataFrame:
    """Source-level investors collapsed: lead if any says so; new by three-valued or."""
    own = rows.withColumn("norm", entity_name(F.col("name")))
    return own.groupBy("txn", "norm").agg(F.min_by("name", "seq").alias("name"), F.max(F.coalesce(F.col("is_lead"), F.lit(False)).cast("int")).alias("is_lead"), F.max("is_new").alias("is_new"), F.count(F.lit(1)).alias("n_sources"))


def parents(rows: DataFrame) -> DataFrame:
    """The last parent named per txn; several distinct names need review."""
    own = rows.withColumn("norm", entity_name(F.col("name")))
    found = own.groupBy("txn").agg(F.max_by("name", "seq").alias("parent"), F.count_distinct("norm").alias("n_names"))
    return found.withColumn("review", F.when(F.col("n_names") > 1, "NEEDS_REVIEW").otherwise("UNREVIEWED"))


# ---- the plan of participants


_SEAT = "array<struct<name:string,field:string,side:string,role:string,group_type:string,group_label:string,disclosed:string,is_primary:int,stage:string,confidence:string,status:string,reason:string>>"
RECORD_STAGE, AGREEMENT_STAGE = "TRANSACTION_RECORD_BACKFILL", "AGREEMENT_OBSERVATION_BACKFILL"


def _seat(name: Column, field: str, side: str, role, group=None, primary=None, stage: str = RECORD_STAGE, confidence=None, status=None, reason=None) -> Column:
    s = lambda v: F.lit(v).cast("string") if v is None or isinstance(v, str) else v
    kind, label, disclosed = group or (None, None, None)
    return F.struct(
        name.alias("name"), s(field).alias("field"), s(side).alias("side"), s(role).alias("role"), s(kind).alias("group_type"), s(label).alias("group_label"), s(disclosed).alias("disclosed"),
        (F.lit(None) if primary is None else primary).cast("int").alias("is_primary"), s(stage).alias("stage"), s(confidence).alias("confidence"), s("UNREVIEWED" if status is None else status).alias("status"), s(reason).alias("reason"),
    )


def _seats(value: str, field: str, side: str, role: str, group, several: tuple[str, str] | None) -> Column:
    """A seat for each name of a flat list; several names form a group of their own, unless they are in one."""
    def all_of(x: Column) -> Column:
        p, disclosed = x["p"], x["d"]
        own = F.size(p["names"]) > 1
        pick = lambda i: (lambda mine: F.when(group[0].isNotNull(), group[i]).otherwise(mine))
        made = (F.when(own, several[0]), F.when(own, several[1]), F.when(own, disclosed)) if several else (F.lit(None),) * 3
        kind, label, name = (pick(i)(made[i]) if group else made[i] for i in range(3))
        primary = F.when(F.size(p["names"]) == 1, 1) if role in ("ACQUIRER", "BUYER_PLATFORM") else None
        return F.transform(p["names"], lambda n: _seat(n, field, side, role, (kind, label, name), primary, status=p["status"], reason=p["reason"]))

    return bound(F.struct(name_list(F.col(value)).alias("p"), clean_name(F.col(value)).alias("d")), all_of).cast(_SEAT)


def seats(records: DataFrame, parents_named: DataFrame) -> DataFrame:
    """Every planned seat of each transaction: txn, entity_id, participant_id, group_id and what is told of them.

    ``records`` has txn, target_name, acquirer_name, acquirer_type, parent_seller_name, acquirer_sponsor_name
    and acquirer_merger_sub_name; ``parents_named`` has txn, name, confidence and seq, the parents that
    agreements name. A consortium is a group, and its generic label is no organisation. Flat lists are
    split where that is safe; more than one parent needs review. Groups without members are
    told by rows whose entity is null.
    """
    own = parents_named.withColumn("name", clean_name(F.col("name"))).where("name IS NOT NULL").withColumn("norm", entity_name(F.col("name")))
    own = own.groupBy("txn", "norm").agg(F.max_by(F.struct("name", "confidence"), "seq").alias("p"), F.min("seq").alias("first"))
    named = own.groupBy(F.col("txn").alias("__t")).agg(F.sort_array(F.collect_list(F.struct("first", "p"))).alias("__parents"))
    rows = records.join(named, F.col("txn") == F.col("__t"), "left")
    buyer = clean_name(F.col("acquirer_name"))
    joint = F.coalesce(F.col("acquirer_type") == "CONSORTIUM", F.lit(False))
    group = (F.when(joint, "CONSORTIUM"), F.when(joint, "Acquirer consortium"), F.when(joint, buyer))
    one = lambda c, field, side, role, primary=None: F.array(_seat(clean_name(F.col(c)), field, side, role, primary=primary))
    none = F.array().cast(_SEAT)
    alone = F.array(_seat(buyer, "acquirer_name", "BUYER", F.when(F.col("acquirer_type") == "PE_PORTFOLIO", "BUYER_PLATFORM").otherwise("ACQUIRER"), primary=F.lit(1))).cast(_SEAT)
    together = F.when(is_group_label(buyer), none).otherwise(_seats("acquirer_name", "acquirer_name", "BUYER", "ACQUIRER", group, None))
    parent = F.transform(F.coalesce("__parents", F.array().cast(rows.schema["__parents"].dataType)), lambda x: _seat(
        x["p"]["name"], "parent_acquirer_name", "BUYER", "PARENT_ACQUIRER", stage=AGREEMENT_STAGE, confidence=x["p"]["confidence"],
        status=F.when(F.size("__parents") > 1, "NEEDS_REVIEW").otherwise("UNREVIEWED"), reason=F.when(F.size("__parents") > 1, "several parents named"),
    ))
    empty = F.when(joint, F.array(_seat(F.lit(None).cast("string"), "acquirer_name", "BUYER", None, group, reason=F.when(is_group_label(buyer), "generic label of a group"))).cast(_SEAT)).otherwise(none)
    every = F.concat(
        one("target_name", "target_name", "TARGET", "TARGET", F.lit(1)).cast(_SEAT), empty, F.when(joint, together).otherwise(alone),
        _seats("parent_seller_name", "parent_seller_name", "SELLER", "PARENT_SELLER", None, ("SELLER_GROUP", "Seller group")),
        _seats("acquirer_sponsor_name", "acquirer_sponsor_name", "BUYER", "BUYER_SPONSOR", group, ("INVESTOR_GROUP", "Buyer sponsor group")),
        one("acquirer_merger_sub_name", "acquirer_merger_sub_name", "BUYER", "MERGER_SUB").cast(_SEAT), parent.cast(_SEAT),
    )
    out = rows.select("txn", F.posexplode(F.filter(every, lambda x: x["name"].isNotNull() | x["group_type"].isNotNull())).alias("seq", "s")).select("txn", "seq", "s.*")
    entity = F.when(F.col("name").isNotNull(), stable_id("ent_", F.lit("txn"), F.col("txn"), entity_name(F.col("name"))))
    team = F.when(F.col("group_type").isNotNull(), stable_id("tpg_", F.col("txn"), F.col("group_type"), F.col("side"), F.coalesce("disclosed", "group_label")))
    out = out.withColumn("entity_id", entity).withColumn("group_id", team)
    return out.withColumn("participant_id", F.when(F.col("entity_id").isNotNull(), stable_id("tp_", F.col("txn"), F.col("entity_id"), F.col("role"), F.col("side"), F.coalesce("group_id", F.lit("")))))


def _first(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*columns), F.struct("txn", "seq")).alias("__r")).select(key, "__r.*")


def plan(records: DataFrame, parents_named: DataFrame) -> dict[str, DataFrame]:
    """The plan's tables: entity, entity_alias, transaction_participant_group, transaction_participant."""
    rows = seats(records, parents_named)
    entity = _first(rows, "entity_id", ["txn", "name", "status"]).withColumn("normalized_name", entity_name(F.col("name")))
    return {
        "entity": entity.select("entity_id", F.col("name").alias("canonical_name"), "normalized_name", "status"),
        "entity_alias": entity.select("entity_id", F.col("name").alias("alias_name"), F.col("normalized_name").alias("normalized_alias"), F.lit("DISCLOSED_NAME").alias("alias_type")),
        "transaction_participant_group": _first(rows, "group_id", ["txn", "side", "group_type", "group_label", "disclosed"]),
        "transaction_participant": _first(rows, "participant_id", ["txn", "entity_id", "group_id", "side", "role", "is_primary", "stage", "confidence", "status", "reason"]),
    }


KEYS = {"entity": ["entity_id"], "entity_alias": ["entity_id", "normalized_alias", "alias_type"], "transaction_participant_group": ["group_id"], "transaction_participant": ["participant_id"]}


def would_insert(planned: dict[str, DataFrame], existing: dict[str, DataFrame]) -> DataFrame:
    """table, planned, would_insert: a dry run against the tables that are there."""
    out = None
    for name, rows in planned.items():
        there = existing[name].select(*KEYS[name]).distinct().withColumn("__there", F.lit(True)) if name in existing else None
        rows = rows.withColumn("__there", F.lit(None).cast("boolean")) if there is None else rows.join(there, KEYS[name], "left")
        one = rows.agg(F.count(F.lit(1)).alias("planned"), F.count(F.when(F.col("__there").isNull(), 1)).alias("would_insert")).select(F.lit(name).alias("table"), "planned", "would_insert")
        out = one if out is None else out.unionByName(one)
    return out


def investor_participants(rows: DataFrame) -> DataFrame:
    """One participant for each investor of a transaction, from what sources say: (txn, name, is_lead, is_new, is_existing, seq).

    A lead if any source says so; new and existing by three-valued or.
    """
    own = rows.withColumn("name", F.trim("name")).where("name <> ''").withColumn("norm", entity_name(F.col("name")))
    found = own.groupBy("txn", "norm").agg(
        F.min_by("name", "seq").alias("name"), F.max(F.coalesce(F.col("is_lead"), F.lit(False)).cast("int")).alias("is_lead"),
        F.max(F.col("is_new").cast("int")).alias("is_new"), F.max(F.col("is_existing").cast("int")).alias("is_existing"), F.count(F.lit(1)).alias("n_sources"),
    )
    entity = stable_id("ent_", F.lit("txn"), F.col("txn"), F.col("norm"))
    found = found.withColumn("entity_id", entity)
    return found.select(stable_id("tp_", F.col("txn"), F.col("entity_id"), F.lit("INVESTOR"), F.lit("INVESTOR"), F.lit("")).alias("participant_id"), "txn", "entity_id", "name", F.lit("INVESTOR").alias("side"), "is_lead", "is_new", "is_existing", "n_sources")
