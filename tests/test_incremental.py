"""Resolution kept up to date, against resolution of all claims at once."""

import random

import pytest
from pyspark.sql import functions as F

from factmill.operators import ledger
from factmill.operators.incremental import Resolution
from factmill.sources import versions

SCHEMA = "txn long, field string, id long, value double, tier string, confidence string, seq long, manual boolean"
KEYS = ["txn", "field"]


def made(n, seed, values=(None, 0.0, 1.0, 2.0)):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((rng.choice([None, *range(12)]), rng.choice("ab"), i, rng.choice(values), rng.choice(["T1", "T2", "T3", "T9", None]), rng.choice(["HIGH", "MEDIUM", "LOW", None]), rng.randrange(10**6) * 1000 + i, rng.random() < 0.04))
    return rows


def told(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("boolean", [False, True])
def test_states_merge_as_their_claims_do(spark, boolean):
    rows = made(600, 1)
    claims = spark.createDataFrame(rows, SCHEMA)
    parts = None
    for i in range(3):
        own = ledger.states(claims.where(F.pmod(F.hash("id"), F.lit(3)) == i), KEYS, boolean=boolean, manual=F.col("manual"))
        parts = own if parts is None else parts.unionByName(own)
    whole = ledger.states(claims, KEYS, boolean=boolean, manual=F.col("manual"))
    assert told(ledger.merged_states(parts, KEYS)) == told(whole)
    assert told(ledger.decided(ledger.merged_states(parts, KEYS), KEYS, boolean=boolean).drop("__tier")) == told(ledger.resolved(claims, KEYS, boolean=boolean, manual=F.col("manual")))


@pytest.mark.parametrize("seed", [2, 3])
def test_batches_replays_and_retractions_equal_a_full_run(spark, tmp_path, seed):
    rng, rows = random.Random(seed), made(300, seed)
    kept = Resolution(spark, f"file://{tmp_path}/r", KEYS, manual="manual", buckets=4)
    batches = [[] for _ in range(4)]
    for r in rows:
        batches[rng.randrange(4)].append(r)
    out, seen = set(), []
    for i, batch in enumerate(batches):
        seen += batch
        again = rng.sample(seen, min(len(seen), 30)) + batch[:3]  # replayed, and repeated in one batch
        back = {r[2] for r in rng.sample(rows, 12)}  # of claims that came, come now or come later
        if i == 2:
            back |= {r[2] for r in rows if r[0] == 5}  # all that a key ever had
        out |= back
        gone = spark.createDataFrame([(r[0], r[1], r[2]) for r in rows if r[2] in back], "txn long, field string, id long")
        kept.apply(spark.createDataFrame(batch + again, SCHEMA), gone)
        left = spark.createDataFrame([r for r in seen if r[2] not in out], SCHEMA)
        assert told(kept.resolved()) == told(ledger.resolved(left, KEYS, manual=F.col("manual")))
    version = kept.versions.latest()
    assert kept.apply(spark.createDataFrame(seen[:50], SCHEMA)) == version  # nothing new: no version
    want = told(kept.resolved())
    kept.compact(1)
    assert kept.versions.latest() > version and told(kept.resolved()) == want


def test_only_touched_keys_are_written(spark, tmp_path):
    kept = Resolution(spark, f"file://{tmp_path}/r", KEYS, manual="manual", buckets=2)
    rows = [r for r in made(200, 4) if r[0] is not None]
    kept.apply(spark.createDataFrame(rows, SCHEMA))
    kept.apply(spark.createDataFrame([(3, "a", 9000, 1.0, "T1", "HIGH", 1, False)], SCHEMA), spark.createDataFrame([(4, "b", next(r[2] for r in rows if r[:2] == (4, "b")))], "txn long, field string, id long"))
    assert {tuple(r) for r in kept.states().where("changed_in = 2").select(*KEYS).collect()} == {(3, "a"), (4, "b")}
    assert kept.versions.read("states").where("changed_in = 2").count() == 2


def test_a_batch_that_fails_may_come_again(spark, tmp_path, monkeypatch):
    kept = Resolution(spark, f"file://{tmp_path}/r", KEYS, manual="manual", buckets=2)
    rows = made(80, 5)
    kept.apply(spark.createDataFrame(rows[:40], SCHEMA), note={"batch": 1})
    before = told(kept.resolved())
    stage = kept.versions.stage

    def broken(table, *a):
        if table == "states":
            raise RuntimeError("lost")
        return stage(table, *a)

    monkeypatch.setattr(kept.versions, "stage", broken)
    with pytest.raises(RuntimeError):
        kept.apply(spark.createDataFrame(rows[40:], SCHEMA), note={"batch": 2})
    monkeypatch.undo()
    assert told(kept.resolved()) == before
    assert [kept.apply(spark.createDataFrame(rows[40:], SCHEMA), note={"batch": 2}) for _ in range(2)] == [2, 2]
    assert told(kept.resolved()) == told(ledger.resolved(spark.createDataFrame(rows, SCHEMA), KEYS, manual=F.col("manual")))


def test_two_writers_of_one_bucket_conflict(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    one = Resolution(spark, root, KEYS, manual="manual", buckets=1)
    rows = made(60, 6)
    one.apply(spark.createDataFrame(rows[:20], SCHEMA))
    commit = one.versions.commit

    def late(*a, **k):
        Resolution(spark, root, KEYS, manual="manual").apply(spark.createDataFrame(rows[20:40], SCHEMA))
        return commit(*a, **k)

    one.versions.commit = late
    with pytest.raises(versions.Conflict):
        one.apply(spark.createDataFrame(rows[40:], SCHEMA))
    one.versions.commit = commit
    one.apply(spark.createDataFrame(rows[40:], SCHEMA))
    assert told(one.resolved()) == told(ledger.resolved(spark.createDataFrame(rows, SCHEMA), KEYS, manual=F.col("manual")))


def test_a_manifest_can_be_published_by_rename(spark, tmp_path):
    store = versions.Versions(spark, f"file://{tmp_path}/t", buckets=2)
    store._local = False
    rows = spark.createDataFrame([(1, "a")], "id long, name string")
    assert [versions.replace_children(store, "c", rows, "id") for _ in range(2)] == [1, 2]
    assert not store._published(2, {}) and store.manifest(2)["version"] == 2


def test_claims_are_dealt_once_for_each_table(spark, tmp_path, monkeypatch):
    kept = Resolution(spark, f"file://{tmp_path}/r", KEYS, manual="manual", buckets=2)
    rows, plans = made(60, 7), []
    kept.apply(spark.createDataFrame(rows[:40], SCHEMA))
    stage = kept.versions.stage

    def watched(table, df, *a, **k):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(table, df, *a, **k)

    monkeypatch.setattr(kept.versions, "stage", watched)
    gone = spark.createDataFrame([(r[0], r[1], r[2]) for r in rows[30:50]], "txn long, field string, id long")
    kept.apply(spark.createDataFrame(rows, SCHEMA), gone)
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 1], plans
    assert told(kept.resolved()) == told(ledger.resolved(spark.createDataFrame(rows[:30] + rows[50:], SCHEMA), KEYS, manual=F.col("manual")))
