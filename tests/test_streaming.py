"""Resolution of streams: replays, late rows, restarts and timers, against the batch."""

import datetime
import json
import os
import random

from pyspark.sql import functions as F

from factmill.operators import ledger
from factmill.operators.incremental import Resolution
from factmill.streaming import resolution

SCHEMA = "txn long, field string, id long, value double, tier string, confidence string, seq long, manual boolean, at timestamp, live boolean"
KEYS = ["txn", "field"]
START = datetime.datetime(2024, 1, 1)


def made(rng, n, hours):
    rows = []
    for i in range(n):
        at = START + datetime.timedelta(minutes=60 * hours * i / n + rng.uniform(-30, 30))
        rows.append((rng.choice([None, *range(8)]), rng.choice("ab"), i, rng.choice([None, 0.0, 1.0, 2.0]), rng.choice(["T1", "T2", "T3", "T9", None]), rng.choice(["HIGH", "MEDIUM", "LOW", None]), rng.randrange(10**6) * 1000 + i, rng.random() < 0.04, at.isoformat(), None))
    return rows


def filed(folder, number, rows):
    os.makedirs(folder, exist_ok=True)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    with open(f"{folder}/{number:03}.json", "w") as out:
        for r in rows:
            out.write(json.dumps(dict(zip(names, r, strict=True))) + "\n")
    os.utime(f"{folder}/{number:03}.json", (1_700_000_000 + number,) * 2)


def told(df):
    return sorted(map(tuple, df.collect()), key=str)


def batch(spark, rows):
    at = datetime.datetime.fromisoformat
    return spark.createDataFrame([(*r[:8], at(r[8]), r[9]) for r in rows], SCHEMA)


def run(spark, root, ttl=7 * 86_400):
    stream = resolution.resolved_stream(resolution.claims_stream(spark, f"{root}/in", SCHEMA), KEYS, late="3 hours", ttl_seconds=ttl, manual="manual")
    resolution.written(stream, f"{root}/out", f"{root}/check").awaitTermination()
    return spark.read.parquet(f"{root}/out")


def test_a_replayed_stream_ends_as_the_batch(spark, tmp_path):
    rng, root = random.Random(1), str(tmp_path)
    rows = made(rng, 160, 8)
    for k in range(2):
        # an hour late or repeated, within the watermark
        filed(f"{root}/in", k, rows[k * 40 : k * 40 + 40] + rng.sample(rows[: k * 40 + 40], 10))
    half = run(spark, root)
    assert told(resolution.answers(half, KEYS)) == told(ledger.resolved(batch(spark, rows[:80]), KEYS, manual=F.col("manual")))
    late, rest = rows[80:90], rows[90:]
    filed(f"{root}/in", 2, rest[:30] + rows[75:85])
    filed(f"{root}/in", 3, late + rest[30:] + rng.sample(rows[100:], 15))
    out = run(spark, root)  # a restart from the checkpoint
    assert told(resolution.answers(out, KEYS)) == told(ledger.resolved(batch(spark, rows), KEYS, manual=F.col("manual")))
    assert out.where("closed").count() == 0
    assert out.groupBy(*KEYS, "revision").count().where("count > 1").count() == 0


def test_keys_close_after_their_time(spark, tmp_path):
    root = str(tmp_path)
    claim = lambda txn, i, v, hour: (txn, "a", i, v, "T1", "HIGH", i, False, (START + datetime.timedelta(hours=hour)).isoformat(), None)
    filed(f"{root}/in", 0, [claim(1, 1, 1.0, 0), claim(2, 2, 5.0, 0)])
    filed(f"{root}/in", 1, [claim(2, 3, 6.0, 2)])
    filed(f"{root}/in", 2, [claim(3, 4, 7.0, 9)])  # the watermark reaches hour 6: txn 1 closes at 0 + 5; txn 2, told of at 2, at 7
    out = run(spark, root, 5 * 3600)
    assert told(out.where("closed").select("txn", "last_at", "revision")) == [(1, int((START - datetime.datetime(1970, 1, 1)).total_seconds() * 1000), 2)]
    filed(f"{root}/in", 3, [claim(1, 5, 9.0, 30)])
    out = run(spark, root, 5 * 3600)
    assert {r["txn"]: (r["value"], r["n_seen"]) for r in resolution.answers(out, KEYS).collect()} == {1: (9.0, 1), 2: (5.0, 2), 3: (7.0, 1)}
    assert {r["txn"] for r in out.where("closed").collect()} == {1, 2, 3}


def test_maintained_states_take_each_batch_once(spark, tmp_path):
    rng, root = random.Random(3), str(tmp_path)
    rows = made(rng, 90, 4)
    back = rng.sample(rows, 15)
    filed(f"{root}/in", 0, rows[:50] + [(*r[:9], False) for r in back[:8]])
    filed(f"{root}/in", 1, rows[30:] + [(*r[:9], False) for r in back[8:]])
    kept = Resolution(spark, f"file://{root}/kept", KEYS, manual="manual", buckets=4)
    for check in ("check", "again"):  # the second run has lost its checkpoint: all files come once more
        stream = resolution.claims_stream(spark, f"{root}/in", SCHEMA)
        resolution.maintained(stream, kept, "claims", f"{root}/{check}").awaitTermination()
        left = batch(spark, [r for r in rows if r not in back])
        assert told(kept.resolved()) == told(ledger.resolved(left, KEYS, manual=F.col("manual")))
    assert kept.versions.latest() == 2


def test_keys_of_one_bucket_have_states_and_closings_of_their_own(spark, tmp_path):
    root = str(tmp_path)
    claim = lambda txn, i, v, hour: (txn, "a", i, v, "T1", "HIGH", i, False, (START + datetime.timedelta(hours=hour)).isoformat(), None)
    filed(f"{root}/in", 0, [claim(t, t, float(t), t / 10) for t in range(20)])
    filed(f"{root}/in", 1, [claim(t, 100 + t, float(t), 2) for t in (3, 4)])
    filed(f"{root}/in", 2, [claim(50, 200, 1.0, 9)])  # the watermark reaches hour 6: those last told of up to hour 1 close
    stream = resolution.resolved_stream(resolution.claims_stream(spark, f"{root}/in", SCHEMA), KEYS, late="3 hours", ttl_seconds=5 * 3600, buckets=1)
    resolution.written(stream, f"{root}/out", f"{root}/check").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert {(r["txn"], r["revision"]) for r in out.where("closed").collect()} == {(t, 2) for t in range(11) if t not in (3, 4)}
    assert {(r["txn"], r["n_seen"]) for r in out.where("revision = 2 AND NOT closed").collect()} == {(3, 2), (4, 2)}
    assert resolution.answers(out, KEYS).count() == 21
