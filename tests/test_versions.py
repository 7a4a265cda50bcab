"""Versioned tables: one version at a time, conflicts, killed writers, buckets that stay."""

import threading

import pytest
from pyspark.sql import functions as F

from factmill.sources import versions as v

SCHEMA = "id long, name string, note string, version int"


@pytest.fixture
def store(spark, tmp_path):
    return v.Versions(spark, f"file://{tmp_path}/tables", buckets=8)


def told(df):
    return sorted(map(tuple, df.collect()), key=str)


def made(spark, ids, name="a"):
    return spark.createDataFrame([(i, name, "kept", 1) for i in ids], SCHEMA)


def test_an_upsert_is_a_version_and_old_ones_stay(spark, store):
    first = made(spark, range(40))
    assert v.upsert(store, "records", first, "id", ["name", "note"], "version", first.schema) == 1
    frozen = store.read("records")
    assert v.upsert(store, "records", spark.createDataFrame([(3, "b"), (99, None)], "id long, name string"), "id", ["name"], "version") == 2
    rows = {r["id"]: tuple(r) for r in store.read("records").collect()}
    assert rows[3] == (3, "b", "kept", 2) and rows[99] == (99, None, None, 1) and rows[4][3] == 1 and len(rows) == 41
    assert told(frozen) == told(store.read("records", 1)) and len(told(frozen)) == 40


def test_only_touched_buckets_are_written(spark, store):
    v.replace_children(store, "children", made(spark, [1, 1, 2, 2, 5, 6, 7, 8]), "id")
    before = store.manifest(1)["tables"]["children"]["files"]
    v.replace_children(store, "children", made(spark, [2], "new"), "id")
    after = store.manifest(2)["tables"]["children"]["files"]
    (own,) = store.buckets_of(made(spark, [2]), "id")
    assert {b for b in after if after[b] != before.get(b)} == {str(own)}
    assert [r[1] for r in told(store.read("children")) if r[0] == 2] == ["new"] and len(told(store.read("children"))) == 7


def test_soft_delete(spark, store):
    one = spark.createDataFrame([("k", 1), ("m", 2)], "key string, n int")
    v.supersede(store, "documents", one, "key")
    v.supersede(store, "documents", one.where("key = 'k'").withColumn("n", F.lit(9)), "key")
    assert told(store.read("documents")) == [("k", 1, 0), ("k", 9, 1), ("m", 2, 1)]


def test_two_writers_on_one_row_and_on_two(spark, store):
    rows = made(spark, range(30))
    v.upsert(store, "records", rows, "id", ["name", "note"], "version", rows.schema)
    base = store.latest()
    other = next(i for i in range(30) if store.buckets_of(made(spark, [i]), "id") != store.buckets_of(made(spark, [3]), "id"))
    staged = [store.stage("records", store.read("records", base, store.buckets_of(made(spark, [i]), "id")).withColumn("name", F.lit(n)), "id").replacing(store.buckets_of(made(spark, [i]), "id")) for i, n in ((3, "x"), (3, "y"), (other, "z"))]
    assert store.commit(staged[:1], base) == 2
    with pytest.raises(v.Conflict):
        store.commit(staged[1:2], base)
    assert store.commit(staged[2:], base) == 3  # another bucket: on top of version 2
    rows = {r["id"]: r["name"] for r in store.read("records").collect()}
    assert rows[3] == "x" and rows[other] == "z" and len(rows) == 30
    assert not store._fs.exists(store._path(f"{store.root}/{staged[1].folder}"))


def test_writers_at_once_all_land_or_conflict(spark, store):
    rows = made(spark, range(8))
    v.upsert(store, "records", rows, "id", ["name", "note"], "version", rows.schema)
    done, lost = [], []

    def write(i):
        new = spark.createDataFrame([(i, f"w{i}")], "id long, name string")
        while True:
            try:
                done.append(v.upsert(store, "records", new, "id", ["name"], "version"))
                return
            except v.Conflict:
                lost.append(i)

    threads = [threading.Thread(target=write, args=(i % 4,)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(done) == list(range(2, 8))
    rows = {r["id"]: r for r in store.read("records").collect()}
    assert len(rows) == 8 and [rows[i]["version"] for i in range(4)] == [3, 3, 2, 2]


def test_a_killed_writer_leaves_the_old_version(spark, store, monkeypatch):
    rows = made(spark, range(10))
    v.upsert(store, "records", rows, "id", ["name", "note"], "version", rows.schema)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(store, "_published", killed)
    with pytest.raises(KeyboardInterrupt):
        v.replace_children(store, "records", made(spark, [1], "lost"), "id")
    monkeypatch.undo()
    assert store.latest() == 1 and told(store.read("records")) == told(rows)
    assert store.vacuum(older_than=0) == 1 and told(store.read("records")) == told(rows)
    assert v.Versions(spark, store.root, buckets=3).buckets == 8


def test_compaction_and_vacuum(spark, store):
    for i in range(5):
        store.commit([store.stage("log", made(spark, range(6), f"n{i}"), "id")], store.latest())
    want = told(store.read("log"))
    assert store.compact("log", 3) == 6 and told(store.read("log")) == want
    assert all(len(p) == 1 for p in store.manifest(6)["tables"]["log"]["files"].values())
    assert store.vacuum(keep=1, older_than=0) == 5 and told(store.read("log")) == want
    with pytest.raises(ValueError, match="buckets"):
        store.stage("log", made(spark, range(20)), "id").replacing([0])
