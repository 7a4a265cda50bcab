"""Work that must not grow with the square of a text's matches or with a sample's strata."""

import random
import re
import time

from pyspark.sql import functions as F

from factmill.functions import derive, scanners
from factmill.operators import derived, ledger, quality, relational, shared, writers
from factmill.plans import extraction
from factmill.plans.queries import FOUND


def test_places_of_many_matches(spark):
    rng = random.Random(1)
    text = "\n".join(f"Section {i}. {'x' * rng.randint(0, 30)}" for i in range(20_000))
    frame = spark.createDataFrame([(text,), ("none",), ("Section 1. a",), (None,)], "t string").coalesce(1)
    pattern = r"Section ([0-9]+)\."
    found = frame.select(scanners.places(F.col("t"), pattern, 1).alias("p"))
    found.collect()
    began = time.perf_counter()
    rows = [r["p"] for r in found.collect()]
    took = time.perf_counter() - began
    for own, source in zip(rows[:3], [text, "none", "Section 1. a"], strict=True):
        assert [(x["found"], x["start"], x["end"]) for x in own] == [(m[1], *m.span()) for m in re.finditer(pattern, source)]
    assert took < 5, took


def test_last_of_each(spark):
    rng = random.Random(2)
    for n in (0, 1, 7, 400):
        items = [(rng.choice("abcdefgh"), i) for i in range(n)]
        frame = spark.createDataFrame([(items,)], "x array<struct<k:string,v:int>>")
        got = frame.select(scanners.last_of_each(F.col("x"), "k").alias("y")).first()["y"]
        assert [tuple(r) for r in got] == [x for i, x in enumerate(items) if all(y[0] != x[0] for y in items[i + 1 :])]


def test_samples_by_the_sequential_rule(spark):
    rng, order = random.Random(3), {}
    rows = [(i, rng.choice("pqrst"), rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, code string, n int")
    for r in df.select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).collect():
        order[r["id"]] = r["h"]
    for _ in range(2):
        strata = [(f"s{k}", rng.randint(1, 9), rng.randint(0, 40)) for k in range(5)]
        got = {r["id"]: r["stratum"] for r in relational.stratified(df, [(s, F.col("n") < top, cap) for s, top, cap in strata], "id").collect()}
        want = {}
        for s, top, cap in strata:
            own = sorted((r[0] for r in rows if r[2] < top and r[0] not in want), key=order.get)[:cap]
            want |= dict.fromkeys(own, s)
        assert got == want


def test_the_last_write_of_best_priority(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2]), rng.choice([None, *range(50)]), i) for i in range(300)]
    got = ledger.by_priority(spark.createDataFrame(rows, "k int, p int, at int, id int"), ["k"], F.col("p"), [F.col("at"), F.col("id")])
    best = {}
    for k, p, at, i in rows:
        rank = (p is None, -(p or 0), at is not None, at or 0, i)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, p, at, i))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((b[1] for b in best.values()), key=str)


def test_equity_and_its_basis(spark):
    rows = [("ACQUISITION", "EQUITY_VALUE", 5.0), ("ACQUISITION", "EQUITY_VALUE", 0.0), ("MERGER", "ENTERPRISE_VALUE", 5.0), ("VC_ROUND", "EQUITY_VALUE", 5.0), (None, "EQUITY_VALUE", 7.0), (None, None, None)]
    got = spark.createDataFrame(rows, "e string, t string, a double").select(derive.equity_with_basis(F.col("e"), F.col("t"), F.col("a")).alias("x")).collect()
    assert [tuple(r["x"]) for r in got] == [(5.0, "STATED"), (None, None), (None, None), (None, None), (7.0, "STATED"), (None, None)]


def test_each_exhibit_once(spark):
    files = [(" u1 ", "EX-2.1", None), ("u1", "EX-2.01", None), ("u2", "x", "Exhibit 2.1 plan"), ("", "EX-2.1", None), (None, "EX-2.1", None), ("u3", "EX-21", "EX-2"), ("u4", "EX-99.1", None), ("u4", "EX-2.1", None)]
    frame = spark.createDataFrame([(1, files), (2, []), (3, None)], "id int, files array<struct<url:string,type:string,description:string>>")
    got = {r["id"]: [tuple(x) for x in r["x"]] for r in frame.select("id", scanners.exhibits(F.col("files"), "MERGER_AGREEMENT").alias("x")).collect()}
    assert got == {1: [("EX-2.1", "u1"), ("Exhibit 2.1 plan", "u2"), ("EX-2.1", "u4")], 2: [], 3: []}


def test_multiples_are_read_once(spark):
    won = spark.createDataFrame([(1, "multiple.PE.LTM.", 7.0, 0)], "txn long, field string, value double, flagged int")
    text = '{"multiple_type":"PE","period_basis":"LTM","multiple_value":%s,"as_reported_text":"%s"}'
    kept = spark.createDataFrame([(1, 2, text % (7.0, "later")), (1, 1, text % (7.0, "first")), (1, 0, text % (8.0, "other")), (1, 0, "no json")], "txn long, seq long, text string")
    rows = derived.multiple_rows(won, kept)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    assert [(r["multiple_type"], r["value"], r["period_end"], r["as_reported"]) for r in rows.collect()] == [("PE", 7.0, None, "first")]


def test_texts_of_a_small_file_are_many_tasks(spark):
    rows = extraction.agreed(spark, "/root/testdata/sf0.001")
    assert rows.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert rows.select("id").distinct().count() == rows.count() == spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()


def test_lines_are_dealt_before_they_are_grouped(spark):
    rows = FOUND["having_dupes"](spark, "/root/testdata/sf0.001")
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_rows_without_a_key_are_spread(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        rows = spark.range(2000).select("id", F.when(F.col("id") < 3, F.col("id")).alias("k"))
        out = shared.left_joined(rows, spark.createDataFrame([(1, "one"), (7, "seven")], "its long, name string"), "k", "its")
        parts = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        assert parts < 1500 and out.count() == 2000 and out.columns == ["id", "k", "its", "name"]
        assert [tuple(r) for r in out.where("its IS NOT NULL").collect()] == [(1, 1, 1, "one")]
        e = spark.range(1000).select(F.lit(1).alias("source"), F.col("id").alias("extraction"), F.lit("A").alias("status"), F.lit("B").alias("event"), F.when(F.col("id") == 5, 5).alias("txn"))
        sources = spark.createDataFrame([(1, "u"), (2, "v")], "source int, url string")
        got = quality.trace(sources, e, spark.createDataFrame([(5, 1), (6, 0)], "txn int, is_current int"))
        assert got.count() == 1001 and [r["extraction"] for r in got.where("txn = 5").collect()] == [5]
        assert [tuple(r)[3:] for r in got.where("source = 2").collect()] == [("(no staging row)", None, None, None)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_seats_are_looked_up_once(spark):
    records = spark.createDataFrame([(1, "T", "Buyer Group", None, ""), (2, "T", "B", "S", None), (None, "T", None, None, None)], "txn long, target_name string, acquirer_name string, parent_seller_name string, acquirer_sponsor_name string")
    seated = spark.createDataFrame([(1, "TARGET", "TARGET", 1), (2, "BUYER", "ACQUIRER", 1), (2, "TARGET", "TARGET", 0), (2, "BUYER", None, 1)], "txn long, side string, role string, is_current int")
    found = quality.missing_seats(records, seated)
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 2
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("acquirer_group_label", "1", "Buyer Group"), ("target_name_without_seat", "2", "T"), ("parent_seller_name_without_seat", "2", "S"), ("target_name_without_seat", None, "T")], key=str)


def test_agreements_are_read_by_compiled_columns(spark):
    answers = [
        None, "broken", "[1]", '{"a":true,"c":null,"e":1.50,"h":"x","j":[1],"notes":"n","merger_structure":"UNKNOWN"}',
        '{"securities":[null,1,{"shares_outstanding":true},{"security_type":3,"security_class":"","shares_outstanding":2,"shares_outstanding_as_of":7},{"shares_outstanding":"7"}]}',
        '{"consideration_components":[null,{"form":null,"amount":1},{"form":"","amount":"2","exchange_ratio":0.25}],"parties":{"role":"R","name":"N"}}',
        '{"parties":[null,{"name":"x"},{"role":"A","name":5},{"role":"B","name":true},{"role":"C","name":"Parent"},{"role":"D","name":" Y Inc "},{"role":"D","name":" Y Inc "}]}',
    ]
    rows = [(f"t{i}", i, 1, "F", "2024-01-01", a) for i, a in enumerate(answers)]
    made = writers.agreement_observations(spark.createDataFrame(rows, "txn string, document long, section int, filing_type string, filed string, answer string"))
    assert sorted((r["document"], r["field"], r["text"], r["number"], r["as_of"]) for r in made.collect()) == [
        (3, "a", "True", 1.0, None), (3, "e", "1.5", 1.5, None), (3, "h", "x", None, None), (4, "shares_outstanding.3", "2", 2.0, "7"),
        (5, "consideration..exchange_ratio", "0.25", 0.25, None), (5, "consideration.UNKNOWN.amount", "1", 1.0, None),
        (6, "party.A", "5", None, None), (6, "party.B", "true", None, None), (6, "party.D", "Y Inc", None, None),
    ]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("parse_json") + plan.count("parseJson") == 1  # lambdas aren't compiled
