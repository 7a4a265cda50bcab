"""Every query of the engine against its SQL, on the smallest tables."""

import os
import random

import pytest

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")

if not os.path.isdir(SF):
    pytest.skip("no test tables", allow_module_level=True)

from factmill.plans import extraction, growing, more, oracles, queries, warehouse  # noqa: E402, F401
from factmill.plans.domain import TABLES  # noqa: E402


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(str([round(x, 6) if isinstance(x, float) else x for x in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_matches_sql(spark, db, name):
    df = queries.FOUND[name](spark, SF)
    columns = sorted(df.columns)
    got = plain(map(tuple, df.select(*columns).collect()))
    want = plain(db.execute("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({oracles.SQL[name]})").fetchall())
    assert got == want


def test_every_query_is_checked():
    assert set(oracles.SQL) <= set(queries.FOUND) and set(queries.FOUND) - set(oracles.SQL) <= {"cluster_fuzzy", "page_texts"}


def test_keywords_beside_letters_of_any_script_are_found_as_by_sql(spark, tmp_path):
    rng = random.Random(5)
    words = ["total debt", "leverage", "net debt", "buys", "stake", "series b", "take-private", "spin out", "jv", "raised", "credit facility", "cash on hand", "backs", "sold"]
    odd = ["", " ", "é", "é", "ж", "_", "9", "ſ", "K", "ı", "İ", "\x0b", "\x0c", "\xa0", "\x85", "中", "-", "‍", "😀"]
    text = lambda w: "".join(rng.choice(odd) if x in " -" and rng.random() < 0.4 else "ſ" if x == "s" and rng.random() < 0.2 else "K" if x == "k" and rng.random() < 0.2 else x.upper() if rng.random() < 0.3 else x for x in w)
    rows = [(i * 15 + 1, i, f"r{i}", rng.choice(odd) + text(rng.choice(words)) + rng.choice(odd) + rng.choice(["", "x"])) for i in range(3000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = queries.FOUND["keyword_scan"](spark, str(tmp_path))
    want = con.execute(oracles.SQL["keyword_scan"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and 0 < sum(r[2] for r in want) < 3000


def test_claims_of_the_flagship_travel_once(spark):
    plan = queries.FOUND["resolve_flagship"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(txn" in plan and "field" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def test_claims_with_anchors_travel_once_for_winners_and_once_for_qualifiers(spark):
    plan = queries.FOUND["anchor_shared"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if " Exchange " in x]
    assert len(exchanges) == 2 and all("hashpartitioning(txn" in x and "low_T1" not in x for x in exchanges)


def test_conflicts_are_settled_from_what_was_written_of_the_ledger(spark):
    made = queries.FOUND["resolver_failures"](spark, SF)
    assert made.inputFiles() and not [f for f in made.inputFiles() if "lineitem" in f]
