"""The pipeline's stages on a small table, each against what it must keep."""

import re

import pytest

import corpus_pipeline
from factmill.llm import decontamination, mixing

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("pipeline"))
    item = " ".join(f"q{i}" for i in range(30))
    rows = []
    for i in range(400):
        body = " ".join(f"w{(i * 37 + k * (i % 11 + 1)) % 5000}" for k in range(60))
        if i % 5 == 0:
            body = body[:100] + " you vile fool " + body[100:]
        rows.append((i, body, "en", f"s{i % 4}", len(body)))
    rows += [(500 + k, rows[1][1] + " tail" * (k % 2), "en", "s0", 9) for k in range(6)]
    rows += [(600, LONG + item + " " + LONG, "en", "s1", 9), (601, None, "en", None, 0), (602, "", None, "s1", 0)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(0, 400)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{root}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, root).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out.append((name, docs))
    return dict(out), rows, root


LONG = "so it goes on and on " * 50


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_each_stage_keeps_what_it_should(spark, stages):
    out, rows, root = stages
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "mixing", "sharding"]
    assert all(out[n].columns == ["doc_id", "text", "lang", "source", "n_chars"] for n in list(out)[:-1])
    clean = {i for i in range(400) if i % 5} | {500 + k for k in range(6)} | {600, 601, 602}
    left = set(ids(out["toxicity"]))
    assert len(left - clean) <= 2 and len(clean - left) <= 2
    text = {r[0]: r[1] for r in rows}
    groups, kept = [], []
    for d in sorted(left):
        s = shingles(text[d])
        home = [g for g in groups if s and any(100 * len(s & t) >= 80 * len(s | t) for t in g)]
        groups = [g for g in groups if g not in home] + [[s, *[t for g in home for t in g]]]
        if not home:
            kept.append(d)
    assert ids(out["ngram_jaccard"]) == kept
    assert ids(out["decontamination"]) == [d for d in kept if d != 600]
    made = mixing.mix(out["decontamination"]).collect()
    copies = [r["doc_id"] for r in made for _ in range(r["copies"])]
    assert ids(out["mixing"]) == sorted(copies) and {601, 602} <= set(copies)
    for source in {r["source"] for r in made}:
        own = [r for r in made if r["source"] == source]
        longest = max(r["size"] for r in own)
        assert abs(sum(r["copies"] * r["size"] for r in own) - own[0]["target"]) <= longest + 3 * mixing.BLOCK
        assert all(r["copies"] * r["size"] <= 3 * r["size"] for r in own)
    assert ids(out["sharding"]) == sorted(copies)
    counts = [r["count"] for r in out["sharding"].groupBy("shard").count().collect()]
    assert max(counts) - min(counts) <= 1
    assert ids(corpus_pipeline.run(spark, root)) == sorted(copies)


def test_stages_take_empty_and_odd_tables(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, "some test item of seven words here")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    none = spark.createDataFrame([], DOCUMENTS)
    odd = [(None, None, None, None, None), (None, "", "en", None, 0), (7, "one", "en", "s", 3), (7, "one", "en", "s", 3), (7, "two words", None, "s", 9), (8, "x " * 30000, "en", "t", 60000)]
    clash = spark.createDataFrame(odd, DOCUMENTS).selectExpr("*", "1 AS score", "2 AS key", "3 AS size", "4 AS copies", "5 AS shard", "6 AS node", "7 AS item_id", "8 AS target", "9 AS rank")
    for docs, kept in ((none, 0), (clash, 5)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, root)
            if name != "sharding":
                assert out.columns == docs.columns
                # of the rows that repeat in full one stays; the mix takes those with words as often as it needs
                assert out.count() == {"toxicity": docs.count(), "ngram_jaccard": kept, "decontamination": docs.count()}.get(name, out.count())
            else:
                assert out.count() == docs.count()


def test_rows_of_null_or_repeated_id_are_judged_alone(spark):
    item = " ".join(f"q{i}" for i in range(20))
    long = "so it goes on and on " * 30
    rows = [(None, "x " + item, 1), (None, "clean one two three four five", 2), (7, long + item, 3), (7, "quite clean text of seven words here", 4), (None, None, 5), (8, "", 6), (7, long + item, 7), (9, long, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    tests = spark.createDataFrame([(1, item), (None, "q1 q2 q3"), (3, None)], "item_id int, text string")
    for _ in range(2):
        kept = decontamination.kept_documents(docs, tests)
        assert kept.columns == docs.columns and sorted(r["item_id"] for r in kept.collect()) == [2, 4, 5, 6, 8]
    assert decontamination.kept_documents(docs, tests.limit(0)).count() == len(rows)
