"""Golden vectors and properties of the engine's functions and operators."""

import datetime
import itertools
import random
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factmill.functions import derive, scanners, signals, text, vocab
from factmill.operators import cluster, ledger, participants, relational
from factmill.sources import fetch, files, sinks
from factmill.streaming import ingest

LEDGER = "txn long, field string, value double, tier string, confidence string, seq long, manual boolean"


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def pick(rows, boolean=False):
    """Resolution of one field's rows, row by row."""
    rows = sorted(rows, key=lambda r: r[5])
    if hand := [r for r in rows if r[6] and r[2] is not None]:
        return hand[-1][2], 0
    live = [r for r in rows if r[2] is not None and not (boolean and r[2] == 0)]
    for tier in ledger.TIERS:
        own = [r for r in live if r[3] == tier]
        if not own:
            continue
        if len({r[2] for r in own}) == 1:
            return own[0][2], 0
        rank = [{"HIGH": 0, "LOW": 2}.get(r[4], 1) for r in own]
        best = [r for r, k in zip(own, rank, strict=True) if k == min(rank)]
        return (best[0][2], 0) if len(best) == 1 else (own[0][2], 1)
    return (0.0 if boolean and any(r[2] is not None for r in rows) else None), 0


@pytest.mark.parametrize("boolean", [False, True])
def test_resolution_matches_a_row_by_row_reading(spark, boolean):
    rng, rows, seq = random.Random(7), [], itertools.count(1)
    for txn in range(300):
        for _ in range(rng.randint(1, 6)):
            rows.append((txn, "f", rng.choice([None, 0.0, 1.0, 2.0]), rng.choice(["T1", "T2", "T3", "T9", None]), rng.choice(["HIGH", "MEDIUM", "LOW", None, "?"]), next(seq), rng.random() < 0.05))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    got = {r["txn"]: (r["value"], r["flagged"]) for r in ledger.resolved(spark.createDataFrame(shuffled, LEDGER), ["txn", "field"], boolean=boolean, manual=F.col("manual")).collect()}
    assert got == {t: pick(list(g), boolean) for t, g in itertools.groupby(rows, key=lambda r: r[0])}


def test_companions_follow_the_winner(spark):
    rows = [(1, 10, "price", 5.0, None), (1, 10, "ccy", None, "USD"), (1, 11, "price", 7.0, None), (1, 11, "ccy", None, "EUR")]
    own = spark.createDataFrame(rows, "txn long, source long, field string, value double, text string")
    won = spark.createDataFrame([(1, 7.0)], "txn long, value double")
    assert [r["text"] for r in ledger.anchored(own, won, "price", "ccy").collect()] == ["EUR"]
    assert [r["value"] for r in ledger.by_sibling(own, "price", "ccy", "USD").collect()] == [5.0]


def test_typed_values_go_round(spark):
    for kind, value, back in [("number", 2.5, 2.5), ("string", "x", "x"), ("boolean", True, 1), ("boolean", False, 0)]:
        t, n = ledger.encoded(F.lit(value), kind)
        assert one(spark, ledger.decoded(t, n, kind)) == back


def test_inserts_are_idempotent(spark):
    new = spark.createDataFrame([(1, "a", 5), (1, "a", 4), (2, "b", 6)], "txn long, text string, seq long")
    once = ledger.inserted(new.limit(0), new, ["txn", "text"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", 4), (2, "b", 6)] == sorted(map(tuple, ledger.inserted(once, new, ["txn", "text"]).collect()))


@pytest.mark.parametrize(("raw", "want"), [("65%", 65.0), ("65.0 %", 65.0), ("approximately 40%", 40.0), ("~12", 12.0), ("30-40%", None), ("at least 5%", None), ("0", None), ("101", None), ("majority", None), ("", None), ("100", 100.0)])
def test_percentages(spark, raw, want):
    assert one(spark, text.percentage(F.lit(raw))) == want


@pytest.mark.parametrize(("label", "canonical", "stage"), [
    ("Series A", "SERIES_A", "EARLY_STAGE"), ("Series C-2 Extension", "SERIES_C2", "GROWTH"), ("series h round", "SERIES_H", "LATE_STAGE"), ("Pre-Seed", "PRE_SEED", "PRE_SEED"),
    ("Seed Funding", "SEED", "SEED"), ("angel", "ANGEL", "SEED"), ("Series AA", None, None), ("Series B0", None, None), ("bridge", None, None),
])
def test_rounds(spark, label, canonical, stage):
    assert (one(spark, text.funding_round(F.lit(label))), one(spark, text.round_stage(text.funding_round(F.lit(label))))) == (canonical, stage)


@pytest.mark.parametrize(("names", "want", "status"), [
    ("Acme Capital, Beta Partners", ["Acme Capital", "Beta Partners"], "UNREVIEWED"), ("Acme, Inc.", ["Acme, Inc."], "UNREVIEWED"), ("Acme; Beta", ["Acme; Beta"], "NEEDS_REVIEW"), ("KKR and TPG", ["KKR", "TPG"], "UNREVIEWED"), ("", [], "UNREVIEWED"),
    ("Fund A together with Fund B", ["Fund A together with Fund B"], "NEEDS_REVIEW"), (' "Acme One" ', ["Acme One"], "UNREVIEWED"), ("One Co, Inc, Two Co", ["One Co, Inc, Two Co"], "NEEDS_REVIEW"),
])
def test_name_lists(spark, names, want, status):
    got = one(spark, text.name_list(F.lit(names)))
    assert (got["names"], got["status"]) == (want, status) and (got["reason"] is None) == (status == "UNREVIEWED")


@pytest.mark.parametrize(("body", "html", "want"), [
    (None, None, "empty"), ("  ", None, "empty"), ("x" * 99, None, "too_short:99"), ("x" * 100, None, None), ("Access  Denied " + "y" * 200, None, "block_page:short_body_marker:access denied"),
    ("z" * 2000 + " access denied", None, None), ("fine " * 100, "<title>Attention Required! | x</title>", "block_page:title:attention required!"),
])
def test_body_rejection(spark, body, html, want):
    assert one(spark, text.body_rejection(F.lit(body).cast("string"), F.lit(html).cast("string"))) == want


@pytest.mark.parametrize(("forms", "want"), [(["CASH"], "CASH"), (["CASH", "EARNOUT"], "CASH"), (["ACQUIRER_STOCK", "DEBT_ASSUMED"], "STOCK"), (["CASH", "TARGET_STOCK"], "CASH_AND_STOCK"), (["CASH", "OTHER"], "OTHER"), (["CVR"], None), ([], None)])
def test_consideration(spark, forms, want):
    assert one(spark, derive.consideration_type(F.array(*map(F.lit, forms)).cast("array<string>"))) == want


@pytest.mark.parametrize(("period", "end", "announced", "ccy", "want"), [
    ("LTM", None, None, "USD", (10.0, None, "CALCULATED")), ("NTM", None, None, "USD", (None, 10.0, "CALCULATED")), ("ANNUAL", "2023", "2024-06-30", "USD", (10.0, None, "CALCULATED")),
    ("ANNUAL", "2022", "2024-06-30", "USD", (None, None, "NOT_CALCULABLE")), ("TTM", None, None, "EUR", (None, None, "NM")), ("QUARTERLY", None, None, "USD", (None, None, "NOT_CALCULABLE")),
])
def test_multiples(spark, period, end, announced, ccy, want):
    s = lambda v: F.lit(v).cast("string")
    none = (F.lit(None).cast("double"), s(None), s(None))
    m = one(spark, derive.multiples(s("ACQUISITION"), F.lit(100.0), s("USD"), s(ccy), s(announced), revenue=(F.lit(10.0), s(period), s(end)), ebitda=none))
    assert (m["ev_to_revenue_ltm"], m["ev_to_revenue_ntm"], m["multiple_quality"]) == want


def test_similarity_is_a_token_set_ratio():
    assert cluster.token_set_ratio("acme corp", "corp acme") == 100.0
    assert cluster.token_set_ratio("acme", "acme robotics") == 100.0
    assert cluster.token_set_ratio("", "acme") == 0.0
    assert abs(cluster.token_set_ratio("kitten", "sitting") - 100 * 2 * 4 / 13) < 1e-9


_word = st.text("abc", min_size=1, max_size=5)


@settings(max_examples=400, deadline=None)
@given(st.lists(_word, min_size=1, max_size=4), st.lists(_word, min_size=1, max_size=4))
def test_names_that_score_share_a_block(a, b):
    a, b = " ".join(a), " ".join(b)
    if cluster.token_set_ratio(a, b) >= 90:
        grams = lambda s: {s[i : i + 3] for i in range(max(1, len(s) - 2))}
        line = lambda s: " ".join(sorted(s.split()))
        assert set(a.split()) & set(b.split()) or grams(line(a)) & grams(line(b))


def test_clusters(spark):
    spark.sparkContext.setCheckpointDir("/tmp/factmill-tests")
    names = ["acme robotics", "robotics acme", "acme robotic", "zenith labs", "zenith lab", "other"]
    pairs = {tuple(r) for r in cluster.similar_names(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert pairs == {(a, b) for a, b in itertools.combinations(sorted(names), 2) if cluster.token_set_ratio(a, b) >= 90}
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r["label"] for r in cluster.components(edges).collect()} == {0, 100}


def test_same_deals_against_all_pairs(spark):
    rng = random.Random(3)
    pick = lambda *xs: rng.choice(xs)
    deals = [
        (i, rng.random() < 0.5, pick("acme robotics", "robotics acme", "acme robotic", "zenith labs", "zenith lab", "", None), pick("big buyer", "big buyers", "other fund", None),
         pick("2024-01-01", "2024-01-03", "2024-01-20", "2024-03-09", "soon", "", None), pick("exact", "month", None),
         pick("Series A", "series a-1", "Series B", "Pre-Seed", "seed", None, "growth"), pick(None, 0.0, 100.0, 110.0, 150.0))
        for i in range(150)
    ]

    def stage(label):
        low = (label or "").lower()
        return "series_" + low[7] if low.startswith("series") else "pre_seed" if "pre-seed" in low else "seed" if "seed" in low else None

    def days(x, y):
        try:
            return abs((datetime.date.fromisoformat(x) - datetime.date.fromisoformat(y)).days)
        except ValueError:
            return None

    want = set()
    for x, y in itertools.combinations(deals, 2):
        if x[1] != y[1] or cluster.token_set_ratio(x[2], y[2]) < 90:
            continue
        apart = days(x[4], y[4]) if x[4] and y[4] else None
        if x[1]:
            late = x[5] == y[5] == "exact" and apart is not None and apart > 30
            other = stage(x[6]) and stage(y[6]) and stage(x[6]) != stage(y[6])
            uneven = x[7] and y[7] and abs(x[7] - y[7]) / max(x[7], y[7]) > 0.15
            same = not (late or other or uneven)
        else:
            same = cluster.token_set_ratio(x[3], y[3]) >= 90 and (not (x[4] and y[4]) or apart is not None and apart <= 3)
        if same:
            want.add((x[0], y[0]))
    frame = spark.createDataFrame(deals, "id long, is_funding boolean, target string, acquirer string, day string, precision string, round_label string, round_size double")
    got = [tuple(r) for r in cluster.same_deals(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_profile_tells_whole_values(spark):
    rows = [(f"{'x' * 50}{i} ",) for i in range(9)] + [("2024-01-02 and on",), (" ",), (None,)]
    got = relational.full_profile(spark.createDataFrame(rows, "v string"), ["v"]).first().asDict()
    assert (got["filled"], got["n_distinct"], got["distinct_ratio"], got["least"], got["p50"], got["most"], got["date_pct"]) == (10, 10, 0.8333, 17, 51, 51, 10.0)


def test_body_rejection_judges_the_end_of_the_text(spark):
    full = "word " * 400
    bodies = {"": "empty", "too short": "too_short:9", full: None, "Access denied " + full: None, "Attention required! " + full: "block_page:body:attention required!"}
    frame = spark.createDataFrame([(k,) for k in bodies], "t string")
    got = {r["t"]: r["reason"] for r in frame.select("t", text.body_rejection(F.col("t"), F.lit(None).cast("string")).alias("reason")).collect()}
    assert got == bodies


def test_upsert_twice_is_the_same_but_for_the_version(spark):
    old = spark.createDataFrame([(1, "a", "n", 1), (2, "b", "m", 1)], "id long, state string, note string, version int")
    new = spark.createDataFrame([(1, None), (3, "c")], "id long, state string")
    once = relational.upserted(old, new, "id", ["state"], "version")
    assert sorted(map(tuple, once.collect())) == [(1, None, "n", 2), (2, "b", "m", 1), (3, "c", None, 1)]


def test_participants(spark):
    rows = spark.createDataFrame([("t", "Acme & Co", 1), ("t", "ACME and co", 2), ("t", "--", 3)], "txn string, name string, seq long")
    assert [(r["name"], r["n_rows"]) for r in participants.entities(rows).collect()] == [("Acme & Co", 2)]


AGREEMENT = "RECITALS\nWHEREAS the parties agree to this dated as of March 3, 2024 deal.\nARTICLE II\nThe Merger Consideration shall be paid in cash in full.\nTERMINATION FEE\nThe company shall pay a sum of money.\n"


def test_scanners(spark):
    df = spark.createDataFrame([(1, AGREEMENT), (2, None), (3, "")], "id long, body string")
    got = scanners.sections(df, "id", "body").collect()
    assert [(r["section_type"], r["confidence"]) for r in got] == [("RECITALS", "HIGH"), ("CONSIDERATION", "MEDIUM"), ("TERMINATION_FEES", "HIGH")]
    assert all(AGREEMENT[r["start"] : r["end"]] == r["excerpt"] and r["excerpt"].startswith(r["heading"]) for r in got)
    assert one(spark, scanners.dated_as_of(F.lit(AGREEMENT))) == datetime.date(2024, 3, 3)
    told = lambda body: one(spark, signals.structure(F.lit("News"), F.lit(body)))
    assert told("It closed a $75 million PIPE. End.") == ("ACRONYM", "News\nIt closed a $75 million PIPE.") and told("PIPE welding financing news") is None
    assert told("A private investment in public equity.")["form"] == "EXPANDED" and told("One PIPE here, a PIPE deal there.")["form"] == "ACRONYM" and told("PIPELINE financing") is None
    assert one(spark, scanners.document_title(F.lit("UNITED STATES\nAGREEMENT AND PLAN OF MERGER\nx"))) == "AGREEMENT AND PLAN OF MERGER"
    assert one(spark, scanners.item_codes(F.lit("Item 1.01: Entry, Item 9.01: x, Item 1.01"))) == ["1.01", "9.01"]
    assert one(spark, scanners.exhibit_kind(F.lit("EX-2.1"))) == "MERGER_AGREEMENT" and one(spark, scanners.exhibit_kind(F.lit("EX-21.1"))) is None
    assert one(spark, scanners.authority_tier(F.lit(None).cast("string"), F.lit("original_reporting"))) == "T3"
    cut = df.select(scanners.excerpts(F.lit("We expand. " + "x" * 400 + " strategic fit")).alias("e")).first()["e"]
    assert len(cut) == 2
    shares = spark.createDataFrame([(1, "COMMON_STOCK", None, None, 5, "2023"), (1, "COMMON_STOCK", None, None, 7, "2024"), (1, "RSU", None, None, 2, None)], "t long, security_type string, security_class string, as_reported string, shares long, as_of string")
    assert tuple(scanners.diluted_shares(shares, "t").first()) == (1, 9, "COMPLETE")


def test_sources(spark, tmp_path):
    (tmp_path / "u.csv").write_text("﻿URL,Title,Headline\nhttp://a,t1,\n,t2,h2\nhttp://b,t3,h3\n")
    got = {r["url"]: r["title"] for r in files.url_list(spark, str(tmp_path / "u.csv")).collect()}
    assert got == {"http://a": "t1", "http://b": "h3"}
    (tmp_path / "e.tsv").write_text("id\tcategory\tcompany1_name\tcompany2_name\tsource_url\tsource_title\tsource_body_lite\tsource_published_at\n1\tinvests_into\tFund\tCo\thttp://x\tT\t" + "b" * 120 + "\t2024-01-02T00:00\n2\tx\ta\tb\thttp://y\tT\tshort\t2024\n")
    assert [(r["recipient"], r["investor"]) for r in files.event_feed(spark, str(tmp_path / "e.tsv")).collect()] == [("Co", "Fund")]
    (tmp_path / "j.jsonl").write_text('{"a": 1}\n\nnot json\n')
    good, bad = files.json_lines(spark, str(tmp_path / "j.jsonl"), "a int")
    assert ([r["a"] for r in good.collect()], bad.count()) == ([1], 1)
    for name, meta, body in (("one", '{"url": "http://a", "ok": true}', "x" * 200), ("two", "{", "y")):
        (tmp_path / "caps" / name).mkdir(parents=True)
        (tmp_path / "caps" / name / "meta.json").write_text(meta)
        (tmp_path / "caps" / name / "page.txt").write_text(body)
    caps = {r["capture"]: r["quarantined"] for r in files.captures(spark, str(tmp_path / "caps")).collect()}
    assert caps["one"] is None and "short_body" in caps["two"]
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row><c r="A1" t="inlineStr"><is><t>Name</t></is></c><c r="B1" t="inlineStr"><is><t>URL</t></is></c></row><row><c r="B2" t="inlineStr"><is><t>http://q</t></is></c></row></sheetData></worksheet>')
    assert [r["url"] for r in files.workbooks(spark, str(tmp_path / "b.xlsx")).collect()] == ["http://q"]
    page = spark.createDataFrame([('<a class="c" href="/n/1.html"><h3><small>Mar 03, 2024</small> Big <b>deal</b></h3></a>',)], "html string")
    assert tuple(files.listing(page).first()) == ("Big deal", "/n/1.html", datetime.date(2024, 3, 3))
    new = spark.createDataFrame([("u1", 1, "Same body"), ("u2", 2, "same  BODY"), ("u1", 3, "z"), ("k", 4, "q")], "url string, seq long, body string")
    known = spark.createDataFrame([("k", "h")], "url string, content_hash string")
    assert {r["url"]: r["reason"] for r in files.ingested(new, known).collect()} == {"u1": None, "u2": "duplicate_body"}
    sinks.review_csv(spark.range(2), ["id", "gone"], str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == ["id", "gone"]
    assert sinks.scorecard(spark.range(1), "S").count("|") == 6


def test_fetching_is_polite():
    answers = iter([(500, ""), (200, "ok"), (429, ""), (429, ""), (429, ""), (429, "")])
    client = fetch.Politeness(lambda url: next(answers), wait=lambda s: None, limit=3, robots={"h": "User-agent: *\nDisallow: /no\nAllow: /no/yes"})
    assert client.get("http://h/a") == (200, "ok") and client.get("http://h/no/x") == (403, "")
    assert fetch.allowed(client.robots["h"], "/no/yes")
    with pytest.raises(fetch.Stopped):
        for _ in range(4):
            client.get("http://h/b")


def test_stream_keeps_first_of_each_content(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"at": "2024-01-01T00:00:00Z", "body": "Hello  world"}\n{"at": "2024-01-01T00:01:00Z", "body": "hello world"}\n{"at": "2024-01-01T00:02:00Z", "body": "other"}\n')
    stream = ingest.first_seen(ingest.raw_stream(spark, str(tmp_path / "in"), "at timestamp, body string"), "at", "body")
    ingest.written(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_vocabulary_edges(spark):
    s = lambda v: F.lit(v).cast("string")
    assert one(spark, vocab.lenient_json(s('said ```json\n{"a": 1}\n``` ok'))) == '{"a": 1}'
    assert one(spark, vocab.lenient_json(s("no braces"))) is None and one(spark, vocab.lenient_json(s("{broken"))) is None
    for gold, made, kind, want in [("100", "100.9", "numeric", True), ("100", "102", "numeric", False), ("0", "0.0", "numeric", True), ("None", "", "enum", True), ("a", None, "enum", False), ("usd", "USD", "enum", True)]:
        assert one(spark, vocab.equal(s(gold), s(made), kind)) is want
    assert one(spark, vocab.shown_multiple(F.lit(2.5), s("CALCULATED"))) == "2.50"


def test_articles(spark):
    contents = "ARTICLE I\nDEFINITIONS\nARTICLE II\nMERGER CONSIDERATION\nARTICLE III\nTERMINATION\n"
    body = "This agreement dated as of March 3, 2024.\nWHEREAS one; NOW, THEREFORE two.\n" + contents.replace("\nARTICLE", "\nwords of the article\nARTICLE") + "end"
    whole = contents + body
    df = spark.createDataFrame([(1, whole), (2, AGREEMENT)], "id long, body string")
    got = [r for r in scanners.sections(df, "id", "body", by_article=True).collect()]
    one_, two = [r for r in got if r["id"] == 1], [r for r in got if r["id"] == 2]
    assert [r["section_type"] for r in one_] == ["RECITALS", "CONSIDERATION", "TERMINATION_FEES"]
    assert one_[0]["excerpt"].startswith("This agreement") and all(r["start"] >= len(contents) and whole[r["start"] : r["end"]] == r["excerpt"] for r in one_)
    assert [r["section_type"] for r in two] == ["RECITALS", "CONSIDERATION", "TERMINATION_FEES"]  # without articles the headings decide


def test_packets_hold_subsections_and_definitions(spark):
    text_ = (
        "ARTICLE I\nDEFINITIONS\n\u201cMerger Consideration\u201d means cash.\n\u201cPurchase Price\u201d has the meaning below.\nARTICLE II\nTHE MERGERS; CLOSING\nSection 2.01 Closing. Later.\nSection 2.02 Merger Consideration. As said.\n"
        "Section 2.03.Consideration\nMore.\nARTICLE III\nREPRESENTATIONS AND WARRANTIES OF THE COMPANY\n3.1 Organization. Fine.\nSection 3.2 Capitalization.\n(a) Ten shares.\n(b) None else.\nSection 3.3 Other.\nARTICLE IV\nREPRESENTATIONS AND WARRANTIES OF THE PARENT\n4.1 Capitalization. Not ours.\n"
        "ARTICLE V\nTERMINATION\n5.1 Termination. Grounds.\n5.2 Effect of Termination. None.\n1\n"
    )
    rows = {r["section_type"]: r for r in scanners.sections(spark.createDataFrame([(1, text_)], "id long, body string"), "id", "body", by_article=True).collect()}
    assert rows["CONSIDERATION"]["excerpt"] == "[Merger Consideration]\nSection 2.02 Merger Consideration. As said.\n\n[Consideration]\nSection 2.03.Consideration\nMore.\n\n[Definition: \"Merger Consideration\"]\n\u201cMerger Consideration\u201d means cash."
    assert rows["CAPITALIZATION"]["excerpt"] == "Section 3.2 Capitalization.\n(a) Ten shares.\n" and rows["TERMINATION_FEES"]["heading"] == "Effect of Termination"


def test_signals(spark):
    wall = lambda html, status=200: one(spark, signals.wall(F.lit(html).cast("string"), F.lit(status)))
    assert wall("<article>" + "x" * 10) is None and wall("short") == "no article structure and only 5 bytes" and wall("x" * 3000) is None
    assert wall("", 200) == "empty body" and wall("fine", 429) == "status 429" and wall("Please solve the CAPTCHA") == "marker: captcha"
    amount = lambda body: one(spark, signals.round_amount(F.lit("T"), F.lit(body)))["classification"]
    assert amount("It raised $250 million at a $3.2 billion post-money valuation.") == "ROUND_SIZE_CANDIDATE"
    assert amount("Valued at a $3.2 billion post-money valuation.") == "NOT_ROUND_VALUATION" and amount("It raised $3 million to $5 million in funding.") == "NON_EXACT_AMOUNT"
    assert amount("It acquired the 5% stake held by X for $3 million.") == "NOT_ROUND_SECONDARY" and amount("Nothing.") == "NO_AMOUNT_DISCLOSED"


def test_filings_and_documents(spark, tmp_path):
    d = lambda s: datetime.date.fromisoformat(s)
    deals = spark.createDataFrame([(1, "NYSE: AAA", "Alpha", d("2024-03-10")), (2, None, "Beta", d("2024-03-10"))], "deal long, ticker string, company string, day date")
    filed = spark.createDataFrame([(1, "aaa", "x", "8-K", d("2024-02-09")), (2, "AAA", "x", "8-K", d("2024-03-17")), (3, "AAA", "x", "8-K", d("2024-03-18")), (4, None, "Beta", "S-4", d("2024-06-01")), (5, "ZZZ", "Alpha", "8-K", d("2024-03-10")), (6, None, "Beta", "8-K", d("2024-02-08"))], "filing long, ticker string, company string, form string, filed date")
    assert sorted((r["deal"], r["filing"]) for r in files.filings_near(deals, filed).collect()) == [(1, 1), (1, 2)]
    assert [(r["deal"], r["filing"]) for r in files.filings_near(deals, filed, ["S-4"]).collect()] == [(2, 4)]
    (tmp_path / "a.html").write_text("<html><script>no</script><p>" + "word " * 40 + "</p></html>")
    (tmp_path / "b.pdf").write_bytes(b"%PDF")
    (tmp_path / "c.txt").write_text("short")
    got = {r["kind"]: (r["status"], (r["body"] or "")[:4]) for r in files.filed_documents(spark, str(tmp_path)).collect()}
    assert got == {"html": ("FETCHED", "word"), "pdf": ("UNREADABLE", ""), "txt": ("SKIP", "")}
    read = {r["kind"]: r["status"] for r in files.filed_documents(spark, str(tmp_path), extractors={"pdf": lambda raw: "page " * 50}).collect()}
    assert read["pdf"] == "FETCHED"


def test_workbooks_go_round(spark, tmp_path):
    path = str(tmp_path / "out.xlsx")
    sinks.workbook(spark.createDataFrame([("http://a?x=1&y=<2>", 1.5), ("http://b", None)], "url string, n double"), ["n", "url", "gone"], path)
    assert [r["url"] for r in files.workbooks(spark, path).collect()] == ["http://a?x=1&y=<2>", "http://b"]
    sinks.export_csv(spark.createDataFrame([("t", 2.0, "NM")], "transaction_id string, ev_to_revenue_ltm double, multiple_quality string"), str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == sinks.EXPORT and back.first()["ev_to_revenue_ltm"] == "NM"
    assert sinks.run_log(spark.range(1), str(tmp_path / "log")) and not sinks.run_log(spark.range(1), "nosuchscheme://x/y")
    assert sinks.scorecard(spark.range(600), "S").count("\n") == 604


def test_robots_delay():
    rules = "User-agent: other\nCrawl-delay: 9\n\nUser-agent: *\nCrawl-delay: 2.5\nDisallow: /no\n"
    waits = []
    client = fetch.Politeness(lambda url: (200, "ok"), wait=waits.append, robots={"h": rules}, between=1.0)
    assert fetch.crawl_delay(rules) == 2.5 and fetch.crawl_delay("") is None
    client.get("http://h/a"), client.get("http://h/b"), client.get("http://i/a"), client.get("http://i/b")
    assert waits == [2.5, 1.0]


def test_strata_leave_rows_for_later_ones(spark):
    rows = [(i, "a" if i % 3 else "b") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, kind string")
    import hashlib
    strata = [("a", F.col("kind") == "a", 7), ("all", F.lit(True), 9), ("b", F.col("kind") == "b", 300)]
    left, want = sorted(rows, key=lambda r: hashlib.sha256(str(r[0]).encode()).hexdigest()), {}
    for name, _, cap in strata:
        fit = [r for r in left if name == "all" or r[1] == name][:cap]
        want |= {r[0]: name for r in fit}
        left = [r for r in left if r not in fit]
    assert {r["id"]: r["stratum"] for r in relational.stratified(df, strata, "id").collect()} == want


def test_lists_and_ranks_without_gathering(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(4), rng.choice([None, 1.0, 2.5, 7.0, 9.0]), rng.choice("abc"), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, v double, w string, seq long")
    got = {r["k"]: (r["p10"], r["p50"], r["p90"]) for r in relational.nearest_ranks(df, "k", "v", {"p10": 0.1, "p50": 0.5, "p90": 0.9}).collect()}
    for k in range(4):
        own = sorted(r[1] for r in rows if r[0] == k and r[1] is not None)
        assert got[k] == tuple(own[round(p * (len(own) - 1))] for p in (0.1, 0.5, 0.9))
    lists = {r["k"]: r["s"] for r in relational.first_seen_list(df, ["k"], F.col("w"), F.col("seq"), "s").collect()}
    assert lists == {k: "|".join(dict.fromkeys(r[2] for r in rows if r[0] == k)) for k in range(4)}


def test_clusters_of_deals_by_classes_are_those_of_all_pairs(spark):
    rng = random.Random(8)
    pick = lambda *xs: rng.choice(xs)
    deals = [
        (i, pick("VC_ROUND", "MERGER"), f"{pick('acme robotics', 'robotics acme', 'acme robotic', 'zenith labs', 'zenith lab')} {rng.randrange(6)}", pick("big buyer", "big buyers", "other fund", "LLC"),
         pick("2024-01-01", "2024-01-03", "2024-01-06", "2024-02-02", "2024-02-20", "2024-03-09", "soon", "", None), pick("exact", "exact", "month"),
         pick("Series A", "Series B", "seed", "seed", None), pick(None, 0.0, float("nan"), -5.0, -50.0, *[100.0 * 1.08**k for k in range(25)], 85.0, 100.0), None)
        for i in range(500)
    ]
    frame = spark.createDataFrame(deals, "extraction long, event string, target string, acquirer string, day string, precision string, round_label string, round_size double, cluster string")
    rows = frame.select(F.col("extraction").alias("id"), (F.col("event") == "VC_ROUND").alias("is_funding"), text.company_name(F.col("target")).alias("target"), text.company_name(F.col("acquirer")).alias("acquirer"), "day", "precision", "round_label", "round_size")
    least = list(range(500))

    def top(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in sorted(tuple(r) for r in cluster.same_deals(rows).collect()):
        a, b = top(a), top(b)
        least[max(a, b)] = min(a, b)
    want = [top(i) for i in range(500)]
    got = {r["extraction"]: (r["cluster_id"], r["n_members"]) for r in cluster.clustered(frame).collect()}
    assert all(got[i][1] == want.count(want[i]) for i in range(500)) and len(set(want)) > 40
    assert all(got[i] == got[want[i]] for i in range(500))


def test_copies_of_deals_make_no_more_links(spark):
    one = spark.createDataFrame([(k * 5 + s, f"target {k}", s, 100.0 * 1.3**s) for k in range(4) for s in range(5)], "n long, target string, s long, round_size double")
    rows = lambda n: one.crossJoin(spark.range(n)).select(
        (F.col("id") * 20 + F.col("n")).alias("id"), (F.col("s") % 2 == 0).alias("is_funding"), "target", F.lit("buyer").alias("acquirer"), F.lit("2024-01-01").alias("day"), F.lit("exact").alias("precision"), F.lit(None).cast("string").alias("round_label"), "round_size",
    )
    links = [cluster.deal_classes(rows(n))[1].count() for n in (1, 50)]
    assert links[0] == links[1]
