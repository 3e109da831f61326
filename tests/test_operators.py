"""Operators on small frames: the contracts and their edge cases."""

import json
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparksift.config import Config
from sparksift.functions.storage import fresh_path, in_folders, put_files
from sparksift.functions.text import excerpt_of, host_of, text_of, title_of
from sparksift.operators import cascade, export, lexicon, ml, state
from sparksift.plans import catalogue
from sparksift.sources import bundles, seeds, sheets

from .conftest import SF_DIR


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "url, host",
    [
        ("example.com", "example.com"), ("HTTP://A.COM:80/x", "a.com"), ("https://user:pw@b.org/p?q#f", "b.org"), ("www.c.net.", "c.net"), ("http://m.d.com", "d.com"),
        ("bücher.example/x", "bücher.example"), ("a_b.example.com", "a_b.example.com"), ("http://10.0.0.1:8080/", "10.0.0.1"), ("localhost", None), ("", None), ("  ", None), (None, None), ("http://x.com?a=@b", "x.com"),
    ],
)
def test_host(spark, url, host):
    assert one(spark, host_of, url) == host
    if host:
        assert one(spark, host_of, host) == host


def test_excerpt_and_title(spark):
    html = "<html><head><title> A\n B </title><script>var x = '</p>';</script></head><body><p>one</p>\n<p>two</p></body></html>"
    assert one(spark, title_of, html) == "A B"
    assert one(spark, text_of, html) == "A B one two"
    assert one(spark, lambda x: excerpt_of(x, 3), html) == "A B"
    assert one(spark, title_of, "<p>none</p>") == "" and one(spark, text_of, "") == ""


def test_lexicon_counts_whole_words(spark):
    texts = spark.createDataFrame([(1, "a better bet"), (2, "Satta-Matka and free bets"), (3, ""), (4, None)], "id int, t string")
    got = {r["id"]: (r["hits"], r["weight"]) for r in lexicon.lexicon_scores(texts, lexicon.terms(spark), "id", "t").collect()}
    assert got == {1: (1, 1.0), 2: (3, 8.0), 3: (0, 0.0), 4: (0, 0.0)}
    none = lexicon.lexicon_scores(texts, lexicon.terms(spark).limit(0), "id", "t")
    assert {r["hits"] for r in none.collect()} == {0}


def test_guard(spark):
    for text, want in (("school news", True), ("school casino", False), ("plain", False)):
        assert one(spark, lexicon.guarded, text) is want


@pytest.mark.parametrize("p, want", [(0.95, "flag"), (0.05, "clear"), (0.5, None), (None, None)])
def test_gate(spark, p, want):
    assert one(spark, lambda x: cascade.gate(x, Config()), p, "double") == want


GOOD = '{"verdict": "flag", "confidence": 0.7}'


@pytest.mark.parametrize(
    "raw, valid, repaired, verdict",
    [(GOOD, True, False, "flag"), (f"```json\n{GOOD}\n```", True, True, "flag"), (f"Well: {GOOD} ok", True, True, "flag"), (GOOD[:20], False, False, None), ('{"verdict": "maybe", "confidence": 0.7}', False, False, None), ('{"verdict": "flag", "confidence": 7}', False, False, None), (f"{GOOD} {GOOD}", True, False, "flag"), ("", False, False, None), (None, False, False, None)],
)
def test_reply(spark, raw, valid, repaired, verdict):
    df = spark.createDataFrame([(raw,)], "raw string")
    r = df.select(*[c.alias(n) for n, c in cascade.reply_fields(F.col("raw")).items()]).first()
    assert (r["valid"], r["repaired"], r["verdict"]) == (valid, repaired, verdict)


@pytest.mark.parametrize("p, v, t, want", [("flag", "flag", None, ("flag", "agreed")), ("flag", "clear", "clear", ("clear", "tiebreaker")), ("flag", "clear", None, ("unsure", "none")), (None, None, None, ("unsure", "none")), (None, "flag", "unsure", ("unsure", "tiebreaker"))])
def test_consensus(spark, p, v, t, want):
    r = spark.createDataFrame([(p, v, t)], "p string, v string, t string").select(*cascade.consensus(F.col("p"), F.col("v"), F.col("t")).values()).first()
    assert tuple(r) == want


def test_tiebreaker_runs_on_disagreement_only(spark):
    def client(host, excerpt, role):
        return json.dumps({"verdict": "flag" if role == "primary" or role == "tiebreaker" or host == "a.com" else "clear", "confidence": 0.8})

    pages = spark.createDataFrame([("a.com", "x"), ("b.com", "y")], "host string, excerpt string")
    got = {r["host"]: (r["verdict"], r["decided_by"]) for r in cascade.classify(pages, Config(), client).collect()}
    assert got == {"a.com": ("flag", "agreed"), "b.com": ("flag", "tiebreaker")}



def test_invalid_replies_are_asked_for_again(spark, tmp_path):
    def client(host, excerpt, role):
        calls = tmp_path / f"{host}-{role}"
        n = len(calls.read_text()) if calls.exists() else 0
        calls.write_text("x" * (n + 1))
        return json.dumps({"verdict": "flag", "confidence": 0.8}) if n >= int(excerpt) else "no"

    pages = spark.createDataFrame([("a.com", "0"), ("b.com", "2"), ("c.com", "9")], "host string, excerpt string")
    got = {r["host"]: (r["raw"], r["tokens"]) for r in cascade.call_model(pages, "primary", client, Config()).collect()}
    assert {h: len((tmp_path / f"{h}-primary").read_text()) for h in got} == {"a.com": 1, "b.com": 3, "c.com": 3}
    assert "flag" in got["b.com"][0] and got["c.com"] == ("no", 6)


def test_state(spark):
    log = spark.createDataFrame([("a", 1, 1, "reported"), ("a", 2, 2, "blocked"), ("a", 2, 3, "reopened"), ("b", 1, 4, "blocked"), ("b", 2, 5, "blocked")], "host string, at int, id int, status string")
    assert {r["host"]: r["status"] for r in state.latest(log, "host", "at", "id").collect()} == {"a": "reopened", "b": "blocked"}
    assert [(r["host"], r["before"], r["status"]) for r in state.changes(log, "host", "at", "id", "status").orderBy("id").collect()] == [("a", "reported", "blocked"), ("a", "blocked", "reopened")]
    assert [r["host"] for r in state.blocked(log, "host", "at", "id", "status", ("blocked",)).collect()] == ["b"]
    seen = spark.createDataFrame([("a", 3, "y"), ("a", 1, "x"), (None, 1, "x"), ("c", 2, "x")], "host string, seen_at int, engine string")
    assert {r["host"]: (r["first_seen"], r["engines"], r["n"]) for r in state.deduped(seen).collect()} == {"a": (1, ["x", "y"], 2), "c": (2, ["x"], 1)}
    assert {r["host"] for r in state.new_hosts(seen, log).collect()} == {"c"}
    assert state.new_hosts(seen, log.limit(0)).count() == 3
    again = state.upserted(log, log.limit(2), "host", "at", "id")
    assert {r["host"]: r["status"] for r in again.collect()} == {"a": "reopened", "b": "blocked"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 7), st.integers(1, 60))
def test_parts_hold_their_caps(sizes, links, cap):
    parts = export.parts_of(sizes, links, cap)
    assert parts == sorted(parts) and len(parts) == len(sizes)
    for p in set(parts):
        held = [s for s, q in zip(sizes, parts) if q == p]
        assert len(held) <= links and (sum(held) <= cap or len(held) == 1)


def test_split_dual(spark):
    sizes = [900, 50, 60, 40, 1000, 10, 10, 10, 10]
    items = spark.createDataFrame([(b, k, s) for b in ("x", "y") for k, s in enumerate(sizes)], "b string, k int, s int")
    got = export.split_dual(items, "b", "k", "s", Config(max_links=3, max_bytes=100)).orderBy("bundle", "item").collect()
    want = export.parts_of(sizes, 3, 100)
    assert [r["part_no"] for r in got] == want * 2
    assert export.split_dual(items.limit(0), "b", "k", "s", Config()).count() == 0


@pytest.mark.parametrize("n, parts", [(1000, 1), (1001, 2)])
def test_split_links(spark, n, parts):
    assert export.split_links(spark.range(n).withColumn("b", F.lit(1)), "b", ["id"], Config()).select("part_no").distinct().count() == parts


def test_evidence(spark):
    confirmed = spark.createDataFrame([("a",), ("b",)], "host string")
    refs = spark.createDataFrame([("a", "2.png"), ("a", "1.png")], "host string, ref string")
    assert {r["host"]: r["evidence"] for r in export.with_evidence(confirmed, refs, "host", "ref").collect()} == {"a": ["1.png", "2.png"], "b": []}


def test_training_needs_two_classes(spark):
    with pytest.raises(ValueError, match="two classes"):
        ml.train(spark.createDataFrame([("a.com", 1)], "text string, label int"))


def test_csv_seeds(spark, tmp_path):
    (tmp_path / "s.csv").write_text('domain,note\nexample.com,one\nWWW.B.org/x,two\n,none\nc.com,a,b,c\nexample.com,again\n')
    df = seeds.csv_seeds(spark, f"file://{tmp_path}/s.csv")
    assert df.count() == 5 and [r["domain"] for r in df.cache().filter("_corrupt_record IS NOT NULL").collect()] == ["c.com"]
    assert {r["host"] for r in seeds.seed_hosts(df).collect()} == {"example.com", "b.org", "c.com"}


def test_workbook_round_trip(spark, tmp_path):
    rows = [["a.com", "x & <y>"], ["b.org", None], ["ü.example", "two\nlines"]]
    data = sheets.workbook(["domain", "note"], rows)
    assert list(sheets.read_rows(data)) == [["domain", "note"], ["a.com", "x & <y>"], ["b.org"], ["ü.example", "two\nlines"]]
    (tmp_path / "s.xlsx").write_bytes(data)
    got = seeds.excel_seeds(spark, f"file://{tmp_path}/s.xlsx").collect()
    assert [(r["domain"], r["note"]) for r in got] == [tuple(r) for r in rows]
    assert [sheets.column_number(sheets.column_name(n)) for n in (0, 25, 26, 701, 702)] == [0, 25, 26, 701, 702]


def test_pdf():
    data = bundles.pdf("Part (1)", [(f"line {k}", f"https://x{k}.com/") for k in range(120)])
    assert data.count(b"/Type /Page ") == 3 and data.count(b"/URI (https://") == 120
    at = int(data.rsplit(b"startxref\n", 1)[1].split()[0])
    assert data[at:].startswith(b"xref")


def test_harvest(spark):
    hits = seeds.harvest(spark, ["free bets", "casino"], 3)
    assert hits.count() == 4 * 2 * 3 and hits.select("engine").distinct().count() == 4


def test_keywords(spark, tmp_path):
    (tmp_path / "k.txt").write_text("casino\n# no\n\n free bets \ncasino\n")
    assert {r["term"] for r in seeds.keyword_list(spark, f"file://{tmp_path}/k.txt").collect()} == {"casino", "free bets"}


def test_link_targets():
    assert bundles.link_target("https://例え.jp/ü/日本?q=ä b") == "https://xn--r8jz45g.jp/%C3%BC/%E6%97%A5%E6%9C%AC?q=%C3%A4%20b"
    assert bundles.link_target("http://a.com/x%20y?b=(1)#c") == "http://a.com/x%20y?b=%281%29#c" and bundles.link_target("evidence/1.png") == "evidence/1.png"
    long = "https://a.com/" + "x" * 300
    data = bundles.pdf("t", [(f"a.com  {long}", long), ("evidence", "https://例え.jp/")])
    assert bundles.pdf_links(data) == [long, "https://xn--r8jz45g.jp/"] and data.count(b"Tj") == 1 + 3 + 1


def test_workbook_links():
    data = sheets.workbook(["host", "url"], [["a", "https://a.com/?x=1&y=2"], ["b", "https://b.org/"]], {1: "https://a.com/?x=1&y=2", 2: "https://b.org/"})
    assert sheets.read_links(data) == ["https://a.com/?x=1&y=2", "https://b.org/"] and sheets.read_links(sheets.workbook(["a"], [])) == []


def test_ranges_number_one_heavy_bundle(spark):
    items = spark.range(2500).select(F.when(F.col("id") % 5 > 0, "big").alias("b"), (F.col("id") * 7919 % 2500).alias("k"), F.lit(3).alias("s"))
    got = export.split_links(items, "b", ["k"], Config(max_links=100)).groupBy("b", "part_no").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).collect()
    big = sorted((r["part_no"], r["n"], r["lo"], r["hi"]) for r in got if r["b"])
    assert [x[:2] for x in big] == [(k, 100) for k in range(20)] and all(x[3] < y[2] for x, y in zip(big, big[1:])) and sum(r["n"] for r in got) == 2500
    sums = sorted((r["k"], r["running"]) for r in export.running_bytes(items.filter("b IS NULL"), "b", "k", "s").collect())
    assert [r for _, r in sums] == [3 * (n + 1) for n in range(500)]


def test_long_lexicons_score_alike(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "Free-bets! casino, casino"), (2, "nothing"), (3, None), (4, "a free  bets win"), (5, "Hotel news, win")], "id int, t string")
    lists = lexicon.terms(spark)
    want = sorted(tuple(r) for r in lexicon.lexicon_scores(texts, lists, "id", "t").collect())
    assert want[0] == (1, False, 3, 6.0) and want[1:3] == [(2, False, 0, 0.0), (3, False, 0, 0.0)]
    assert want[4] == (5, True, 1, 0.5)
    monkeypatch.setattr(lexicon, "PLAN_TERMS", 3)
    assert sorted(tuple(r) for r in lexicon.lexicon_scores(texts, lists, "id", "t").collect()) == want


def test_gate_spares_models(spark):
    pages = spark.createDataFrame([("a.com", "bet", 0.99), ("b.com", "bet", 0.01), ("c.com", "casino bet", 0.5), ("d.com", "x", None)], "host string, excerpt string, p double")
    got = {r["host"]: (r["verdict"], r["decided_by"], r["tokens"] > 0) for r in cascade.classify(pages, Config(ai_concurrency=1)).collect()}
    assert got == {"a.com": ("flag", "gate", False), "b.com": ("clear", "gate", False), "c.com": ("flag", "agreed", True), "d.com": ("clear", "agreed", True)}


def test_files_of_parts_go_on_one_at_a_time(spark):
    """Files that are read back are never handed over by thousands, which no cap on rows bounds."""
    rows = spark.range(3000).selectExpr("concat('b', id % 3) AS bundle", "id div 3 div 10 AS part_no", "'h' AS host", "concat('https://h.example.com/', id) AS url")

    def sizes(frames):
        for f in frames:
            links = sum(len(bundles.pdf_links(bytes(x))) for x in f["pdf"])
            yield f[["bundle", "part_no"]].assign(files=len(f), links=links)

    got = bundles.rendered(rows, sizes, "bundle string, part_no long, files long, links long").collect()
    assert len(got) == 300 and {(r["files"], r["links"]) for r in got} == {(1, 10)}
    plan = catalogue.q_export_bundles(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1


def test_small_files_share_folders_and_tasks(spark):
    path = fresh_path(spark, "small")
    files = spark.range(900).selectExpr("concat(id, '.png') AS name", "cast(id AS string) AS text").withColumn("content", F.col("text").cast("binary"))
    put_files(in_folders(files), path)
    folders = {p.parent.name for p in Path(path.removeprefix("file:")).rglob("*.png")}
    assert 1 < len(folders) <= 512
    shots = seeds.screenshots(spark, path)
    assert shots.rdd.getNumPartitions() <= 8
    assert sorted((r["name"], r["bytes"]) for r in shots.collect()) == sorted((f"{k}.png", len(str(k))) for k in range(900))
    assert spark.conf.get("spark.sql.files.openCostInBytes") != seeds.OPEN_COST
