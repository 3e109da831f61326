"""Labels and the model, statuses in state, evidence in rows, what deduplication drops."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sparksift.config import Config
from sparksift.operators import calibration, cascade, export, ml, state
from sparksift.plans import catalogue
from sparksift.streaming import checks, timed

from .conftest import SF_DIR


def test_newest_label(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 0, 2), ("b", 1, None), ("b", 0, 0), ("c", 1, 5), ("c", 0, 5), (None, 1, 1)], "k string, label int, at int")
    assert {r["k"]: r["label"] for r in ml.confirmed_labels(rows, "k", "at").collect()} == {"a": 0, "b": 0, "c": 1}


def test_the_model_ranks_held_out_documents(spark):
    scored = catalogue.q_ml_predict(spark, "/root/testdata/sf0.01").cache()
    held = scored.filter("held_out")
    got = calibration.metrics(calibration.counted(held, "p", "label"), 0.9, 0.1).first()
    rows = [(r["p"], r["label"]) for r in held.collect()]
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    assert got["auc"] == pytest.approx(sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg))
    assert got["auc"] > 0.8 and scored.count() == spark.read.parquet("/root/testdata/sf0.01/labels.parquet").count()


def test_words_take_null_texts(spark):
    rows = spark.createDataFrame([("good fine", 0), ("bad awful", 1), (None, 0)] * 5, "text string, label int")
    model = ml.train(rows, words=True)
    got = {r["text"]: r["p"] for r in ml.predict(model, rows).distinct().collect()}
    assert got["bad awful"] > 0.5 > got["good fine"] and got[None] is not None


def test_statuses_in_any_order_and_forgotten_keys(spark):
    day = datetime(2024, 1, 1)
    rows = [(1, 0, 7, "a"), (3, 40, 7, "a"), (2, 20, 7, "b"), (4, 40, 7, "b"), (5, 50, 8, "x"), (6, 5000, 7, "c"), (7, 5001, 8, "x"), (8, 5002, 8, "y"), (9, 5, None, "z")]
    frame = spark.createDataFrame([(e, day + timedelta(minutes=m), u, s, 0.0, "{}") for e, m, u, s in rows], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    path = timed.delivered(frame, "ts", 1)

    def changes(keep_ms):
        events = timed.followed(path, frame.schema, "ts", "0 seconds", timed.apart(spark))
        return sorted(tuple(r) for r in timed.ran(checks.changes_of(events, keep_ms), "append", "kept").rows.collect())

    assert changes(checks.KEEP_MS) == [(7, 2, "a", "b"), (7, 3, "b", "a"), (7, 4, "a", "b"), (7, 6, "b", "c"), (8, 8, "x", "y")]
    assert changes(3_600_000) == [(7, 2, "a", "b"), (7, 3, "b", "a"), (7, 4, "a", "b"), (8, 8, "x", "y")]


def test_evidence_of_a_hot_key(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("host"), F.format_string("%04d.png", "id").alias("ref"))
    got = export.evidence_parts(rows, "host", "ref", Config(max_links=100)).collect()
    assert max(len(r["refs"]) for r in got) == 100 and sum(len(r["refs"]) for r in got) == 1000
    hot = [x for r in sorted((r for r in got if r["host"] == "hot"), key=lambda r: r["part_no"]) for x in r["refs"]]
    assert hot == sorted(hot) and len(hot) == 666


def test_dropped_hosts_are_counted(spark):
    seen = Observation()
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "x")], "host string, seen_at int, engine string")
    assert state.deduped(rows, seen).count() == 1 and seen.get == {"rows": 3, "without_host": 1}


def test_newest_rows(spark):
    rows = spark.createDataFrame([(1, None, 9), (1, 5, 1), (1, 5, 2), (1, 4, 3), (None, 1, 1)], "k int, at int, tie int")
    got = sorted((r["k"] or 0, r["place"], r["tie"]) for r in state.newest(rows, "k", "at", "tie", 2).collect())
    assert got == [(0, 1, 1), (1, 1, 2), (1, 2, 1)]
    assert "WindowGroupLimit" in state.newest(rows, "k", "at", "tie", 2)._jdf.queryExecution().executedPlan().toString()


def test_settings_for_one_machine():
    own = Config.local(high=0.9)
    assert (own.ai_concurrency, own.check_concurrency, own.fast_mode, own.high, own.max_links) == (3, 10, True, 0.9, 1000)


def test_the_model_decides_before_others_are_asked(spark, tmp_path):
    """A model of hosts, its scores fitted to labels, at the cascade's gate."""
    hosts = [(f"{'casino' if k % 2 else 'garden'}-{k}.com", k % 2) for k in range(80)] + [(f"odd{k}.net", k % 3 % 2) for k in range(12)]
    frame = spark.createDataFrame(hosts, "host string, label int")
    ml.save(ml.train(frame.withColumnRenamed("host", "text")), str(tmp_path / "model"))
    model = ml.load(str(tmp_path / "model"))
    blocks = calibration.isotonic(calibration.counted(ml.predict(model, frame.withColumn("text", F.col("host"))), "p", "label"))
    asked = spark.sparkContext.accumulator(0)

    def client(host, excerpt, role):
        asked.add(1)
        return '{"verdict": "clear", "confidence": 0.9}'

    pages = frame.select("host").withColumn("excerpt", F.lit("x"))
    gated = ml.fast_path(model, blocks, pages)
    assert gated.columns == ["host", "excerpt", "p"]
    out = {r["host"]: (r["verdict"], r["decided_by"]) for r in cascade.classify(gated, Config(ai_concurrency=1), client).collect()}
    by_gate = {h: v for h, (v, by) in out.items() if by == "gate"}
    assert len(out) == 92 and len(by_gate) >= 80 and asked.value == 2 * (92 - len(by_gate))
    assert all(by_gate[h] == ("flag" if y else "clear") for h, y in hosts[:80])
