"""The store of replies: what is asked, how often, and what is left after a stop."""

import json

import pytest
from pyspark.sql import functions as F

from sparksift.config import Config
from sparksift.operators import cascade
from sparksift.operators.replies import ReplyStore


@pytest.fixture
def calls(spark):
    return spark.sparkContext.accumulator(0)


def counting(calls, fails=0, stops=()):
    seen = {}

    def client(host, excerpt, role):
        if host in stops:
            raise RuntimeError("stopped")
        calls.add(1)
        seen[host] = seen.get(host, 0) + 1
        return "no json" if host.startswith("bad") or seen[host] <= fails else json.dumps({"verdict": "flag" if "bet" in excerpt else "clear", "confidence": 0.8})

    return client


def pages(spark, n=30, extra=()):
    return spark.createDataFrame([(f"h{k}.com", f"bet {k}" if k % 2 else f"plain {k}") for k in range(n)] + list(extra), "host string, excerpt string")


def test_a_second_run_asks_nobody(spark, tmp_path, calls):
    store, config = ReplyStore(spark, f"{tmp_path}/r", buckets=8, slice_rows=10), Config(ai_concurrency=2)
    rows = pages(spark, 30, [("h1.com", "bet 1"), (None, "x"), ("null.com", None)])
    first = sorted(map(tuple, store.replies(rows, "primary", counting(calls), config).collect()))
    assert calls.value == 31 and len(first) == 31
    again = sorted(map(tuple, ReplyStore(spark, f"{tmp_path}/r", buckets=8).replies(rows, "primary", counting(calls), config).collect()))
    assert calls.value == 31 and again == first
    changed = rows.withColumn("excerpt", F.when(F.col("host") == "h3.com", "new").otherwise(F.col("excerpt")))
    store.replies(changed, "primary", counting(calls), config)
    assert calls.value == 32
    store.replies(rows, "validator", counting(calls), config)  # another role is another question
    store.replies(rows, "primary", counting(calls), config, model="other")
    assert calls.value == 32 + 2 * 31


def test_a_stopped_run_keeps_its_slices(spark, tmp_path, calls):
    store, config = ReplyStore(spark, f"{tmp_path}/r", buckets=8, slice_rows=5), Config(ai_concurrency=1)
    rows = pages(spark, 40)
    last = store.keyed(rows).orderBy((F.col("bucket") % 8).desc()).first()["host"]  # in the last slice
    with pytest.raises(Exception, match="stopped"):
        store.replies(rows, "primary", counting(calls, stops=(last,)), config)
    kept = store.read().count()
    assert 0 < kept < 40
    before = calls.value
    assert store.replies(rows, "primary", counting(calls), config).count() == 40
    assert calls.value - before == 40 - kept and store.read().count() == 40


def test_invalid_replies_are_asked_again_and_then_left(spark, tmp_path, calls):
    store, config = ReplyStore(spark, f"{tmp_path}/r", buckets=4), Config(ai_concurrency=1, json_retries=2)
    rows = spark.createDataFrame([("bad.com", "bet"), ("ok.com", "bet")], "host string, excerpt string")
    got = {r["host"]: r for r in store.replies(rows, "primary", counting(calls), config).collect()}
    assert calls.value == 4 and got["bad.com"]["raw"] == "no json" and got["bad.com"]["tokens"] == 3 * 3
    store.replies(rows, "primary", counting(calls), config)
    assert calls.value == 4


def test_the_cascade_over_a_store(spark, tmp_path, calls):
    store, config = ReplyStore(spark, f"{tmp_path}/r", buckets=4), Config(ai_concurrency=1)
    want = sorted(map(tuple, cascade.classify(pages(spark, 8), config, counting(calls)).collect()))
    for _ in range(2):
        assert sorted(map(tuple, cascade.classify(pages(spark, 8), config, counting(calls), store).collect())) == want
    assert calls.value == 2 * 16 and store.read().count() == 16
    assert cascade.classify(pages(spark, 8).limit(0), config, counting(calls), store).count() == 0


def test_quota_stops_calls_until_the_next_month(spark, tmp_path, calls):
    store, config = ReplyStore(spark, f"{tmp_path}/r", buckets=8, slice_rows=5), Config(ai_concurrency=1, monthly_tokens=40)
    rows = pages(spark, 40)
    first = store.replies(rows, "primary", counting(calls), config, month="2024-01").count()
    assert 0 < first < 40 and first == calls.value and store.spent("2024-01") >= 40
    assert store.replies(rows, "primary", counting(calls), config, month="2024-01").count() == first == calls.value
    assert store.replies(rows, "primary", counting(calls), Config(ai_concurrency=1), month="2024-02").count() == 40 == calls.value
