"""Sketches within their bounds over all ranges of days, and a dashboard that no order or repetition of batches changes."""

import itertools
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from sparksift.operators import sketches
from sparksift.operators.report import status_rollup
from sparksift.plans import catalogue
from sparksift.streaming.dashboard import Dashboard

from .conftest import SF_DIR


def test_all_ranges_lie_within_the_bounds(spark):
    day = F.date_add(F.lit(date(2024, 3, 1)), (F.col("id") % 9).cast("int"))
    # A third of all keys is one, of the other rows some thousand keys a day; values have ties and long tails.
    log = spark.range(60_000).select(day.cast("timestamp").alias("at"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.xxhash64("id") % 7000).alias("k"), F.pow(F.xxhash64("id", F.lit(1)) % 1000 / 500.0, 3).alias("v"), F.concat(F.lit("s"), F.floor(F.pow(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(40)), 2) / 100)).alias("s"))
    sizes = sketches.Sizes()
    days = sketches.daily(log, "at", "k", "v", "s", sizes)
    pairs = [(date(2024, 3, 1) + timedelta(a), date(2024, 3, 1) + timedelta(b)) for a in range(9) for b in range(a, 9)]
    got = sketches.ranged(days, spark.createDataFrame(pairs, "first date, last date"), sizes).collect()
    held = log.toPandas().assign(day=lambda f: f["at"].dt.date)
    assert len(got) == len(pairs) == 45
    for r in got:
        own = held[(held["day"] >= r["first"]) & (held["day"] <= r["last"])]
        true = own["k"].nunique()
        assert r["n"] == len(own) and abs(r["keys"] - true) <= 3 * 1.04 / 2 ** (sizes.lg_k / 2) * true
        for q, name in ((0.5, "median"), (0.9, "p90")):
            below, upto = (own["v"] < r[name]).mean(), (own["v"] <= r[name]).mean()
            assert below - 0.0165 <= q <= upto + 0.0165
        counts = own["s"].value_counts()
        assert all(0 <= x["count"] - counts[x["item"]] <= len(own) / (0.75 * sizes.items) for x in r["top"])


def test_no_days(spark):
    log = spark.createDataFrame([(None, 1, 1.0, "a")], "at timestamp, k int, v double, s string")
    days = sketches.daily(log, "at", "k", "v", "s")
    assert days.count() == 0 and sketches.ranged(days, spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 2))], "first date, last date")).count() == 0


def test_exact_tables_of_days(spark):
    day = F.date_add(F.lit(date(2024, 3, 1)), (F.col("id") % 9).cast("int"))
    made = spark.range(30_000).select(day.cast("timestamp").alias("at"), (F.xxhash64("id") % 6000).alias("k"), F.lit("b").alias("s"))
    odd = [(date(2024, 3, 20), None, None), (date(2024, 3, 20), 1, None), (date(2024, 3, 21), 1, "z"), (date(2024, 3, 21), 1, "y"), (None, 5, "y")]
    log = made.unionByName(spark.createDataFrame(odd, "at date, k long, s string").withColumn("at", F.col("at").cast("timestamp"))).cache()
    ranges = [(date(2024, 3, 1) + timedelta(a), date(2024, 3, 1) + timedelta(b)) for a in range(9) for b in range(a, 9)]
    ranges += [(date(2024, 3, 20), date(2024, 3, 20)), (date(2024, 3, 21), date(2024, 3, 21)), (date(2024, 3, 20), date(2024, 3, 21))]
    got = sketches.exact_ranged(*sketches.exact_daily(log, "at", "k", "s"), spark.createDataFrame(ranges, "first date, last date")).collect()
    found = {(r["first"], r["last"]): (r["n"], r["keys"], r["top"]) for r in got}
    held = log.filter("at IS NOT NULL").toPandas().assign(day=lambda f: f["at"].dt.date)
    for first, last in ranges[:45]:
        own = held[(held["day"] >= first) & (held["day"] <= last)]
        assert found.pop((first, last)) == (len(own), own["k"].nunique(), "b")
    assert [found[r] for r in ranges[45:]] == [(2, 1, None), (2, 1, "y"), (4, 1, None)]


def test_users_of_days_are_exact_beyond_some_hundreds(spark, tmp_path):
    spark.range(20_000).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(id % 3) AS ts", "id % 7000 AS user_id", "'view' AS event_type", "1.0D AS value", "'' AS props").write.parquet(str(tmp_path / "events.parquet"))
    got = catalogue.q_day_sketches(spark, str(tmp_path)).filter("days = 7").orderBy("last").collect()
    assert [(r["n"], r["users"]) for r in got] == [(6667, 6667), (13334, 7000), (20000, 7000)]


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2, 2, 0, 3, 1)])
def test_any_order_of_batches(spark, tmp_path, order):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").select(F.to_date("ts").alias("day"), F.col("event_type").alias("status"), "value", "event_id")
    board = Dashboard(spark, str(tmp_path / "d"))
    assert board.rollup().filter("day IS NOT NULL").count() == 0
    for n, k in enumerate(order):
        board.add(events.filter(F.col("event_id") % 4 == k), k)
        if n in (2, 5, 6):
            board.compact()
    want = rows(status_rollup(events, "day", "status", "value"))
    assert rows(board.rollup()) == want
    board.compact()
    board.compact()
    assert rows(board.rollup()) == want
    board.add(events.limit(5), 2)  # known
    assert rows(board.rollup()) == want and board.base() == 3


def test_a_batch_that_broke_off_is_not_read(spark, tmp_path):
    frame = spark.createDataFrame([(date(2024, 1, 1), "a", 1.0), (None, None, 2.0)], "day date, status string, value double")
    board = Dashboard(spark, str(tmp_path / "d"))
    board.add(frame, 0)
    board.add(frame, 1)
    (tmp_path / "d/batches/batch=1/_SUCCESS").unlink()
    assert sorted((r["n"], r["total"]) for r in board.sums().collect()) == [(1, 1.0), (1, 2.0)]
    board.add(frame, 1)
    assert sorted((r["n"], r["total"]) for r in board.sums().collect()) == [(2, 2.0), (2, 4.0)]
    assert list(itertools.chain(board._numbers("batches"))) == [0, 1]
