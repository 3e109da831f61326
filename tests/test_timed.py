"""State that is dropped, rows that come too late, timers: what the progress of a stream says."""

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import duckdb

from sparksift.plans import catalogue
from sparksift.schemas import EVENT
from sparksift.streaming import timed

from .conftest import SF_DIR


def events(spark, rows):
    day = datetime(2024, 1, 1)
    return spark.createDataFrame([(k, day + timedelta(minutes=m), u, kind, 1.0) for k, (m, u, kind) in enumerate(rows)], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double")


def test_interval_state_is_bounded(spark):
    run = catalogue.interval_stream(spark, SF_DIR)
    assert run.late == 0
    # 1,000 events of 30 days lie in files of three days; state holds what is younger than the join's span and the file before.
    sides = spark.read.parquet(f"{SF_DIR}/events.parquet").filter("event_type IN ('view', 'purchase')").count()
    assert len(run.held) >= 10 and max(run.held) < sides / 3 and run.held[-1] < sides / 10


def test_interval_join_of_a_hot_key(spark):
    rows = [(k, 1 if k % 3 else k % 7, ("view", "purchase")[k % 2]) for k in range(600)] + [(5, None, "view"), (5, None, "purchase")]
    got = timed.interval_join(*catalogue.views_and_purchases(events(spark, rows)), "user_id", "ts", "bought_at", 600)
    want = {(i, j) for i, (m, u, k) in enumerate(rows) for j, (n, v, q) in enumerate(rows) if k == "view" and q == "purchase" and u is not None and u == v and 0 <= n - m <= 10}
    assert {(r["view_id"], r["purchase_id"]) for r in got.collect()} == want and got.count() == len(want)


def test_late_rows_are_counted(spark):
    run = catalogue.session_stream(spark, SF_DIR)
    late = spark.read.parquet(f"{SF_DIR}/events.parquet").filter(catalogue.LATE).count()
    assert 0 < run.late <= late and max(run.held) < 1000 / 3


def test_timers_in_any_order_leave_no_state(spark):
    # User 1 is silent after 30 and after 2000; 2 after 10; 3 closes the time. Rows of a file lie out of order.
    rows = [(30, 1, "x"), (0, 1, "x"), (10, 2, "x"), (10, 2, "x"), (2000, 1, "x"), (1900, 1, "x"), (1300, 1, "x"), (700 + 2000, 3, "x"), (9000, 3, "x")]
    path = timed.delivered(events(spark, rows), "ts", 1)
    schema = events(spark, []).schema
    run = timed.ran(timed.silences(timed.followed(path, schema, "ts", "1 hour", timed.apart(spark)), "user_id", "ts", 12), "append", "silence")
    start = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp() // 60)
    got = sorted((r["user_id"], (r["at"] // 60_000) - start, r["n"]) for r in run.rows.collect())
    assert got == [(1, 30, 1), (1, 2000, 1), (2, 10, 2), (3, 2700, 1)]
    assert run.held[-1] <= 2  # the last event and its timer


def test_nothing_comes(spark):
    path = timed.delivered(events(spark, []), "ts", 5)
    run = timed.ran(timed.sessions(timed.followed(path, events(spark, []).schema, "ts", "1 hour", spark), "user_id", "ts", "6 hours", "value"), "append", "none")
    assert run.rows.count() == 0


def silences_of(spark, rows, days=1):
    path = timed.delivered(events(spark, rows), "ts", days)
    return timed.ran(timed.silences(timed.followed(path, events(spark, []).schema, "ts", "1 hour", timed.apart(spark)), "user_id", "ts", 12), "append", "silence")


def test_state_of_silences_does_not_grow_with_rows(spark):
    rows = [(k % 700, 1, "x") for k in range(2100)] + [(4000, 2, "x")]
    run = silences_of(spark, rows)
    assert max(run.held) <= 4  # a value a key, and the timers
    assert [(r["user_id"], r["n"]) for r in run.rows.collect()] == [(1, 3)]


def test_silences_of_any_rows(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(9000), u, "x") for u in range(12) for _ in range(draw.randrange(1, 30))]
    rows += [(0, 20, "x"), (720, 20, "x"), (1441, 20, "x"), (9600 - 60 - 720, 21, "x"), (9600 - 59 - 720, 22, "x"), (9600, 23, "x")]
    start = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp() // 60)
    got = sorted((r["user_id"], r["at"] // 60_000 - start, r["n"]) for r in silences_of(spark, rows).rows.collect())
    times = Counter((u, m) for m, u, _ in rows)
    assert got == sorted((u, m, n) for (u, m), n in times.items() if m + 720 <= 9540 and not any(v == u and m < o <= m + 720 for v, o in times))


def test_a_late_event_joins_a_session_that_was_given(spark, tmp_path):
    hour = 60
    # User 1's session has been given when a late event of it comes; user 2's is tied by one to what is open at the end.
    known = [(4 * 24 * hour + 23 * hour, 9), *((4 * 24 * hour + 15 * hour, u) for u in (1, 2, 3)), *((4 * 24 * hour + 22 * hour + 5 * hour * k, 2) for k in range(49)), (14 * 24 * hour + 23 * hour, 9), (0, 9)]
    rows = [(50 * k, m, u) for k, (m, u) in enumerate(known)] + [(50 * k + 7, 4 * 24 * hour + 17 * hour, u) for k, u in enumerate((1, 2))]
    day = datetime(2024, 1, 1)
    made = [(i, day + timedelta(minutes=m), u, "view", 1.5, "{}") for i, m, u in rows]
    spark.createDataFrame(made, EVENT).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = [tuple(r) for r in catalogue.q_stream_sessions(spark, str(tmp_path)).collect()]
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        want = c.execute(catalogue.ORACLE_SQL["q_stream_sessions"]).fetchall()
    assert sorted(got) == sorted(want)
    assert [r for r in got if r[0] in (1, 2)] == [(1, day + timedelta(days=4, hours=15), day + timedelta(days=4, hours=23), 2, 3.0)]


def test_no_sessions(spark, tmp_path):
    spark.createDataFrame([], EVENT).write.parquet(str(tmp_path / "events.parquet"))
    assert catalogue.q_stream_sessions(spark, str(tmp_path)).count() == 0
