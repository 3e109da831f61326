"""Joins and splits over ranges: one key with most rows lies in many tasks, and results equal plain ones."""

import random
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from sparksift.config import Config
from sparksift.operators import export
from sparksift.operators.ranges import asof_join, in_ranges


@pytest.fixture
def apart(spark):
    """Small partitions stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def frames(spark, seed):
    r, day = random.Random(seed), datetime(2024, 1, 1)
    key = lambda: r.choice((0, 0, 0, 0, 1, 2, 3, None))
    lefts = [(k, key(), day + timedelta(seconds=r.randrange(400)) if r.random() < 0.97 else None) for k in range(400)]
    rights = [(k, key() if r.random() < 0.5 else r.choice((0, 5)), day + timedelta(seconds=r.randrange(400)) if r.random() < 0.97 else None, r.choice(("a", None, "c"))) for k in range(150)]
    return spark.createDataFrame(lefts, "id int, u int, t timestamp_ntz"), spark.createDataFrame(rights, "rid int, u int, rt timestamp_ntz, s string")


@pytest.mark.parametrize("seed", range(3))
def test_asof_equals_duckdb(spark, apart, seed):
    lefts, rights = frames(spark, seed)
    got = asof_join(lefts, rights, "u", "t", "rt", ["rid", "rt", "s"], "rid")
    l, r = lefts.toPandas().astype({"u": "Int32"}), rights.toPandas().astype({"u": "Int32"})  # noqa: F841
    want = duckdb.sql("SELECT id, l.u, l.t, rid, rt, s FROM l ASOF LEFT JOIN (SELECT u, rt, max(rid) AS rid, arg_max(struct_pack(s := s), rid).s AS s FROM r WHERE rt IS NOT NULL GROUP BY u, rt) v ON l.u = v.u AND l.t >= v.rt").fetchall()
    assert sorted(map(repr, (tuple(x) for x in got.collect()))) == sorted(map(repr, want))


def test_asof_of_nothing(spark):
    lefts, rights = frames(spark, 9)
    none = asof_join(lefts, rights.limit(0), "u", "t", "rt", ["rid"], "rid")
    assert none.count() == 400 and none.filter("rid IS NOT NULL").count() == 0
    assert asof_join(lefts.limit(0), rights, "u", "t", "rt", ["rid"], "rid").count() == 0


def test_a_key_lies_in_many_ranges(spark, apart):
    ranged = in_ranges(spark.range(2000).select((F.col("id") % 100 == 0).cast("int").alias("k"), F.lit(1).alias("v")), ["k"], ["v"])
    assert ranged.filter("k = 0").select(F.shiftright("_own", 33)).distinct().count() > 1


@pytest.mark.parametrize("links, cap, block", [(5, 100, 10), (7, 1000, 16), (4, 30, 8), (1, 10, 2), (50, 60, 100), (5, 100, 1 << 16)])
def test_dual_split_in_blocks(spark, apart, links, cap, block):
    r = random.Random(links)
    rows = [("big", k, r.choice((0, 1, 10, 40, 99, 100, 101, 500, None))) for k in range(700)] + [(f"b{k % 9}", k, r.randrange(60)) for k in range(150)] + [(None, k, 30) for k in range(40)] + [("one", 1, 1)]
    r.shuffle(rows)
    frame = spark.createDataFrame(rows, "b string, k int, s int").repartition(5)
    got = export.split_dual(frame, "b", "k", "s", Config(max_links=links, max_bytes=cap), block).collect()
    want = {}
    for b in {x[0] for x in rows}:
        own = sorted((x[1], x[2]) for x in rows if x[0] == b)
        want |= {(b, k): p for (k, _), p in zip(own, export.parts_of([s or 0 for _, s in own], links, cap))}
    assert {(x["bundle"], x["item"]): x["part_no"] for x in got} == want and len(got) == len(rows)


def test_one_bundle_over_many_tasks(spark, apart):
    frame = spark.range(4000).select(F.lit("all").alias("b"), "id", (F.col("id") % 37).alias("s"))
    got = export.split_dual(frame, "b", "id", "s", Config(max_links=10, max_bytes=150), 200)
    assert got.groupBy(F.spark_partition_id()).count().count() > 1
    assert [r["part_no"] for r in got.orderBy("item").collect()] == export.parts_of([k % 37 for k in range(4000)], 10, 150)
