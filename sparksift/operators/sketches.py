"""Sketches of a day's checks, stored once and merged over any days: distinct keys, quantiles, most frequent values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sizes:
    """Of the sketches, whatever the rows of a day. Bounds that follow, for any range of days:

    distinct keys within 3 * 1.04 / sqrt(2 ** lg_k) of the true number (three standard errors, 4.9 % at 12); the rank of a
    quantile within 1.65 % of the rows (k 200, at 99 %); a value's count too high by at most rows / (0.75 * items).
    """

    lg_k: int = 12
    kll: int = 200
    items: int = 1024


def daily(log: DataFrame, at: str, key: str, value: str, status: str, sizes: Sizes = Sizes()) -> DataFrame:
    """day, keys, values, statuses (sketches), one row a day, combined before the shuffle. Nulls count in none of them; rows without time go."""
    of_day = log.filter(F.col(at).isNotNull()).groupBy(F.to_date(at).alias("day"))
    return of_day.agg(F.hll_sketch_agg(key, sizes.lg_k).alias("keys"), F.kll_sketch_agg_double(value, sizes.kll).alias("values"), F.expr(f"approx_top_k_accumulate({status}, {sizes.items})").alias("statuses"))


def ranged(days: DataFrame, ranges: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """ranges (first, last, and columns to keep) with n, keys, median, p90, top array of (item, count): of the days in each.

    Each range is spread over its days and meets their sketches by an equal day. A range without rows isn't given.
    """
    spread = ranges.withColumn("day", F.explode(F.sequence("first", "last")))
    merged = spread.join(days, "day").groupBy(*ranges.columns).agg(F.hll_union_agg("keys").alias("k"), F.kll_merge_agg_double("values").alias("v"), F.expr(f"approx_top_k_combine(statuses, {sizes.items})").alias("t"))
    quantile = lambda q: F.kll_sketch_get_quantile_double("v", F.lit(q))
    n = F.kll_sketch_get_n_double("v")
    return merged.select(*ranges.columns, n.alias("n"), F.hll_sketch_estimate("k").alias("keys"), F.when(n > 0, quantile(0.5)).alias("median"), F.when(n > 0, quantile(0.9)).alias("p90"), F.expr("approx_top_k_estimate(t, 10)").alias("top"))


def exact_daily(log: DataFrame, at: str, key: str, status: str) -> tuple[DataFrame, DataFrame]:
    """Two tables of whole numbers from which any range of days is counted without error, as long as days and statuses are, whatever the keys.

    day, status, count; and day, next_day, keys: of the keys of a day, how many come again on next_day first (null: on none).
    So a key counts once in a range: on its last day there. Rows without time go; null keys count as rows only, as in SQL.
    """
    rows = log.filter(F.col(at).isNotNull()).select(F.to_date(at).alias("day"), F.col(key).alias("_key"), F.col(status).alias("status"))
    statuses = rows.groupBy("day", "status").agg(F.count("*").alias("count"))
    seen = rows.filter(F.col("_key").isNotNull()).select("_key", "day").distinct()
    again = seen.withColumn("next_day", F.lead("day").over(Window.partitionBy("_key").orderBy("day")))
    return statuses, again.groupBy("day", "next_day").agg(F.count("*").alias("keys"))


def exact_ranged(statuses: DataFrame, again: DataFrame, ranges: DataFrame) -> DataFrame:
    """ranges (first, last, and columns to keep; each once) with n, keys and top, the most frequent status: of equal ones the least, null last."""
    spread = ranges.withColumn("day", F.explode(F.sequence("first", "last")))
    counts = spread.join(statuses, "day").groupBy(*ranges.columns, "status").agg(F.sum("count").alias("count"))
    order = F.struct(-F.col("count"), F.col("status").isNull(), "status")
    rows = counts.groupBy(*ranges.columns).agg(F.sum("count").alias("n"), F.min_by("status", order).alias("top"))
    last_there = F.col("next_day").isNull() | (F.col("next_day") > F.col("last"))
    keys = spread.join(again, "day").filter(last_there).groupBy(*ranges.columns).agg(F.sum("keys").alias("keys"))
    return rows.join(keys, ranges.columns, "left").select(*ranges.columns, "n", F.coalesce("keys", F.lit(0)).alias("keys"), "top")
