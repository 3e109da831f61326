"""Rows in order over many tasks: dealt by ranges of key and order, with what earlier ranges hand on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.storage import written

#: A row's number: its range in the upper bits, its place in the sorted range in the lower 33.
OWN = "_own"


def range_of() -> Column:
    return F.shiftright(F.col(OWN), 33)


def in_ranges(rows: DataFrame, keys: list[str], order: list[str], label: str = "ranges") -> DataFrame:
    """rows with OWN, written: sorted by keys and order within ranges, nulls first. A key with a third of all rows lies in many ranges, rows that agree in all too."""
    order = [*keys, *order, "_alike"]
    dealt = rows.withColumn("_alike", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return written(dealt.drop("_alike").withColumn(OWN, F.monotonically_increasing_id()), label)


def same(keys: list[str], other: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, other)), F.lit(True))


def with_sums(ranged: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """ranged with running sums over the rows of a key up to each, from the sums of a key's earlier ranges (a row for each) and those within."""
    names = [f"_k{i}" for i in range(len(keys))]
    part = ranged.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], range_of().alias("_r")).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*names).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    before = part.select(*names, "_r", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
    at = ranged.withColumn("_at", range_of())
    within = Window.partitionBy(*keys, "_at").orderBy(OWN).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = at.withColumns({n: F.sum(c).over(within) for n, c in sums.items()}).join(before, same(keys, names) & (F.col("_at") == F.col("_r")))
    return joined.select(*ranged.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums])


def asof_join(left: DataFrame, right: DataFrame, by: str, at: str, right_at: str, carry: list[str], tie: str | None = None) -> DataFrame:
    """left with the carried columns of the newest right row of the same key that isn't later; nulls where there is none.

    Both sides are sorted together by ranges of (key, time), right rows before left rows of their time, the highest tie last.
    A row takes the last right row before it in its range, or else what the key's earlier ranges hand on, one row each. So
    no task and no window holds a key. Left rows of null key or time match nothing, right ones are matched by nothing.
    Repeated left rows stay, and repeated right rows change nothing. carry and left have no names in common.
    """
    kinds = dict(right.dtypes)
    found = F.struct(*carry)
    rights = right.filter(F.col(by).isNotNull() & F.col(right_at).isNotNull()).select(F.col(by).alias("_key"), F.col(right_at).alias("_time"), (F.col(tie) if tie else F.lit(0)).alias("_tie"), found.alias("_found"))
    lefts = left.select(F.col(by).alias("_key"), F.col(at).alias("_time"), F.struct(*left.columns).alias("_left")).withColumn("_side", F.lit(1))
    both = rights.withColumn("_side", F.lit(0)).unionByName(lefts, allowMissingColumns=True)
    both = in_ranges(both, ["_key"], ["_time", "_side", "_tie"], "asof").withColumn("_at", range_of())
    within = Window.partitionBy("_key", "_at").orderBy(OWN).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = both.groupBy(F.col("_key").alias("_k"), F.col("_at").alias("_r")).agg(F.max_by("_found", F.when(F.col("_side") == 0, F.col(OWN))).alias("_last"))
    past = Window.partitionBy("_k").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    handed = last.select("_k", "_r", F.last("_last", ignorenulls=True).over(past).alias("_handed"))
    joined = both.withColumn("_near", F.last("_found", ignorenulls=True).over(within)).filter("_side = 1").join(handed, (F.col("_key") == F.col("_k")) & (F.col("_at") == F.col("_r")), "left")
    got = F.when(F.col("_time").isNotNull(), F.coalesce("_near", "_handed"))
    return joined.select("_left.*", *[got[c].cast(kinds[c]).alias(c) for c in carry])
