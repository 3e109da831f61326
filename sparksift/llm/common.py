"""What several operators share: reading tables, the shared folder, hidden column names."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.storage import shared_dir

#: Prefix of columns that operators add for their own use; inputs may hold any other name.
OWN = "__sift_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers find this package where the driver has it, whatever folder they start in; elsewhere --py-files serves.
    root = str(Path(__file__).resolve().parents[2])
    held = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in held.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, held) if x)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> str:
    """Writes df to the cluster's shared folder; gives the path."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends there, and any executor can reread it."""
    return df.sparkSession.read.schema(df.schema).parquet(stored(df, label))


def ranked(df: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """df (staged) with pos and size, long: a row's place from 0 by order among the rows of its keys (nulls are a key), and their number.

    Rows are dealt by ranges of keys and order and numbered within each range; a range's number of earlier rows of a key
    comes from counts by key and range. So no task holds a key, however many rows it has. Rows that agree in keys and
    order are parted by where they lie, so these too spread over ranges.
    """
    at, own = f"{OWN}at", f"{OWN}own"
    rows = staged(df.withColumn(at, F.monotonically_increasing_id()), label)
    dealt = rows.repartitionByRange(*keys, *order, at).sortWithinPartitions(*keys, *order, at)
    # The number that a row of a sorted partition gets: the partition in the upper bits, the row's place in it in the lower 33.
    dealt = staged(dealt.drop(at).withColumn(own, F.monotonically_increasing_id()), f"{label}-dealt")
    part = F.shiftright(F.col(own), 33)
    counts = dealt.groupBy(*keys, part.alias(at)).agg(F.min(own).alias("first"), F.count("*").alias("n"))
    of_key = Window.partitionBy(*keys)  # a row for each range that holds the key
    earlier = of_key.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"{OWN}{k}") for k in keys], F.col(at), (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(of_key).alias("size"))
    same = [F.col(k).eqNullSafe(F.col(f"{OWN}{k}")) for k in keys]
    joined = dealt.join(starts, reduce(lambda a, b: a & b, same, part == F.col(at)))
    return joined.select(*df.columns, (F.col(own) + F.col("shift")).alias("pos"), F.col("size").cast("long").alias("size"))


def need(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def byte_groups(sizes: Iterable[int], limit: int) -> list[tuple[int, int]]:
    """Cuts a run of items into slices of about limit bytes; an item over the limit has its own slice."""
    out, start, held, n = [], 0, 0, 0
    for n, size in enumerate(sizes, 1):
        if held and held + size > limit:
            out.append((start, n - 1))
            start, held = n - 1, 0
        held += size
    if n > start:
        out.append((start, n))
    return out
