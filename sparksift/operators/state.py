"""The check log: what is new, what was last seen, what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def deduped(candidates: DataFrame, seen: Observation | None = None) -> DataFrame:
    """host, seen_at, engine to host, first_seen, engines (sorted), n; null hosts go. What goes is told by `seen`: rows, without_host, when the result has been made."""
    if seen:
        candidates = candidates.observe(seen, F.count("*").alias("rows"), F.count_if(F.col("host").isNull()).alias("without_host"))
    return candidates.filter("host IS NOT NULL").groupBy("host").agg(F.min("seen_at").alias("first_seen"), F.array_sort(F.collect_set("engine")).alias("engines"), F.count("*").alias("n"))


def new_hosts(candidates: DataFrame, log: DataFrame) -> DataFrame:
    return candidates.filter("host IS NOT NULL").join(log.select("host"), "host", "left_anti")


def reported(candidates: DataFrame, log: DataFrame, key: str = "host") -> DataFrame:
    return candidates.join(log.select(key), key, "left_semi")


def latest(log: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """The newest row of each key; the highest tie at equal times. max of a struct is combined before the shuffle, a window is not."""
    rest = [c for c in log.columns if c not in (key, at, tie)]
    return log.groupBy(key).agg(F.max(F.struct(at, tie, *rest)).alias("r")).select(key, *[f"r.{c}" for c in (at, tie, *rest)])


def blocked(log: DataFrame, key: str, at: str, tie: str, status: str, wanted: tuple[str, ...]) -> DataFrame:
    return latest(log, key, at, tie).filter(F.col(status).isin(*wanted))


def changes(log: DataFrame, key: str, at: str, tie: str, status: str) -> DataFrame:
    """Rows whose status differs from that of the row before of the same key; a key's first row is no change."""
    w = Window.partitionBy(key).orderBy(at, tie)
    return log.withColumn("before", F.lag(status).over(w)).filter(F.col("before").isNotNull() & (F.col("before") != F.col(status)))


def upserted(store: DataFrame, updates: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """The store after updates: both logs together, newest row of each key. The caller writes it to a new path and swaps."""
    return latest(store.unionByName(updates), key, at, tie)


def newest(log: DataFrame, key: str, at: str, tie: str, most: int) -> DataFrame:
    """The newest rows of each key, at most so many, with place from 1. Spark keeps as many of a key in each task before the shuffle, so a key of any size is sent in few rows."""
    w = Window.partitionBy(key).orderBy(F.col(at).desc_nulls_last(), F.col(tie).desc())
    return log.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)
