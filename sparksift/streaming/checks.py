"""The check log as a stream: windows, duplicates, status changes. Each runs on what there is and stops."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.storage import fresh_path
from ..schemas import EVENT
from .timed import apart


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time is a timestamp: watermarks take no timestamp without zone."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    reader = spark.readStream.schema(EVENT)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        events = reader.parquet(f"{sf_dir}/events.parquet")
    else:  # a stream reads folders
        events = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def drained(df: DataFrame, mode: str, label: str) -> DataFrame:
    """Everything that the stream gives, collected into files by batch; in complete mode the last batch."""
    spark = df.sparkSession
    out = fresh_path(spark, label)

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = df.writeStream.outputMode(mode).option("checkpointLocation", fresh_path(spark, f"{label}-state")).foreachBatch(save).trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.schema(f"{', '.join(f'`{n}` {t}' for n, t in df.dtypes)}, batch bigint").parquet(out)
    if mode == "complete":
        got = got.join(got.agg(F.max("batch").alias("batch")), "batch")
    return got.drop("batch")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream(spark, sf_dir).withWatermark("ts", "1 hour")
    counts = events.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    flat = counts.select(F.col("window.start").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))
    return drained(flat, "complete", "hourly").withColumn("start", F.col("start").cast("timestamp_ntz"))


def without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log delivered twice, as after a lost acknowledgement; every event comes through once."""
    twice, events = fresh_path(spark, "delivered"), spark.read.schema(EVENT).parquet(f"{sf_dir}/events.parquet")
    events.unionByName(events).write.parquet(f"{twice}/events.parquet")
    seen = stream(spark, twice).withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["event_id"])
    return drained(seen.select("event_id", "user_id", "event_type"), "append", "repeats")


class StatusChanges(StatefulProcessor):
    """Keeps the last status of a key; gives a row for each change. Rows of a batch are taken in order of time and id."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "status string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        before = self.last.get()[0] if self.last.exists() else None
        out = []
        for event, status in zip(held["event_id"], held["event_type"]):
            if before is not None and status != before:
                out.append((key[0], event, before, status))
            before = status
        self.last.update((before,))
        yield pd.DataFrame(out, columns=["user_id", "event_id", "from_status", "to_status"])

    def close(self) -> None:
        pass


class OrderedChanges(StatefulProcessor):
    """Gives a row for each change of a key's status, in the order of time and id, when the watermark has passed it.

    An event waits in state under its millisecond, with a timer; timers come in the order of time, so rows are taken one
    at a time and may come in any order. A key of which nothing has come for `keep_ms` is forgotten: its next event is
    a first one again.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at bigint", "events string")
        self.last = handle.getValueState("last", "status string, at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for us, event, status in zip(frame["us"].tolist(), frame["event_id"].tolist(), frame["event_type"].tolist()):
                at = (us // 1000,)
                held = json.loads(self.waiting.getValue(at)[0]) if self.waiting.containsKey(at) else []
                if not held:
                    self.handle.registerTimer(at[0])
                self.waiting.updateValue(at, (json.dumps([*held, (us, event, status)]),))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = (expiredTimerInfo.getExpiryTimeInMs(),)
        before, since = self.last.get() if self.last.exists() else (None, None)
        if not self.waiting.containsKey(at):  # the timer of what to forget
            if since is not None and since + self.keep_ms <= at[0]:
                self.last.clear()
            return
        out = []
        for _, event, status in sorted(json.loads(self.waiting.getValue(at)[0])):
            if before is not None and status is not None and status != before:
                out.append((key[0], event, before, status))
            before = status
        self.waiting.removeKey(at)
        self.last.update((before, at[0]))
        self.handle.registerTimer(at[0] + self.keep_ms)
        if out:
            yield pd.DataFrame(out, columns=["user_id", "event_id", "from_status", "to_status"])

    def close(self) -> None:
        pass


#: Fixed value: a year.
KEEP_MS = 366 * 86_400_000


def changes_of(events: DataFrame, keep_ms: int = KEEP_MS) -> DataFrame:
    """A stream of user_id, event_id, ts (with a watermark), event_type to its changes of status. Null users and times go.

    Each row costs calls to the state store, some 5 ms in all; where a batch holds its keys' rows in order, StatusChanges is far quicker.
    """
    rows = events.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull()).select("user_id", "event_id", "event_type", F.unix_micros("ts").alias("us"), "ts")
    return rows.groupBy("user_id").transformWithStateInPandas(statefulProcessor=OrderedChanges(keep_ms), outputStructType="user_id bigint, event_id bigint, from_status string, to_status string", outputMode="Append", timeMode="EventTime")


def status_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream(apart(spark), sf_dir).select("user_id", "event_id", "ts", "event_type")
    moved = events.groupBy("user_id").transformWithStateInPandas(statefulProcessor=StatusChanges(), outputStructType="user_id bigint, event_id bigint, from_status string, to_status string", outputMode="Append", timeMode="None")
    return drained(moved, "append", "changes")
