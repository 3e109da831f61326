"""Joins, sessions and timers over event time, each with a batch twin where one is of use."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.storage import fresh_path

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def delivered(rows: DataFrame, at: str, days: int, late: str | None = None) -> str:
    """rows in a folder, as files that come one after the other: one for each so many days from the first, in order.

    Rows that the condition `late` marks come with the last one, whatever their time.
    """
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "delivered")
    first, last = rows.agg(F.min(at), F.max(at)).first()
    if first is None:
        rows.write.parquet(path)
        return path
    slots = (last.date() - first.date()).days // days
    slot = F.floor(F.date_diff(F.to_date(at), F.lit(first.date())) / days)
    slot = F.when(F.expr(late), slots).otherwise(slot) if late else slot
    for k in range(slots + 1):  # a stream takes the older files first
        rows.filter(slot == k).repartition(1).write.mode("append").parquet(path)
    return path


def apart(spark: SparkSession) -> SparkSession:
    """A session whose state lies in RocksDB, as state by key and timers ask for; the caller's settings stay as they are."""
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return own


@dataclass(frozen=True)
class Ran:
    """What a stream gave, what its progress said (rows in state after each batch, rows dropped as too late), and its checkpoint."""

    rows: DataFrame
    held: list[int]
    late: int
    checkpoint: str


def ran(df: DataFrame, mode: str, label: str) -> Ran:
    """Runs a stream over what there is. A batch that is done again overwrites its own files."""
    spark = df.sparkSession
    out, checkpoint = fresh_path(spark, label), fresh_path(spark, f"{label}-state")

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save).trigger(availableNow=True).start()
    query.awaitTermination()
    states = [p["stateOperators"] for p in query.recentProgress]
    rows = spark.read.schema(f"{', '.join(f'`{n}` {t}' for n, t in df.dtypes)}, batch bigint").parquet(out).drop("batch")
    return Ran(rows, [sum(o["numRowsTotal"] for o in s) for s in states], sum(o["numRowsDroppedByWatermark"] for s in states for o in s), checkpoint)


def followed(path: str, schema, at: str, delay: str, spark: SparkSession) -> DataFrame:
    """The files under path as a stream, one a batch. Watermarks take timestamps with a zone only."""
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)


def interval_join_stream(left: DataFrame, right: DataFrame, by: str, at: str, right_at: str, within: str) -> DataFrame:
    """left and right rows of the same key, the right one not before the left one and at most `within` after it.

    Both sides have a watermark, so state is dropped: a left row once no right row can come within its span, a right row
    once no earlier left row can come. Null keys and times match nothing.
    """
    span = F.expr(f"INTERVAL {within}")
    return left.join(right.withColumnRenamed(by, "_by"), (F.col(by) == F.col("_by")) & (F.col(right_at) >= F.col(at)) & (F.col(right_at) <= F.col(at) + span)).drop("_by")


def interval_join(left: DataFrame, right: DataFrame, by: str, at: str, right_at: str, seconds: int) -> DataFrame:
    """The same over tables: time is cut into bins as long as the span, a left row looks into its own and the next one.

    So it is an equi join on (key, bin), which Spark may split where a key is hot, and no row meets all rows of its key.
    """
    # Bins count whole microseconds.
    place = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (seconds * 1_000_000))
    lefts = left.withColumn("_bin", F.explode(F.array(place(at), place(at) + 1)))
    rights = right.withColumn("_rbin", place(right_at)).withColumnRenamed(by, "_by")
    near = (F.col(by) == F.col("_by")) & (F.col("_bin") == F.col("_rbin"))
    ahead = (F.col(right_at) >= F.col(at)) & (F.col(right_at) <= F.col(at) + F.expr(f"INTERVAL {seconds} SECONDS"))
    return lefts.join(rights, near & ahead).drop("_bin", "_rbin", "_by")


def sessions(events: DataFrame, by: str, at: str, gap: str, value: str) -> DataFrame:
    """by, start, end (last event and gap), n, total of each session: events of a key that lie less than `gap` apart.

    As a stream it gives a session when the watermark has passed its end; until then sessions that an event bridges become
    one. What stays open at the end of the stream isn't given, and events behind the watermark are dropped and counted.
    An event of the batch after may be in time and yet touch a session that has been given: see `joined_sessions`.
    """
    found = events.filter(F.col(by).isNotNull()).groupBy(by, F.session_window(at, gap).alias("_s")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return found.select(by, F.col("_s.start").alias("start"), F.col("_s.end").alias("end"), "n", "total")


def joined_sessions(run: Ran, by: str) -> DataFrame:
    """The sessions that a stream gave, those that overlap as one, total rounded.

    Spark drops an event as late against the watermark before the one by which it gives sessions, so an event that is in
    time makes a session of its own where the one that it belongs to is gone from state. A session that it ties to what is
    still open at the end, which is read from the state, isn't over and not given.
    """
    left = run.rows.sparkSession.read.format("statestore").load(run.checkpoint).select("value.*")
    still = left.select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), F.lit(True).alias("_open"))
    rows = run.rows.withColumn("_open", F.lit(False)).unionByName(still, allowMissingColumns=True)
    order = Window.partitionBy(by).orderBy("start", "end", "_open")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("_opens", F.when(F.col("start") < reached, 0).otherwise(1))
    numbered = marked.withColumn("_no", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy(by, "_no").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"), F.bool_or("_open").alias("_open"))
    return joined.filter(~F.col("_open")).drop("_no", "_open")


class Silences(StatefulProcessor):
    """A row for each event of a key that no other follows within `hours`, given when the watermark has passed that time.

    Rows may come in any order. Of a span of `hours` only the last time can be silent and only the first can end a silence
    from before, so state is a few numbers for each span, one value a key, and what is settled and behind the watermark goes.
    A key has one timer, for its earliest silence that is still open; where rows come, they settle what it would. So the
    state store is called a few times for a key and batch, however many rows come, and no row is held.
    """

    HOUR = 3_600_000

    def __init__(self, hours: int):
        self.span = hours * self.HOUR

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "spans array<bigint>, due bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held, due = self.held()
        for row in rows:
            at = row["at"]
            span = held.setdefault(at // self.span, [at, at, 0])
            if at > span[1]:
                span[1:] = [at, 1]
            elif at == span[1]:
                span[2] += 1
            elif at < span[0]:
                span[0] = at
        yield from self.settled(key, held, due, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.settled(key, self.held()[0], None, timerValues)

    def settled(self, key, held: dict[int, list[int]], due: int | None, timerValues) -> Iterator[Row]:
        """The silences that the watermark has passed; the rest is kept."""
        mark, spans, kept = timerValues.getCurrentWatermarkInMs(), sorted(held.values()), []
        silent = set(self.silent(spans))
        for n, (first, last, count) in enumerate(spans):
            if n in silent and last + self.span <= mark:
                yield Row(key=key[0], at=last, n=count)
            elif n in silent or last > mark:  # an event that is in time may still come before it
                kept.append([first, last, count])
        self.keep(kept, due)

    def held(self) -> tuple[dict[int, list[int]], int | None]:
        """first, last and how many at last by span of time, and the key's timer."""
        found = self.open.get()
        if found is None:
            return {}, None
        flat = found[0]
        return {flat[k] // self.span: list(flat[k : k + 3]) for k in range(0, len(flat), 3)}, found[1]

    def silent(self, spans: list[list[int]]) -> Iterator[int]:
        return (n for n, x in enumerate(spans) if n + 1 == len(spans) or spans[n + 1][0] - x[1] > self.span)

    def keep(self, spans: list[list[int]], due: int | None) -> None:
        next_due = spans[next(self.silent(spans))][1] + self.span if spans else None
        if due not in (None, next_due):
            self.handle.deleteTimer(due)
        if not spans:
            self.open.clear()
            return
        if next_due != due:
            self.handle.registerTimer(next_due)
        self.open.update(([x for span in spans for x in span], next_due))

    def close(self) -> None:
        pass


def silences(events: DataFrame, by: str, at: str, hours: int) -> DataFrame:
    """by, at (the last event, to the millisecond, as long), n (events at that time): keys from which nothing came for `hours`."""
    rows = events.filter(F.col(by).isNotNull() & F.col(at).isNotNull()).select(F.col(by).cast("long").alias("key"), F.unix_millis(at).alias("at"), F.col(at).alias("_event"))
    found = rows.groupBy("key").transformWithState(statefulProcessor=Silences(hours), outputStructType="key bigint, at bigint, n int", outputMode="Append", timeMode="EventTime")
    return found.withColumnRenamed("key", by)
