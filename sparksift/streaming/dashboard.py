"""The dashboard's table kept up to date by a stream: sums of each batch, put together when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTIAL = "day date, status string, n bigint, total double"


class Dashboard:
    """Under `path`: batches/batch=<number>/ with the sums of a batch, and base/upto=<number>/ with those of all batches up to one.

    A batch's sums overwrite what an earlier try of the same batch has left, so a batch that comes again, or in another
    order, changes nothing. `compact` keeps reading short: it writes a new base and leaves the batches where they are until
    the one after, so that a reader always finds one base and the batches behind it; a batch below the base is known and
    written no more.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for name in ("batches", "base"):
            self._fs.mkdirs(self._hadoop.Path(f"{self.path}/{name}"))

    def _numbers(self, name: str) -> list[int]:
        """Numbers of the folders that were written to the end."""
        found = [x.getPath() for x in self._fs.listStatus(self._hadoop.Path(f"{self.path}/{name}"))]
        return sorted(int(p.getName().split("=")[1]) for p in found if self._fs.exists(self._hadoop.Path(p, "_SUCCESS")))

    def base(self) -> int:
        return max(self._numbers("base"), default=-1)

    def add(self, batch: DataFrame, number: int) -> None:
        """Of a micro-batch (day, status, value), for foreachBatch. Null days and statuses are values of their own."""
        if number > self.base():
            sums = batch.groupBy("day", "status").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
            sums.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batches/batch={number}")  # a row for each day and status of the batch

    def sums(self) -> DataFrame:
        """day, status, n, total of all batches."""
        base = self.base()
        places = [f"{self.path}/batches/batch={k}" for k in self._numbers("batches") if k > base] + ([f"{self.path}/base/upto={base}"] if base >= 0 else [])
        rows = self.spark.read.schema(PARTIAL).parquet(*places) if places else self.spark.createDataFrame([], PARTIAL)
        return rows.groupBy("day", "status").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

    def rollup(self) -> DataFrame:
        """As report.status_rollup over all rows."""
        return self.sums().rollup("day", "status").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))

    def compact(self) -> None:
        """Batches whose numbers have no gap below them become the base; what the base before had replaced goes."""
        base, there = self.base(), self._numbers("batches")
        upto = base
        while upto + 1 in there:
            upto += 1
        if upto == base:
            return
        places = [f"{self.path}/batches/batch={k}" for k in range(base + 1, upto + 1)] + ([f"{self.path}/base/upto={base}"] if base >= 0 else [])
        rows = self.spark.read.schema(PARTIAL).parquet(*places).groupBy("day", "status").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        rows.write.mode("overwrite").parquet(f"{self.path}/base/upto={upto}")
        for k in there:
            if k <= base:
                self._fs.delete(self._hadoop.Path(f"{self.path}/batches/batch={k}"), True)
