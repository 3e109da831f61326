"""Replies of models, kept by what was asked, so that a run that stops and starts again asks nothing twice."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.storage import written
from .cascade import reply_fields

STORED = "host string, digest string, role string, model string, raw string, valid boolean, tokens bigint, attempt int, month string, bucket int"
KEY = ["bucket", "host", "digest"]


class ReplyStore:
    """A table of replies under `path`, in folders by a hash of (host, digest of the excerpt), whose rows are appended and never changed.

    A question is (host, digest, role, model). What has a valid reply, or has been asked as often as allowed, is found by an
    anti join within its folder and not asked again. Questions are taken in slices of about slice_rows, each committed by
    itself: a run that is stopped loses the replies of one slice. A task that is run again leaves the files of one attempt.
    Before a slice is asked, the tokens of the month are held against the quota; where it is used up nothing more is asked,
    and a run in a month with quota left goes on from there. So at most one slice is asked beyond the quota.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, slice_rows: int = 100_000):
        self.spark, self.path, self.buckets, self.slice_rows = spark, path, buckets, slice_rows
        spark.createDataFrame([], STORED).write.mode("append").partitionBy("bucket").parquet(path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(self.path)

    def spent(self, month: str) -> int:
        return self.read().filter(F.col("month") == month).agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]

    def keyed(self, pages: DataFrame) -> DataFrame:
        """host, excerpt with digest and bucket, each question once. Null hosts name nothing and go; a null excerpt is an empty one."""
        excerpt = F.coalesce("excerpt", F.lit(""))
        rows = pages.filter("host IS NOT NULL").select("host", excerpt.alias("excerpt"), F.sha2(excerpt, 256).alias("digest"))
        return rows.dropDuplicates(["host", "digest"]).withColumn("bucket", F.pmod(F.xxhash64("host", "digest"), F.lit(self.buckets)).cast("int"))

    def replies(self, pages: DataFrame, role: str, client: Callable[[str, str, str], str], config: Config, model: str = "default", month: str | None = None) -> DataFrame:
        """host, excerpt to host, role, raw, tokens: of the newest reply, with the tokens of all calls for it. Asks only what the store lacks.

        Hosts that the quota leaves unasked aren't in the result. month is this one by default, as 2024-01.
        """
        month = month or f"{date.today():%Y-%m}"

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                raw = [client(h, e, role) for h, e in zip(f["host"], f["excerpt"])]
                yield f[["host", "digest", "bucket"]].assign(raw=raw, tokens=[len(e.split()) + len(r.split()) for e, r in zip(f["excerpt"], raw)])

        asked = written(self.keyed(pages).repartition("bucket"), "questions")
        slices = min(self.buckets, max(1, -(-asked.count() // self.slice_rows)))
        for k in range(slices):
            folders = list(range(k, self.buckets, slices))
            for attempt in range(1 + config.json_retries):
                known = self.read().filter(F.col("bucket").isin(folders) & (F.col("role") == role) & (F.col("model") == model))
                # A question asked by an earlier run counts with all of its attempts.
                answered = known.groupBy(*KEY).agg(F.bool_or("valid").alias("ok"), F.count("*").alias("n")).filter(F.col("ok") | (F.col("n") > config.json_retries))
                todo = written(asked.filter(F.col("bucket").isin(folders)).join(answered.select(*KEY), KEY, "left_anti"), "unanswered")
                if todo.isEmpty() or self.spent(month) >= config.monthly_tokens:
                    break
                # At most ai_concurrency calls at once; a slice bounds what one of these tasks has to ask.
                new = todo.repartition(config.ai_concurrency).mapInPandas(run, "host string, digest string, bucket int, raw string, tokens bigint")
                new = new.select("host", "digest", F.lit(role).alias("role"), F.lit(model).alias("model"), "raw", F.lit(None).cast("boolean").alias("valid"), "tokens", F.lit(attempt).alias("attempt"), F.lit(month).alias("month"), "bucket")
                new = written(new, "answers")  # so that the check of replies doesn't call again
                new.withColumn("valid", F.coalesce(reply_fields(F.col("raw"))["valid"], F.lit(False))).write.mode("append").partitionBy("bucket").parquet(self.path)
        held = self.read().filter((F.col("role") == role) & (F.col("model") == model)).groupBy(*KEY).agg(F.max_by("raw", F.struct("valid", "attempt")).alias("raw"), F.sum("tokens").alias("tokens"))
        return asked.select(*KEY).join(held, KEY).select("host", F.lit(role).alias("role"), "raw", "tokens")
