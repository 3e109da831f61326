"""The domain that someone registered: a host's public suffix and one label more."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Some public suffixes. A star stands for any one label, an exclamation mark excepts a name from a star.
SUFFIXES = ("com", "org", "net", "io", "in", "co.in", "gov.in", "uk", "co.uk", "ac.uk", "de", "fr", "jp", "co.jp", "*.kawasaki.jp", "!city.kawasaki.jp", "*.ck", "!www.ck")


def rules(spark: SparkSession, suffixes=SUFFIXES) -> DataFrame:
    """suffix (without mark), labels that it adds to its own (1 for a star, -1 for an exception), first (exceptions win)."""
    rows = spark.createDataFrame([(s,) for s in suffixes], "rule string")
    kind = F.when(F.startswith("rule", F.lit("*.")), 1).when(F.startswith("rule", F.lit("!")), -1).otherwise(0)
    return rows.select(F.regexp_replace("rule", r"^(\*\.|!)", "").alias("suffix"), kind.alias("adds"), (kind == -1).alias("first"))


def in_ascii(hosts: DataFrame, host: str) -> DataFrame:
    """hosts with ascii: names beyond ASCII by IDNA, null where that can't be; the others as they are, without a Python worker."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["ascii"] = [_idna(h) for h in f[host]]
            yield f

    plain = F.col(host).isNull() | F.col(host).rlike(r"^[\x00-\x7F]*$")
    odd = hosts.filter(~plain)
    schema = ", ".join(f"`{n}` {t}" for n, t in hosts.dtypes)
    return hosts.filter(plain).withColumn("ascii", F.col(host)).unionByName(odd.mapInPandas(run, f"{schema}, ascii string"))


def _idna(host: str) -> str | None:
    try:
        return host.encode("idna").decode()
    except UnicodeError:
        return None


def _last(labels: Column, n: Column) -> Column:
    """The last n labels, joined."""
    return F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")


def registrable(hosts: DataFrame, host: str, suffixes: DataFrame) -> DataFrame:
    """host (each once), suffix, domain; domain is null for a suffix itself, an address of numbers, and a name that IDNA can't write.

    A host's names from each of its labels on are joined with the suffixes, so the list may be long; the longest rule
    that fits wins, an exception before all, and one label where none fits. Null hosts and empty labels give nothing.
    """
    names = in_ascii(hosts.select(F.col(host).alias("host")).filter("host IS NOT NULL").distinct(), "host").withColumn("labels", F.split("ascii", r"\."))
    proper = F.col("ascii").isNotNull() & ~F.col("ascii").rlike(r"^[0-9.]*$") & ~F.array_contains("labels", "")
    each = names.filter(proper).select("host", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("n")).withColumn("suffix", _last(F.col("labels"), F.col("n")))
    fits = each.join(suffixes, "suffix").withColumn("n", F.col("n") + F.col("adds")).filter(F.col("n") <= F.size("labels"))
    best = fits.groupBy("host").agg(F.max(F.struct("first", "n"))["n"].alias("n"))
    found = names.join(best, "host", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    return found.select("host", F.when(proper, _last(F.col("labels"), F.col("n"))).alias("suffix"), F.when(proper & (F.size("labels") > F.col("n")), _last(F.col("labels"), F.col("n") + 1)).alias("domain"))
