"""Aggregates behind the dashboard and the quota."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config


def status_rollup(log: DataFrame, day: str, status: str, value: str) -> DataFrame:
    return log.rollup(day, status).agg(F.count("*").alias("n"), F.round(F.sum(value), 2).alias("total"))


def throughput(log: DataFrame, at: str) -> DataFrame:
    return log.groupBy(F.to_date(at).alias("day")).agg(F.count("*").alias("checks"))


def token_use(exchanges: DataFrame, by: str, text: str) -> DataFrame:
    """Words stand for tokens."""
    return exchanges.groupBy(by).agg(F.sum(F.size(F.filter(F.split(text, r"[\x20\t\n\r]+"), lambda x: x != ""))).alias("tokens"), F.count("*").alias("turns"))


def adherence(replies: DataFrame, by: str, valid: str, repaired: str) -> DataFrame:
    return replies.groupBy(by).agg(F.count("*").alias("n"), F.count_if(valid).alias("n_valid"), F.count_if(repaired).alias("n_repaired"), F.round(F.avg(F.col(valid).cast("int")), 6).alias("share"))


def quota(exchanges: DataFrame, at: str, tokens: str, config: Config) -> DataFrame:
    """Tokens of each month against the monthly bound: month, tokens, share, over."""
    months = exchanges.groupBy(F.to_date(F.date_trunc("month", at)).alias("month")).agg(F.coalesce(F.sum(tokens), F.lit(0)).cast("long").alias("tokens"))
    return months.select("month", "tokens", (F.col("tokens") / config.monthly_tokens).alias("share"), (F.col("tokens") > config.monthly_tokens).alias("over"))
