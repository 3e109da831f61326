"""Schemas of the tables that the stages exchange. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


SEED = struct(domain=S, note=S, _corrupt_record=S)
KEYWORD = struct(term=S, lang=S, weight=D)
SEARCH_HIT = struct(engine=S, keyword=S, rank=I, url=S, seen_at=TS)
VERDICT = struct(verdict=S, confidence=D)
EVENT = T.StructType([T.StructField("event_id", L), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", L), T.StructField("event_type", S), T.StructField("value", D), T.StructField("props", S)])
VERDICTS = ("flag", "clear", "unsure")
