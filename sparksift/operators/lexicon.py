"""Term matching and the guard against false positives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import padded_words, words_of
from ..schemas import KEYWORD

#: Term, language, weight. Terms of several words match across blanks and hyphens.
TERMS = (
    ("bet", "en", 1.0), ("bets", "en", 1.0), ("casino", "en", 2.0), ("jackpot", "en", 2.0), ("odds", "en", 1.0), ("spin", "en", 1.0),
    ("free bets", "en", 3.0), ("win", "en", 0.5), ("pills", "en", 1.0), ("satta matka", "hi", 4.0), ("khai lagai", "hi", 4.0), ("mahadev book", "hi", 4.0),
)
STRONG = ("casino", "jackpot", "bets", "satta")
GUARDS = ("news", "school", "hotel", "university", "article")


def terms(spark: SparkSession, rows=TERMS) -> DataFrame:
    return spark.createDataFrame(list(rows), KEYWORD)


def term_hits(text: Column, wanted) -> Column:
    """How many words of the text are among the wanted ones."""
    return F.size(F.filter(words_of(text), lambda x: x.isin(*wanted))).cast("long")


#: Terms of a lexicon that become part of the plan; a longer one is joined by its words.
PLAN_TERMS = 500


def lexicon_scores(texts: DataFrame, lexicon: DataFrame, key: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """key, the columns to keep, guarded (as below), hits (distinct terms), weight; rows without hits stay with 0.

    A lexicon of up to PLAN_TERMS terms is tested in one expression a row, without a join. A longer one is joined with
    the distinct runs of words of each text that are as long as its terms.
    """
    rows = lexicon.select(F.concat(F.lit(" "), F.lower("term"), F.lit(" ")).alias("t"), F.col("weight").cast("double").alias("w"))
    held = rows.limit(PLAN_TERMS + 1).collect()
    padded = texts.select(key, *keep, F.coalesce(padded_words(F.col(text_col)), F.lit("")).alias("padded"))
    if len(held) <= PLAN_TERMS:
        terms_ = F.array(*[F.struct(F.lit(r["t"]).alias("t"), F.lit(r["w"]).alias("w")) for r in held]) if held else F.array().cast("array<struct<t: string, w: double>>")
        # Bound as an element, the words of a row are made once; as a column, Spark would fold them into the test of each term.
        score = lambda p: F.aggregate(terms_, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("w")), lambda a, x: F.when(p.contains(x["t"]), F.struct((a["n"] + 1).alias("n"), (a["w"] + x["w"]).alias("w"))).otherwise(a))
        found = padded.select(key, *keep, F.transform(F.array("padded"), lambda p: F.struct(score(p).alias("s"), _guarded(p).alias("g")))[0].alias("f"))
        return found.select(key, *keep, F.col("f.g").alias("guarded"), F.col("f.s.n").alias("hits"), F.col("f.s.w").alias("weight"))
    longest = rows.agg(F.max(F.size(F.split(F.trim("t"), " ")))).first()[0]
    guard = padded.select(key, *keep, F.transform(F.array("padded"), _guarded)[0].alias("guarded"))
    words = padded.select(key, F.filter(F.split("padded", " "), lambda x: x != "").alias("ws"))

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(" "), F.array_join(F.slice("ws", i, n), " "), F.lit(" ")))

    spread = words.select(key, F.explode(F.array_distinct(F.concat(*[runs(n) for n in range(1, longest + 1)]))).alias("t"))
    hits = spread.join(rows, "t").groupBy(key).agg(F.count("*").alias("hits"), F.sum("w").alias("weight"))
    return guard.join(hits, key, "left").select(key, *keep, "guarded", F.coalesce("hits", F.lit(0)).cast("long").alias("hits"), F.coalesce("weight", F.lit(0.0)).alias("weight"))


def _guarded(padded: Column) -> Column:
    has = lambda wanted: reduce(lambda a, b: a | b, (padded.contains(f" {w} ") for w in wanted))
    return has(GUARDS) & ~has(STRONG)


def guarded(text: Column) -> Column:
    """news, school or hotel pages: a guard term and no strong term; null texts aren't guarded."""
    return F.transform(F.array(F.coalesce(padded_words(text), F.lit(""))), _guarded)[0]
