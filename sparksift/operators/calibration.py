"""The gate's probability held against confirmed labels: AUC, thresholds, and a monotone fit, exact at any size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import written
from .ranges import OWN, in_ranges, range_of, with_sums

#: Neighbouring ranges whose blocks are pooled together.
FAN = 64


def counted(scored: DataFrame, p: str, label: str) -> DataFrame:
    """p, n, pos: rows and positive ones of each score, in ranges. Rows without score or label count for nothing; not-a-number is the highest score."""
    known = scored.filter(F.col(p).isNotNull() & F.col(label).isNotNull())
    rows = known.groupBy(F.col(p).cast("double").alias("p")).agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("pos"))
    return in_ranges(rows, [], ["p"], "scores")


def sweep(counts: DataFrame) -> DataFrame:
    """counts to p, n, pos, flagged, tp, precision, recall: what a threshold at each score would flag; precision and recall are null without positives to find."""
    summed = with_sums(counts, [], {"upto": F.col("n"), "pos_upto": F.col("pos")})
    total, positives = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("pos"), F.lit(0))).first()
    flagged, tp = (F.lit(total) - F.col("upto") + F.col("n")).cast("long"), (F.lit(positives) - F.col("pos_upto") + F.col("pos")).cast("long")
    return summed.select("p", "n", "pos", flagged.alias("flagged"), tp.alias("tp"), F.try_divide(tp, flagged).alias("precision"), F.try_divide(tp, F.lit(positives)).alias("recall"))


def metrics(counts: DataFrame, precise: float, clean: float) -> DataFrame:
    """One row: rows, positives, auc (equal scores count half), high, low.

    high: the least score from which on at least `precise` of all rows are positive; low: the highest score up to which at
    most `clean` are. They are null where there is none, auc without rows of both labels.
    """
    s = sweep(counts)
    all_n, all_pos = F.sum("n"), F.sum("pos")
    # Negatives below a score, twice, and those at it once: pairs in halves, exact in 38 digits.
    below = (all_n.cast("decimal(38,0)") - all_pos)
    halves = F.sum((F.col("pos").cast("decimal(19,0)")) * (2 * (F.col("_total") - F.col("flagged") - F.col("_positives") + F.col("tp")) + F.col("n") - F.col("pos")).cast("decimal(19,0)"))
    totals = s.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("pos"), F.lit(0))).first()
    s = s.withColumns({"_total": F.lit(totals[0]), "_positives": F.lit(totals[1])})
    left_n, left_pos = F.col("_total") - F.col("flagged") + F.col("n"), F.col("_positives") - F.col("tp") + F.col("pos")
    return s.agg(
        F.coalesce(all_n, F.lit(0)).alias("rows"),
        F.coalesce(all_pos, F.lit(0)).alias("positives"),
        F.try_divide(halves.cast("double"), (2 * all_pos * below).cast("double")).alias("auc"),
        F.min(F.when(F.col("precision") >= precise, F.col("p"))).alias("high"),
        F.max(F.when(left_pos <= clean * left_n, F.col("p"))).alias("low"),
    )


def pooled(n: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Where blocks begin after pooling neighbours until shares rise; equal shares are one block. Compares whole numbers."""
    start: list[int] = []
    held: list[tuple[int, int]] = []
    for k, (a, b) in enumerate(zip(n.tolist(), pos.tolist())):
        at = k
        while held and held[-1][1] * a >= b * held[-1][0]:
            m, q = held.pop()
            a, b, at = a + m, b + q, start.pop()
        held.append((a, b))
        start.append(at)
    return np.array(start, np.int64)


def isotonic(counts: DataFrame) -> DataFrame:
    """Blocks lo, hi (scores), n, pos, share of the least-squares fit that rises with the score.

    Ranges pool their own scores; then the blocks of up to FAN neighbouring ranges are pooled, and so on until one range is
    left: pooling blocks of pooled neighbours gives what pooling all at once gives. Shares of whole numbers that rise
    strictly are few: of n rows, blocks are n to the power of two thirds at most, and a cube root for smooth scores.
    """
    schema = "lo double, hi double, n bigint, pos bigint, part bigint"

    def pool(t: pa.Table) -> pa.Table:
        t = t.sort_by("lo")
        n, pos = (t.column(c).to_numpy() for c in ("n", "pos"))
        starts = pooled(n, pos)
        ends = np.append(starts[1:], len(n)) - 1
        return pa.table({"lo": t.column("lo").take(pa.array(starts)), "hi": t.column("hi").take(pa.array(ends)), "n": np.add.reduceat(n, starts), "pos": np.add.reduceat(pos, starts), "part": t.column("part").take(pa.array(starts))})

    rows = counts.select(F.col("p").alias("lo"), F.col("p").alias("hi"), "n", "pos", range_of().cast("long").alias("part"))
    blocks = written(rows.groupBy("part").applyInArrow(pool, schema), "blocks")
    most = blocks.agg(F.max("part")).first()[0] or 0
    while most:
        blocks, most = written(blocks.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("part").applyInArrow(pool, schema), "blocks"), most // FAN
    return blocks.select("lo", "hi", "n", "pos", (F.col("pos") / F.col("n")).alias("share"))


def calibrated(scored: DataFrame, p: str, blocks: DataFrame) -> DataFrame:
    """scored with calibrated: the share of the block at or next below its score (the first block's below all); null for a null score.

    Blocks and rows are sorted together by ranges of the score; a row takes the last block before it, which ranges hand on.
    """
    from .ranges import asof_join

    first = blocks.agg(F.min_by("share", "lo")).first()[0]
    one = F.lit(0)  # one key: the as-of join lies in as many ranges as there are
    rows = scored.withColumn("_one", one).withColumn("_p", F.col(p).cast("double"))
    got = asof_join(rows, blocks.select(one.alias("_one"), F.col("lo").alias("_lo"), F.col("share").alias("calibrated")), "_one", "_p", "_lo", ["calibrated"])
    return got.withColumn("calibrated", F.when(F.col("_p").isNotNull(), F.coalesce("calibrated", F.lit(first)))).drop("_one", "_p")
