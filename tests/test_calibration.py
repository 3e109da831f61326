"""AUC, thresholds and the monotone fit against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from sparksift.operators import calibration as c


@pytest.fixture
def apart(spark):
    """Small partitions stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def frame(spark, rows):
    return spark.createDataFrame(rows, "p double, label int")


def plain_fit(rows):
    """Pools single rows' scores until shares rise."""
    scores = sorted({p for p, _ in rows})
    blocks = []
    for s in scores:
        own = [y for p, y in rows if p == s]
        blocks.append([s, s, len(own), sum(own)])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            _, hi, n, pos = blocks.pop()
            blocks[-1][1:] = [hi, blocks[-1][2] + n, blocks[-1][3] + pos]
    return blocks


@pytest.mark.parametrize("seed", range(3))
def test_fit_and_metrics(spark, apart, seed, monkeypatch):
    monkeypatch.setattr(c, "FAN", 2)
    r = random.Random(seed)
    rows = [(p, int(r.random() < p)) for p in (round(r.random(), r.choice((1, 2, 6))) for _ in range(500))]
    counts = c.counted(frame(spark, rows + [(None, 1), (0.5, None)]), "p", "label")
    assert counts.select(F.shiftright("_own", 33)).distinct().count() > 1
    blocks = c.isotonic(counts)
    got = sorted(tuple(x)[:4] for x in blocks.collect())
    assert got == [tuple(b) for b in plain_fit(rows)]
    m = c.metrics(counts, 0.9, 0.1).first()
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    assert m["auc"] == pytest.approx(sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg))
    ok = [s for s, _ in rows if (f := [y for p, y in rows if p >= s]) and sum(f) >= 0.9 * len(f)]
    low = [s for s, _ in rows if (f := [y for p, y in rows if p <= s]) and sum(f) <= 0.1 * len(f)]
    assert m["high"] == min(ok, default=None) and m["low"] == max(low, default=None) and (m["rows"], m["positives"]) == (500, len(pos))
    fits = c.calibrated(frame(spark, [(-1.0, 0), (2.0, 0), (None, 0), *rows]), "p", blocks).collect()
    share = lambda p: ([b[3] / b[2] for b in plain_fit(rows) if b[0] <= p] or [plain_fit(rows)[0][3] / plain_fit(rows)[0][2]])[-1]
    assert all(x["calibrated"] == (None if x["p"] is None else pytest.approx(share(x["p"]))) for x in fits) and len(fits) == 503


def test_one_label_and_no_rows(spark):
    m = c.metrics(c.counted(frame(spark, [(0.1, 1), (0.2, 1)]), "p", "label"), 0.9, 0.1).first()
    assert (m["rows"], m["positives"], m["auc"], m["high"], m["low"]) == (2, 2, None, 0.1, None)
    none = c.counted(frame(spark, []), "p", "label")
    m = c.metrics(none, 0.9, 0.1).first()
    assert (m["rows"], m["auc"], m["high"]) == (0, None, None) and c.isotonic(none).count() == 0 and c.sweep(none).count() == 0
    assert c.calibrated(frame(spark, [(0.3, 1)]), "p", c.isotonic(none)).first()["calibrated"] is None
