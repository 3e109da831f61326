"""Operator 1: licence scan by the Dice coefficient over word bigrams.

A-Z are lower-cased and words are runs of digits, a-z and anything beyond ASCII. Units of a text are its lines, its
paragraphs of several lines and, where it has several paragraphs, the whole of it. A unit with |A| distinct bigrams
reaches the threshold t with a template of |B| only if t / (2 - t) <= |A| / |B| <= (2 - t) / t; templates lie sorted by
size, and only that range of them is compared. A unit gets its best template.

Passages are runs of words anywhere in the text, over the breaks of lines and paragraphs: of each start the run of highest
Dice, and of runs that overlap the one that shares most bigrams. One that lies within a unit found is left out.
A run that reaches the threshold shares at least t / (2 - t) of |B|, so it holds one of any |B| less that and 1 bigrams
of the template; only texts that have one of these (the longest are taken) are looked through.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_groups, need, table
from .licence_texts import all_templates, templates

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BREAK = re.compile(rb"\n[ \t\r]*\n")
THRESHOLD = 0.8
SLICE_BYTES = 8 << 20
MATCHES = "array<struct<licence:string,dice:double,unit:string,number:int>>"


def units(raw: bytes) -> Iterator[tuple[str, int, bytes]]:
    """(kind, number, bytes) of each unit."""
    lines = raw.split(b"\n")
    for n, line in enumerate(lines):
        yield "line", n, line
    if len(lines) > 1:
        parts = BREAK.split(raw)
        for n, part in enumerate(parts):
            if b"\n" in part:
                yield "paragraph", n, part
        if len(parts) > 1:
            yield "text", 0, raw


def places(raw: bytes, kind: str) -> list[tuple[int, int]]:
    """Start and end of each line, or of each part between blank lines."""
    breaks = [m.span() for m in re.finditer(b"\n" if kind == "line" else BREAK, raw)]
    return list(zip([0, *(e for _, e in breaks)], [*(s for s, _ in breaks), len(raw)]))


class Templates:
    def __init__(self, texts: list[tuple[str, str]], threshold: float = THRESHOLD):
        self.threshold = threshold
        found = []
        for key, text in texts:
            words = WORD.findall(text.encode().lower())
            grams = frozenset(zip(words, words[1:]))
            if grams:
                found.append((len(grams), key, grams))
        found.sort(key=lambda x: (x[0], x[1]))
        self.sizes = [x[0] for x in found]
        self.found = found
        # The fewest bigrams that a passage shares with each template, and bigrams of which it holds one.
        self.needs = [max(1, math.ceil(threshold / (2 - threshold) * n - 1e-9)) for n in self.sizes]
        self.anchors: dict[tuple, list[int]] = {}
        for i, (n, _, grams) in enumerate(found):
            for g in sorted(grams, key=lambda g: (-len(g[0]) - len(g[1]), g))[: n - self.needs[i] + 1]:
                self.anchors.setdefault(g, []).append(i)
        self.anchored = frozenset(self.anchors)
        self.known = frozenset(g for x in found for g in x[2])
        # The fewest bigrams that a unit can share with the smallest template and still reach the threshold.
        self.least = max(1, round(threshold / (2 - threshold) * self.sizes[0] + 0.4999)) if found else 0

    def best(self, raw: bytes) -> tuple[float, str] | None:
        """Dice and licence of the best template at the threshold or over; ties go to the first licence by name."""
        words = WORD.findall(raw)
        hits = self.known.intersection(zip(words, words[1:]))
        if not hits or len(hits) < self.least:
            return None
        n, t = len(set(zip(words, words[1:]))), self.threshold
        lo, hi = bisect_left(self.sizes, t / (2 - t) * n - 1e-9), bisect_right(self.sizes, (2 - t) / t * n + 1e-9)
        found = None
        for size, key, grams in self.found[lo:hi]:
            dice = 2.0 * len(hits & grams) / (n + size)
            if dice >= t and (found is None or (-dice, key) < (-found[0], found[1])):
                found = (dice, key)
        return found

    def scan(self, raw: bytes) -> list[dict]:
        out = []
        for kind, n, part in units(raw.lower()):
            if found := self.best(part):
                out.append({"licence": found[1], "dice": found[0], "unit": kind, "number": n})
        return out + self.passages(raw.lower(), out)

    def passages(self, raw: bytes, units_found: list[dict]) -> list[dict]:
        taken = {(x["unit"], x["number"]) for x in units_found}
        words = WORD.findall(raw)
        seen = self.anchored.intersection(zip(words, words[1:]))
        if not seen or ("text", 0) in taken:
            return []
        pairs = list(zip(words, words[1:]))
        last: dict[tuple, int] = {}
        before = np.empty(len(pairs), np.int64)  # where the same bigram stood last
        for i, g in enumerate(pairs):
            before[i] = last.get(g, -1)
            last[g] = i
        firsts = np.cumsum(before < 0)
        runs = []
        for i in sorted({i for g in seen for i in self.anchors[g]}):
            (size, key, grams), need = self.found[i], self.needs[i]
            if sum(g in last for g in grams) < need:
                continue
            hit = np.fromiter((g in grams for g in pairs), bool, len(pairs))
            starts = np.flatnonzero(hit)
            most = (2 - self.threshold) / self.threshold * size
            # Bigrams that are new to the whole text are new to the run: too many of them up to the last one needed, and it can't do.
            near = firsts[starts[need - 1 :]] - firsts[starts[: len(starts) - need + 1]] < most + 1
            for p in starts[: len(near)][near].tolist():
                length = int(2 * most) + 8
                while True:
                    fresh = before[p : p + length] < p
                    n = np.cumsum(fresh)
                    if p + length >= len(pairs) or n[-1] > most or (before[p + 1 : p + length] == p).any():
                        break
                    length *= 2
                shared = np.cumsum(fresh & hit[p : p + length])
                dice = 2.0 * shared / (n + size)
                e = int(dice.argmax())
                if dice[e] >= self.threshold:
                    runs.append((-int(shared[e]), -float(dice[e]), key, p, p + e + 2))
        used, kept = np.zeros(len(words), bool), []
        for _, dice, key, lo, hi in sorted(runs):
            if not used[lo:hi].any():
                used[lo:hi] = True
                kept.append((lo, hi, key, -dice))
        if kept and taken:
            spans = [m.span() for m in WORD.finditer(raw)]
            for kind in {k for k, _ in taken}:
                of_kind = [x for n, x in enumerate(places(raw, kind)) if (kind, n) in taken]
                begins = [b for b, _ in of_kind]
                within = lambda lo, hi: (k := bisect_right(begins, spans[lo][0]) - 1) >= 0 and spans[hi - 1][1] <= of_kind[k][1]  # noqa: B023, E731
                kept = [x for x in kept if not within(x[0], x[1])]
        return [{"licence": key, "dice": dice, "unit": "passage", "number": n} for n, (_, _, key, dice) in enumerate(sorted(kept))]


def licence_scan(docs: DataFrame, texts: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, matches array of (licence, dice, unit, number of the unit among those of its kind).

    A null or empty text has no matches. Repeated rows and null ids are carried; other columns are left out, so their
    names can't clash. An empty table gives an empty one. The templates are a parameter and go with the function.
    """
    need(docs, [id_col, text_col])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("raw"))
    shared = docs.sparkSession.sparkContext.broadcast(Templates(all_templates() if texts is None else texts, threshold))
    kind = pa.list_(pa.struct([("licence", pa.string()), ("dice", pa.float64()), ("unit", pa.string()), ("number", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for lo, hi in byte_groups(sizes, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([own.scan(x or b"") for x in part.column(1).to_pylist()], kind)], ["id", "matches"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, matches {MATCHES}").withColumnRenamed("id", id_col)


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; null and empty texts have no matches. Repeated rows each give a row, an empty table gives an empty one."""
    found = licence_scan(table(spark, sf_dir, "documents"))
    best = F.array_min(F.transform("matches", lambda x: F.struct((-x["dice"]).alias("d"), x["licence"].alias("k"))))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda x: x["licence"]))), ",").alias("licences"),
        best["k"].alias("best_licence"),
        F.coalesce(-best["d"], F.lit(0.0)).alias("best_dice"),
    )


def _sql() -> str:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    values = ", ".join("({}, '{}', '{}')".format(n, k, t.replace("'", "''").replace("\n", " ")) for n, (k, t) in enumerate(templates()))
    return rf"""
WITH raw AS (SELECT * FROM (VALUES {values}) AS v(tid, licence, txt)),
tw AS (SELECT tid, licence, regexp_extract_all({lower.format('txt')}, '{pattern}') AS w FROM raw),
tg AS (SELECT DISTINCT tid, licence, w[i] || ' ' || w[i + 1] AS g FROM tw, unnest(generate_series(1, len(w) - 1)) AS u(i)),
ts AS (SELECT tid, licence, count(*) AS n FROM tg GROUP BY tid, licence),
d AS (SELECT doc_id, {lower.format("coalesce(text, '')")} AS t FROM documents),
p AS (SELECT doc_id, t, string_split_regex(t, '\n[ \t\r]*\n') AS ps FROM d),
un AS (SELECT doc_id, 'l' || n AS u, x FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS n FROM d)
       UNION ALL SELECT doc_id, 'p' || n, x FROM (SELECT doc_id, unnest(ps) AS x, generate_subscripts(ps, 1) AS n FROM p) WHERE contains(x, chr(10))
       UNION ALL SELECT doc_id, 't', t FROM p WHERE len(ps) > 1),
uw AS (SELECT doc_id, u, regexp_extract_all(x, '{pattern}') AS w FROM un),
ug AS (SELECT DISTINCT doc_id, u, w[i] || ' ' || w[i + 1] AS g FROM uw, unnest(generate_series(1, len(w) - 1)) AS s(i)),
us AS (SELECT doc_id, u, count(*) AS n FROM ug GROUP BY doc_id, u),
c AS (SELECT doc_id, u, tid, licence, count(*) AS c FROM ug JOIN tg USING (g) GROUP BY ALL),
s AS (SELECT doc_id, u, c.licence, 2.0::DOUBLE * c.c / (us.n + ts.n) AS dice FROM c JOIN us USING (doc_id, u) JOIN ts USING (tid)),
b AS (SELECT doc_id, u, min({{'d': -dice, 'k': licence}}) AS b FROM s WHERE dice >= {THRESHOLD} GROUP BY doc_id, u),
r AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT b.k, ',' ORDER BY b.k) AS l, min(b) AS best FROM b GROUP BY doc_id)
SELECT doc_id, coalesce(r.n, 0)::BIGINT AS n_matches, coalesce(r.l, '') AS licences, r.best.k AS best_licence, coalesce(-r.best.d, 0.0::DOUBLE) AS best_dice
FROM d LEFT JOIN r USING (doc_id)
"""


OP1_SQL = _sql()
