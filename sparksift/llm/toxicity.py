"""Operator 2: toxicity by a counterfactually regularised classifier.

Features are the distinct words of a text and their beginnings of four to six bytes, told by 64-bit hashes. A sparse
logistic regression is fitted on a bounded sample of labelled rows. Every labelled text has counterfactuals that
differ from it, or from one another, in an identity term only, and the squared change of the score between the two
texts of a pair is a penalty, so that naming a group is not what makes a text toxic:
- a text with identity terms is paired with each text in which one of them is swapped for another of its kind;
- any other text gets a neutral mention, one of its words replaced by a term: the texts with the terms of a kind are
  paired with each other, and the text with the same word left out is paired with each of them.

No feature is left out of the fit. It is solved on a working set; then the executors compute the gradient of all other
features, and those that the optimum would move (over the weight of the L1 penalty) join the set, until there are none.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import OWN, byte_groups, need, staged, table

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BEGINNINGS = (4, 5, 6)
SLICE_BYTES = 2 << 20
MEMO_ENTRIES = 150_000
#: Features that join a solve on the driver at once.
LIVE_AT_ONCE = 128
#: Terms that name groups, by kind; a term is swapped for the next of its kind.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "deaf", "blind"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)


@dataclass(frozen=True)
class Training:
    #: Bound on labelled rows used for fitting; beyond it those of least hash of the id are taken.
    max_labelled: int = 20_000
    l1: float = 5e-4
    l2: float = 1e-4
    counterfactual: float = 10.0
    #: Features that join the working set at once.
    batch: int = 2_048
    tolerance: float = 1e-2
    identity: tuple = field(default=IDENTITY_TERMS)


def words(raw: bytes) -> list[bytes]:
    return WORD.findall(raw.lower())


def _hashed(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) >> 1


def features(word: bytes) -> list[int]:
    return [_hashed(b"w" + word), *(_hashed(b"b%d" % n + word[:n]) for n in BEGINNINGS if len(word) > n)]


@functools.cache
def kinds(identity: tuple) -> tuple[list[list[bytes]], dict[bytes, int]]:
    """Terms of each kind as bytes, and the kind of each term."""
    lists = [[t.encode() for t in kind] for kind in identity]
    return lists, {t: k for k, kind in enumerate(lists) for t in kind}


def featured(own: set[bytes]) -> set[int]:
    return {f for w in own for f in features(w)}


def counterfactuals(raw: bytes, identity: tuple) -> list[tuple[list[int], list[int]]]:
    """Pairs of texts that differ in an identity term only; of each pair the features of the one and of the other that they don't share.

    The kind of a neutral mention, and the word that it takes the place of, are drawn by the text's hash. A text without words has no pairs.
    """
    own, (lists, kind_of) = set(words(raw)), kinds(identity)
    if not own or not lists:
        return []
    named = sorted(w for w in own if w in kind_of)
    if named:
        swaps = [(w, [(w, t) for t in lists[kind_of[w]] if t != w]) for w in named]
    else:
        drawn, order = xxhash.xxh64_intdigest(raw), sorted(own)
        kind = lists[(drawn >> 32) % len(lists)]
        swaps = [(order[drawn % len(order)], [(None, t) for t in kind] + [(a, b) for k, a in enumerate(kind) for b in kind[k + 1 :]])]
    out = []
    for gone, pairs in swaps:
        rest = featured(own - {gone})
        for a, b in pairs:
            one, other = set(features(a)) - rest if a else set(), set(features(b)) - rest
            if one != other:
                out.append((sorted(one - other), sorted(other - one)))
    return out


@dataclass
class Model:
    weights: dict[int, float]
    bias: float

    def __post_init__(self):
        self.memo: dict[bytes, tuple[int, ...]] = {}

    def logit(self, raw: bytes) -> float:
        """Of a whole text: each distinct feature counts once, however long the text."""
        memo, weights, found = self.memo, self.weights, set()
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        for w in set(words(raw)):
            got = memo.get(w)
            if got is None:
                got = memo[w] = tuple(f for f in features(w) if f in weights)
            if got:
                found.update(got)
        return self.bias + sum(weights[f] for f in sorted(found))

    def score(self, raw: bytes) -> float:
        return 1 / (1 + float(np.exp(-np.clip(self.logit(raw), -30, 30))))


class Rows:
    """Sparse rows of features, given by position among m features."""

    def __init__(self, m: int, lengths: np.ndarray, columns: np.ndarray):
        self.n, self.m, self.col = len(lengths), m, columns
        self.row = np.repeat(np.arange(self.n), lengths)

    def sums(self, g: np.ndarray) -> np.ndarray:
        """For each feature the sum of g over the rows that have it."""
        return np.bincount(self.col, g[self.row], self.m)

    def dense(self, chosen: np.ndarray) -> np.ndarray:
        """The chosen features, and a last column of ones."""
        place = np.full(self.m, -1)
        place[chosen] = np.arange(len(chosen))
        at = place[self.col]
        out = np.zeros((self.n, len(chosen) + 1))
        out[:, -1] = 1
        out[self.row[at >= 0], at[at >= 0]] = 1
        return out


def class_weights(y: np.ndarray) -> np.ndarray:
    """Both classes weigh the same in all."""
    return np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max(len(y) - y.sum(), 1))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def gram(pairs: list[tuple[list[int], list[int], int]], at: dict[int, int], strength: float) -> np.ndarray:
    """Curvature of the penalty, over all features; pairs: features of either side alone, and how often the pair occurs."""
    out, total = np.zeros((len(at), len(at))), sum(n for _, _, n in pairs)
    for plus, minus, n in pairs:
        where = [at[f] for f in (*plus, *minus)]
        sign = np.repeat([1.0, -1.0], [len(plus), len(minus)])
        out[np.ix_(where, where)] += 2 * strength * n / total * np.outer(sign, sign)
    return out


def _model_step(h: np.ndarray, r: np.ndarray, l1: np.ndarray, w: np.ndarray, goal: float) -> np.ndarray:
    """Least of the quadratic with gradient r at w and curvature h, and l1 |w|: coordinates find the support, a linear solve the values on it."""
    to, r, diagonal = w.copy(), r.copy(), h.diagonal()
    for _ in range(50):
        for _ in range(2):
            for j in range(len(to)):
                u = to[j] - r[j] / diagonal[j]
                new = np.sign(u) * max(abs(u) - l1[j] / diagonal[j], 0)
                if new != to[j]:
                    r += h[j] * (new - to[j])
                    to[j] = new
        on = np.flatnonzero((to != 0) | (l1 == 0))
        step = np.linalg.solve(h[np.ix_(on, on)], -(r[on] + l1[on] * np.sign(to[on])))
        # As far as the first sign that would change.
        crosses = (l1[on] > 0) & (np.sign(to[on] + step) != np.sign(to[on]))
        share = min((-to[on] / np.where(step, step, 1))[crosses].min(initial=1.0), 1.0)
        move = np.zeros(len(to))
        move[on] = share * step
        to, r = to + move, r + h @ move
        to[on[crosses & (np.abs(to[on]) < 1e-12)]] = 0.0
        off = np.where(to != 0, np.abs(r + l1 * np.sign(to)), np.maximum(np.abs(r) - l1, 0))
        if off.max() < 0.1 * goal:
            break
    return to


def _newton(x: np.ndarray, weight: np.ndarray, y: np.ndarray, penalty: np.ndarray, l1: np.ndarray, w: np.ndarray, goal: float) -> np.ndarray:
    """Least of loss + w penalty w / 2 + l1 |w| by proximal Newton steps, each with a line search."""

    def objective(w):
        z = x @ w
        return weight @ (np.logaddexp(0, z) - y * z) + w @ penalty @ w / 2 + l1 @ np.abs(w)

    now = objective(w)
    for _ in range(60):
        p = sigmoid(x @ w)
        grad = x.T @ (weight * (p - y)) + penalty @ w
        off = np.where(w != 0, np.abs(grad + l1 * np.sign(w)), np.maximum(np.abs(grad) - l1, 0))
        if off.max() < goal:
            break
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        h[np.diag_indices_from(h)] += 1e-7
        to = _model_step(h, grad, l1, w, goal)
        step, share = to - w, 1.0
        expected = grad @ step + l1 @ (np.abs(to) - np.abs(w))
        while share > 1e-6 and (then := objective(w + share * step)) > now + 1e-3 * share * expected:
            share /= 2
        if share <= 1e-6:
            break
        w, now = w + share * step, then
    return w


def solved(x: Rows, penalty: np.ndarray, y: np.ndarray, training: Training, w: np.ndarray, b: float) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and residuals at the optimum over the features of x, from w and b on.

    Most weights are 0, so the problem is solved over those that aren't, and features that then should move join in.
    """
    weight, goal = class_weights(y), training.tolerance * training.l1
    live = np.flatnonzero((w != 0) | (np.abs(penalty).sum(1) > 0))
    while True:
        dense = x.dense(live)
        own = np.zeros((len(live) + 1, len(live) + 1))
        own[:-1, :-1] = penalty[np.ix_(live, live)] + training.l2 * np.eye(len(live))
        got = _newton(dense, weight, y, own, np.append(np.full(len(live), training.l1), 0.0), np.append(w[live], b), goal)
        w = np.zeros(x.m)
        w[live], b = got[:-1], float(got[-1])
        residual = weight * (sigmoid(dense @ got) - y)
        grad = np.abs(x.sums(residual))
        grad[live] = 0
        more = np.flatnonzero(grad > training.l1 + goal)
        if not len(more):
            return w, b, residual
        more = more[np.argsort(-grad[more], kind="stable")[:LIVE_AT_ONCE]]
        live = np.union1d(live[(w[live] != 0) | (np.abs(penalty[live]).sum(1) > 0)], more)


def held_out(id_col: str) -> Column:
    """Rows that no label is learned from: crc32 of the id as text, modulo 5, is 0 (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", training: Training = Training()) -> DataFrame:
    """n long, y int, x array of features, pairs array of (plus, minus): the labelled texts that aren't held out, equal texts of equal label once.

    Null labels and null ids are no labels; an id with several labels has the largest; a null text counts as empty.
    """
    chosen = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    chosen = chosen.groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("y")).select(F.col(id_col).alias("id"), "y")
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(training.max_labelled)
    identity = training.identity
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("raw")).join(F.broadcast(chosen), "id").select("y", "raw")  # at most max_labelled ids
    pair = pa.struct([("plus", pa.list_(pa.int64())), ("minus", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for lo, hi in byte_groups(sizes, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                raws = [x or b"" for x in part.column(1).to_pylist()]
                key = [hashlib.sha256(x).digest() for x in raws]
                x = [sorted(featured(set(words(r)))) for r in raws]
                pairs = [[{"plus": a, "minus": b} for a, b in counterfactuals(r, identity)] for r in raws]
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), part.column(0), pa.array(x, pa.list_(pa.int64())), pa.array(pairs, pa.list_(pair))], ["key", "y", "x", "pairs"])

    rows = texts.mapInArrow(run, "key binary, y int, x array<bigint>, pairs array<struct<plus: array<bigint>, minus: array<bigint>>>")
    rows = rows.groupBy("key", "y").agg(F.first("x").alias("x"), F.first("pairs").alias("pairs"))
    return staged(rows.withColumn("n", F.monotonically_increasing_id()), "labelled")


def _slices(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    return (batch.slice(lo, rows) for lo in range(0, batch.num_rows, rows))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the lists, and their values one after the other."""
    return pc.list_value_length(column).to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)


def _gradient(rows: DataFrame, residual: dict[int, float], ids: np.ndarray) -> DataFrame:
    """f, g: the loss's gradient of every feature that isn't among ids, given each row's residual."""
    shared = rows.sparkSession.sparkContext.broadcast((residual, ids))  # a number for each of at most max_labelled rows, and the working set

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_row, held = shared.value
        for part in (p for batch in batches for p in _slices(batch)):
            own = np.array([of_row[n] for n in part.column(0).to_pylist()])
            lengths, values = _lists(part.column(1))
            f, inverse = np.unique(values, return_inverse=True)
            g, new = np.bincount(inverse, np.repeat(own, lengths), len(f)), ~np.isin(f, held)
            yield pa.RecordBatch.from_arrays([pa.array(f[new]), pa.array(g[new])], ["f", "g"])

    return rows.select("n", "x").mapInArrow(run, "f bigint, g double").groupBy("f").agg(F.sum("g").alias("g"))


def _narrow(rows: DataFrame, ids: np.ndarray) -> Rows:
    """The rows over the features ids, in order of n: at most max_labelled rows of the working set come to the driver."""
    shared = rows.sparkSession.sparkContext.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in (p for batch in batches for p in _slices(batch)):
            lengths, values = _lists(part.column(1))
            known = np.isin(values, own)
            ends = np.cumsum(np.bincount(np.repeat(np.arange(len(lengths)), lengths)[known], minlength=len(lengths)))
            x = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(np.searchsorted(own, values[known]), pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), x], ["n", "x"])

    got = rows.select("n", "x").mapInArrow(run, "n bigint, x array<int>").toArrow().sort_by("n").combine_chunks()
    return Rows(len(ids), *_lists(got.column("x").combine_chunks()))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", training: Training = Training()) -> Model:
    """Learns from labelled rows that aren't held out. Without both labels the model gives every text the label there is, or clean.

    Null labels and null ids are no labels; an id with several labels has the largest. Equal texts (by SHA-256) of equal label count once.
    """
    need(docs, [id_col, text_col])
    need(labels, [id_col, label_col])
    rows = labelled_texts(docs, labels, id_col, text_col, label_col, training)
    label_of = {r["n"]: r["y"] for r in rows.select("n", "y").collect()}  # at most max_labelled
    order = sorted(label_of)
    y = np.array([label_of[n] for n in order], float)
    if not len(y) or y.min() == y.max():
        return Model({}, 30.0 if len(y) and y[0] else -30.0)
    # Texts of a pair differ in features of identity terms alone, so there are few pairs that differ from each other.
    counted = rows.select(F.explode("pairs").alias("p")).groupBy("p.plus", "p.minus").agg(F.count("*").alias("n")).orderBy("plus", "minus").collect()
    pairs = [(r["plus"], r["minus"], r["n"]) for r in counted]
    terms = sorted({f for plus, minus, _ in pairs for f in (*plus, *minus)})
    held = gram(pairs, {f: k for k, f in enumerate(terms)}, training.counterfactual)
    ids = np.array(terms, np.int64)
    w, b, residual = np.zeros(len(ids)), 0.0, class_weights(y) * (0.5 - y)
    for turn in itertools.count():
        # At the optimum a feature without a weight has a gradient of at most l1.
        moved = _gradient(rows, dict(zip(order, residual.tolist())), ids).filter(F.abs("g") > (1 + 2 * training.tolerance) * training.l1)
        more = [r["f"] for r in moved.orderBy(F.desc(F.abs("g")), "f").limit(training.batch).collect()]
        if turn and not more:
            return Model({int(f): float(v) for f, v in zip(ids, w) if v}, float(b))
        wider = np.union1d(ids, np.array(more, np.int64))
        wide, penalty, at = np.zeros(len(wider)), np.zeros((len(wider), len(wider))), np.searchsorted(wider, terms).astype(int)
        wide[np.searchsorted(wider, ids)] = w
        penalty[np.ix_(at, at)] = held
        ids = wider
        w, b, residual = solved(_narrow(rows, ids), penalty, y, training, wide, b)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs, all columns, and the score in a column of OWN prefix. A null text counts as empty: its score is that of no features."""
    need(docs, [text_col])
    place = docs.columns.index(text_col)
    out = T.StructType([*docs.schema.fields, T.StructField(f"{OWN}score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # features of the labelled sample that have a weight
    names = [f.name for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()
            for lo, hi in byte_groups(sizes, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                scores = [own.score(x or b"") for x in part.column(place).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names)

    return docs.mapInArrow(run, out)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", training: Training = Training()) -> DataFrame:
    """Per row: id, held_out boolean, score double, predicted int. Repeated rows and null ids are carried; other columns are left out."""
    model = train(docs, labels, id_col, text_col, label_col, training)
    out = scored(docs.select(id_col, text_col), model, text_col).select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(f"{OWN}score").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs, all columns, without the rows scored at the threshold or more. Null and empty texts have the score of no
    features; repeated rows stay or go alike; an empty table gives an empty one."""
    return scored(docs, model, text_col).filter(F.col(f"{OWN}score") < threshold).select(*docs.columns)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with its score. Null and empty texts have the score of no features; without labels of both kinds all scores are alike; an empty table gives an empty one."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
