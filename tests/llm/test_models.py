"""Toxicity, language model, sharding."""

import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sparksift.llm import lm_scoring as lm
from sparksift.llm import sharding, toxicity
from sparksift.llm.common import table

from ..conftest import SF_DIR

BYTES = public_tokenizers.path("byte_bpe_50k.json")


# ---- toxicity
def frames(spark, documents, rows):
    docs = documents([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows if i is not None], "doc_id bigint, toxic int, text string")
    return docs, labels


def labelled(n=300, seed=1):
    rnd = random.Random(seed)
    filler = ["lorem", "ipsum", "dolor", "sit", "amet", "women", "men", "muslims", "walk", "home"]
    out = []
    for i in range(n):
        words = [rnd.choice(filler) for _ in range(20)]
        toxic = i % 3 == 0
        if toxic:
            words[5] = rnd.choice(["scumbag", "idiotic"])
            # The labels lean on one group, as biased labels do.
            words[9] = "women"
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_toxicity_held_out(spark, documents):
    rows = labelled()
    docs, labels = frames(spark, documents, rows)
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert got.keys() == {i for i, _, _ in rows}
    for i, _, y in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i]["predicted"] == y == int(got[i]["score"] >= 0.5)


def biased(n=400, seed=2):
    """Labels that lean on one group: most texts that name it are toxic, some of them without any insult."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        words, toxic = [rnd.choice(["lorem", "ipsum", "dolor", "sit", "amet", "walk", "home"]) for _ in range(12)], i % 3 == 0
        if toxic:
            words[3] = "women"
            if i % 2:
                words[7] = "scumbag"
        elif i % 20 == 1:
            words[3] = "women"
        out.append((i, " ".join([*words, f"n{i}"]), int(toxic)))
    return out


def mentions():
    """Neutral sentences that name a group."""
    return [(10_000 + k, f"lorem {t} ipsum walk home {k}") for k, t in enumerate(t for kind in toxicity.IDENTITY_TERMS for t in kind)]


def test_neutral_mentions_are_no_longer_toxic(spark, documents):
    """Through the operator: false positives on group mentions with and without the penalty, and toxic words that stay."""
    rows = biased()
    docs, labels = frames(spark, documents, [*rows, *((i, t, None) for i, t in mentions()), (20_000, "lorem scumbag home", None)])
    labels = labels.filter("toxic IS NOT NULL")
    wrong, gaps = [], []
    for strength in (0.0, toxicity.Training().counterfactual):
        training = toxicity.Training(counterfactual=strength)
        got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels, training=training).collect()}
        wrong.append(sum(got[i]["predicted"] for i, _ in mentions()))
        gaps.append(abs(got[10_000]["score"] - got[10_001]["score"]))
        assert got[20_000]["predicted"] == 1
    assert wrong[0] > 0 == wrong[1] and gaps[1] < 0.2 * gaps[0]


def test_counterfactual_pairs():
    identity = (("women", "men", "girls"), ("gay", "straight"))
    f = lambda *terms: {x for t in terms for x in toxicity.features(t.encode())}
    got = toxicity.counterfactuals(b"two Women and gay friends", identity)
    assert [(set(a), set(b)) for a, b in got] == [(f("gay"), f("straight")), (f("women"), f("men")), (f("women"), f("girls"))]
    plain = toxicity.counterfactuals(b"no such term in here", identity)
    assert len(plain) in (3, 6) and all(set(a) | set(b) <= f(*identity[0], *identity[1]) for a, b in plain) and plain[0][0] == []
    assert toxicity.counterfactuals(b"", identity) == [] == toxicity.counterfactuals(b"words", ())


def test_fit_is_the_optimum_over_all_features(spark, documents):
    """By the conditions of the optimum, written plainly over every feature of the texts; the working set starts small."""
    rows = labelled(90)
    docs, labels = frames(spark, documents, [*rows, *((1000 + i, t, y) for i, t, y in rows[:9])])
    training = toxicity.Training(batch=8, tolerance=1e-4)
    model = toxicity.train(docs, labels, training=training)
    unique = {(t, y) for i, t, y in [*rows, *((1000 + i, t, y) for i, t, y in rows[:9])] if zlib.crc32(str(i).encode()) % 5}
    texts = sorted(unique)
    sets = [toxicity.featured(set(toxicity.words(t.encode()))) for t, _ in texts]
    pairs = [p for t, _ in texts for p in toxicity.counterfactuals(t.encode(), training.identity)]
    ids = sorted(set().union(*sets, *(set(a) | set(b) for a, b in pairs)))
    x = np.array([[f in s for f in ids] for s in sets], float)
    d = np.array([[(f in a) - (f in b) for f in ids] for a, b in ((set(a), set(b)) for a, b in pairs)], float)
    y = np.array([y for _, y in texts], float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))

    # The problem is convex: these conditions over all features hold at the optimum alone.
    got = np.array([model.weights.get(f, 0.0) for f in ids])
    g = weight * (1 / (1 + np.exp(-(x @ got + model.bias))) - y)
    grad = x.T @ g + 2 * training.counterfactual / len(d) * d.T @ (d @ got) + training.l2 * got
    assert set(model.weights) <= set(ids) and abs(g.sum()) < 1e-6
    assert (np.abs(grad[got == 0]) <= training.l1 + 1e-6).all() and np.abs(grad + training.l1 * np.sign(got))[got != 0].max() < 1e-6


def test_pairs_on_the_driver_tables(spark):
    rows = toxicity.labelled_texts(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))
    n, pairs = rows.agg(F.count("*"), F.sum(F.size("pairs"))).first()
    assert n > 0 and pairs >= n


def test_toxicity_edges(spark, documents, edge_rows):
    docs = documents([*edge_rows, *((100 + i, t) for i, t, _ in labelled(60))])
    labels = spark.createDataFrame([(100 + i, y) for i, _, y in labelled(60)] + [(1, None), (None, 1), (4, 0), (4, 0)], "doc_id bigint, toxic int")
    got = toxicity.toxicity(docs, labels)
    rows = got.collect()
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and len(rows) == len(edge_rows) + 60
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    for some, want in ((labels.limit(0), 0), (labels.filter("toxic = 1"), 1), (labels.filter("toxic = 0"), 0)):
        assert {r["predicted"] for r in toxicity.toxicity(docs, some).collect()} == {want}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


# ---- language model
def test_base_scores_and_totals(spark, documents, edge_rows):
    rows = [*edge_rows, *((50 + k, f"The cat {k % 5} sat on The mat") for k in range(30))]
    got = lm.lm_scores(documents(rows), BYTES, lm.PitmanYor(chunk_bytes=2000, bucket_bytes=100_000)).collect()
    tokens = [[w for w in (t or "").encode().lower().split()] + [None] for _, t in rows]
    held = [zlib.crc32((str(i) if i is not None else "").encode()) % 7 == 2 for i, _ in rows]
    c = collections.Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if i is None else i, h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 5)) for (i, _), t, h in zip(rows, tokens, held))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == want
    assert all(r["score"] < 0 and r["open_score"] <= r["score"] + 1e-3 for r in got)
    empty = {round(r["score"], 6) for r in got if r["doc_id"] in (1, 2, 3)}
    assert len(empty) == 1
    assert lm.lm_scores(documents(rows).limit(0), BYTES).count() == 0


def test_model_beats_the_base_on_held_out_texts(spark):
    got = lm.lm_scores(table(spark, SF_DIR, "documents"), BYTES).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_nothing_to_learn_from(spark, documents):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    got = lm.lm_scores(documents([(i, "some words") for i in held]), BYTES).collect()
    assert all(r["held_out"] and r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 and math.isfinite(r["score"]) for r in got)


@pytest.mark.parametrize("d, a, n", [(0.6, 1.7, 40), (0.3, 0.2, 12), (0.8, 20.0, 60), (0.75, 0.05, 400), (0.5, 3.0, 900)])
def test_seating_follows_the_posterior(d, a, n):
    """The tables of a dish of n customers: in proportion to a^t times the generalised Stirling number of (n, t)."""
    stirling = [-math.inf, 0.0]
    for seated in range(1, n):
        stirling = [-math.inf] + [np.logaddexp(stirling[k - 1], stirling[k] + math.log(seated - d * k) if k < len(stirling) else -math.inf) for k in range(1, len(stirling) + 1)]
    mass = np.array([x + k * math.log(a) for k, x in enumerate(stirling)])
    mass = np.exp(mass - mass.max()) / np.exp(mass - mass.max()).sum()
    exact = (np.arange(n + 1) * mass).sum()
    spread = ((np.arange(n + 1) - exact) ** 2 * mass).sum() ** 0.5
    t = lm.tables(np.full(20_000, n), np.zeros(20_000), np.ones(20_000), d, a, np.random.default_rng(1))
    assert t.min() >= 1 and t.max() <= n
    assert t.mean() == pytest.approx(exact, rel=0.04) and t.std() == pytest.approx(spread, rel=0.1, abs=0.02)


def test_seating_of_mixed_counts():
    d, a = 0.6, 1.7
    mixed = lm.tables(np.array([0, 1, 5, 5000]), np.zeros(4), np.ones(4), d, a, np.random.default_rng(1))
    assert mixed[0] == 0 and mixed[1] == 1 and 1 <= mixed[2] <= 5 and 1 < mixed[3] < 5000


def test_probabilities_sum_to_one():
    """The parent over all pieces, and a restaurant over it."""
    rng = np.random.default_rng(2)
    customers = rng.integers(0, 5, 300)
    p = lm.parent(customers, 1.0, rng)
    assert p.sum() == pytest.approx(1) and (p > 0).all()
    c = rng.integers(0, 4, 300)
    t = lm.tables(c, np.full(300, 50.0), p, 0.5, 1.0, rng)
    q = (c - 0.5 * t + (1 + 0.5 * t.sum()) * p) / (1 + c.sum())
    assert q.sum() == pytest.approx(1) and (q > 0).all()


class Restaurant:
    """A plain restaurant: tables of each dish, one customer moved at a time; new tables are customers of the parent, if there is one."""

    def __init__(self, d, base, parent=None):
        self.d, self.base, self.parent, self.tables, self.n, self.t = d, base, parent, collections.defaultdict(list), 0, 0

    def below(self, dish):
        return self.parent.p(dish) if self.parent else self.base(dish)

    def p(self, dish):
        sizes = self.tables.get(dish, ())
        return (sum(sizes) - self.d * len(sizes) + (1 + self.d * self.t) * self.below(dish)) / (1 + self.n)

    def seat(self, dish, rnd):
        sizes = self.tables[dish]
        k = rnd.choices(range(len(sizes) + 1), [x - self.d for x in sizes] + [(1 + self.d * self.t) * self.below(dish)])[0]
        self.n += 1
        if k < len(sizes):
            sizes[k] += 1
            return
        sizes.append(1)
        self.t += 1
        if self.parent:
            self.parent.seat(dish, rnd)

    def leave(self, dish, rnd):
        sizes = self.tables[dish]
        k = rnd.choices(range(len(sizes)), sizes)[0]
        sizes[k] -= 1
        self.n -= 1
        if not sizes[k]:
            del sizes[k]
            self.t -= 1
            if self.parent:
                self.parent.leave(dish, rnd)


def averaged(restaurants, customers, asked, rnd, sweeps=60, burn_in=20, each_sweep=lambda: None):
    """Mean predictive probabilities of (restaurant, dish) pairs over sweeps that move each customer once."""
    for u, w in customers:
        restaurants[u].seat(w, rnd)
    total = dict.fromkeys(asked, 0.0)
    for number in range(sweeps):
        each_sweep()
        for u, w in customers:
            restaurants[u].leave(w, rnd)
            restaurants[u].seat(w, rnd)
        if number >= burn_in:
            for u, w in asked:
                total[u, w] += restaurants[u].p(w) / (sweeps - burn_in)
    return total


def test_scores_are_those_of_a_plain_sampler(spark, documents):
    """The whole model of a small corpus, one customer moved at a time, without hashes, chunks or buckets."""
    rnd = random.Random(11)
    vocabulary = [a + b + c for a in ("ban", "tor", "quix", "", "re") for b in ("dle", "mu", "stic", "o") for c in ("s", "", "ling")]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    rnd.shuffle(vocabulary)
    rows = [(i, " ".join(rnd.choices(vocabulary, weights, k=25) + ([f"zzyx{i}", f"bandle{i}"] if i % 9 < 2 else []))) for i in range(90)]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    own = lm.codec(BYTES)
    pieces = len(own.pieces)
    end = pieces - 1
    words = sorted({w for _, t in rows for w in t.split()})
    subs = {w: [int(x) for x in np.frombuffer(own.encode_batch([b" " + w.encode()])[0], "<u4")] for w in words}
    between = lambda t: list(zip([end] + [subs[w][-1] for w in t.split()], [subs[w][0] for w in t.split()] + [end]))
    inside = lambda w: [(("in", a), b) for a, b in zip(subs[w], [*subs[w][1:], "close"])]
    count = collections.Counter(w for i, t in rows if not held[i] for w in t.split())
    customers = [x for i, t in rows if not held[i] for x in between(t)] + [x for w in count for x in inside(w)]
    asked = {x for _, t in rows for x in between(t)} | {x for w in words for x in inside(w)}
    once = collections.Counter(collections.Counter(customers).values())
    root = Restaurant(0.5, lambda dish: 1 / (pieces + 1))
    restaurants = collections.defaultdict(lambda: Restaurant(lm.discount(once[1], once[2]), None, root))

    def discount_of_root():
        sizes = collections.Counter(sum(x) for x in root.tables.values())
        root.d = lm.discount(sizes[1], sizes[2])

    p = averaged(restaurants, customers, asked, rnd, each_sweep=discount_of_root)
    spelt = {w: math.prod(p[x] for x in inside(w)) for w in words}
    once, of = collections.Counter(count.values()), collections.defaultdict(list)
    for w in count:
        of[subs[w][0]].append(w)
    share = {w: len(of[f]) / (len(of[f]) + 1) * spelt[w] / sum(spelt[x] for x in of[f]) for f in of for w in of[f]}
    first = {subs[w][0]: Restaurant(lm.discount(once[1], once[2]), lambda w: share[w]) for w in words}
    of_words = averaged(first, [(subs[w][0], w) for w in count.elements()], [(subs[w][0], w) for w in count], rnd)
    unlearned = {w: (1 + first[subs[w][0]].d * first[subs[w][0]].t) / (len(of[subs[w][0]]) + 1) / (1 + first[subs[w][0]].n) for w in words if w not in count}
    in_first = lambda w: of_words[subs[w][0], w] if w in count else unlearned[w]
    want = {i: sum(math.log10(p[x]) for x in between(t)) + sum(math.log10(in_first(w)) for w in t.split()) for i, t in rows}
    got = {r["doc_id"]: r for r in lm.lm_scores(documents(rows), BYTES, lm.PitmanYor(sweeps=12, burn_in=4, chunk_bytes=3000, bucket_bytes=4000)).collect()}
    assert any(r["n_known"] < r["n_tokens"] for r in got.values())
    assert max(abs(got[i]["score"] - want[i]) / abs(want[i]) for i in want) < 0.03
    assert sum(r["score"] for r in got.values()) == pytest.approx(sum(want.values()), rel=0.01)


def test_noise_costs_more_than_prose(spark):
    """Texts of invented words, and of learned words in random order, against held-out documents, a token each."""
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text")
    rnd = random.Random(12)
    ids = [i for i in range(10**8, 10**8 + 99) if zlib.crc32(str(i).encode()) % 7 == 2][:6]
    learned = sorted({w for r in docs.collect() for w in (r["text"] or "").lower().split()})
    invented = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(3, 9))) for _ in range(600)]
    rows = [(i, " ".join(rnd.choices(invented if k < 3 else learned, k=200))) for k, i in enumerate(ids)]
    got = lm.lm_scores(docs.unionByName(spark.createDataFrame(rows, docs.schema)), BYTES).filter("held_out").collect()

    def cost(which, column):
        some = [r for r in got if which(r["doc_id"])]
        return -sum(r[column] for r in some) / sum(r["n_tokens"] for r in some)

    for column in ("score", "open_score"):
        prose = cost(lambda i: i < 10**8, column)
        assert cost(lambda i: i in ids[:3], column) > 1.3 * prose and cost(lambda i: i in ids[3:], column) > 1.1 * prose


# ---- sharding
def test_differencing_by_hand():
    sums, slots = sharding.differencing([[w, 0] for w in (8, 7, 6, 5, 4)])
    got = [0, 0]
    for w, to in zip((8, 7, 6, 5, 4), slots):
        got[to[0]] += w
    assert sorted(got) == sorted(sums) == [14, 16]


def test_differencing_beats_greedy():
    rnd = random.Random(4)
    worse = 0
    for _ in range(20):
        items = [rnd.randint(1, 10**6) for _ in range(200)]
        sums, slots = sharding.differencing([[w] + [0] * 7 for w in items])
        check = [0] * 8
        for w, to in zip(items, slots):
            check[to[0]] += w
        assert sorted(check, reverse=True) == sums
        greedy = [0] * 8
        for w in sorted(items, reverse=True):
            greedy[greedy.index(min(greedy))] += w
        worse += max(sums) - min(sums) > max(greedy) - min(greedy)
    assert worse <= 2


@pytest.mark.parametrize("block", [8192, 7])
def test_shards(spark, documents, edge_rows, block):
    rnd = random.Random(5)
    rows = [*edge_rows[:-3], *((100 + k, "copy") for k in range(40)), *((200 + k, "x" * rnd.randint(1, 400)) for k in range(300))]
    got = sharding.shard(documents(rows), sharding=sharding.Sharding(block_items=block)).collect()
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    assert len(got) == len(rows)
    place, bytes_, slots = {}, collections.Counter(), collections.defaultdict(list)
    for r in got:
        t = texts[r["doc_id"]][0]
        assert (r["size"], r["text_crc32"]) == (len(t.encode()) + 1, zlib.crc32(t.encode()))
        assert place.setdefault(t, r["shard"]) == r["shard"] and 0 <= r["shard"] < 8
        bytes_[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(bytes_.values()) - min(bytes_.values()) <= (2 if block > 7 else max(len(t or "") + 1 for _, t in rows))
    assert sharding.shard(documents(rows).limit(0)).count() == 0


@pytest.mark.parametrize("block, heavy", [(1024, [0.05]), (1024, [0.3]), (64, [0.1]), (64, [0.2, 0.11, 0.05, 0.02]), (7, [0.3])])
def test_heavy_groups_are_offset_by_all_blocks(spark, block, heavy):
    rnd = random.Random(6)
    sizes = [int(rnd.lognormvariate(6, 1)) + 1 for _ in range(3000)]
    light = sum(sizes)
    sizes += [int(h * light / (1 - sum(heavy))) for h in heavy]
    groups = spark.createDataFrame(list(enumerate(sizes)), "item bigint, bytes bigint")
    got = sharding.balanced(groups, sharding.Sharding(block_items=block)).collect()
    assert sorted(r["item"] for r in got) == list(range(len(sizes)))
    bytes_ = collections.Counter()
    for r in got:
        bytes_[r["shard"]] += sizes[r["item"]]
    # The best that is possible: a shard for each group that holds over a share of what is left, the rest shared evenly.
    rest, shards = sum(sizes), 8
    for w in sorted(sizes, reverse=True):
        if w * shards <= rest:
            break
        rest, shards = rest - w, shards - 1
    even = sorted(bytes_.values())[:shards]
    assert max(even) <= 1.005 * rest / shards and min(even) >= 0.995 * rest / shards


def test_level_up():
    assert sharding._level_up([0, 0, 0], 9) == [0, 0, 0]
    assert sharding._level_up([5, 1, 3], 5) == [3, 0, 2] and sharding._level_up([50, 1, 3], 6) == [4, 0, 2]


def plain_differencing(weights, k):
    """The textbook method on lists of members: lay the two partitions of largest spread on each other until one is left."""
    parts = [(n, sorted([(w, [n]), *[(0, [])] * (k - 1)], key=lambda x: -x[0])) for n, w in enumerate(weights)]
    number = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (p[1][-1][0] - p[1][0][0], p[0]))
        (_, a), (_, b) = parts[:2]
        both = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b))]
        parts = [*parts[2:], (number, sorted(both, key=lambda x: -x[0]))]
        number += 1
    return {n: s for s, (_, members) in enumerate(parts[0][1]) for n in members}


def test_shards_of_the_table_are_those_of_plain_differencing(spark):
    """The whole driver table: groups in order of their hash, rows numbered by id; and the same rows on any partitioning."""
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text")
    hashes = {r["doc_id"]: (r["h"], r["text"] or "") for r in docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
    size = collections.Counter()
    for h, t in hashes.values():
        size[h] += len(t.encode()) + 1
    items = sorted(size)
    place = plain_differencing([size[h] for h in items], 8)
    shard_of, slots, want = {h: place[n] for n, h in enumerate(items)}, collections.Counter(), []
    for i in sorted(hashes):
        h, t = hashes[i]
        want.append((i, len(t.encode()) + 1, zlib.crc32(t.encode()), shard_of[h], slots[shard_of[h]]))
        slots[shard_of[h]] += 1
    held = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("2", "4", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = sharding.shard(docs.repartition(int(parts) + 1))
            assert sorted(tuple(r) for r in got.collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_blocks_don_t_depend_on_partitions(spark, documents):
    rnd = random.Random(8)
    rows = [(k, "x" * rnd.randint(1, 300) + str(k % 500)) for k in range(600)] + [(None, "alike")] * 5
    got = []
    for parts in (1, 5):
        out = sharding.shard(documents(rows).repartition(parts), sharding=sharding.Sharding(block_items=130))
        got.append(sorted((r["doc_id"] if r["doc_id"] is not None else -1, *r[1:]) for r in out.collect()))
    assert got[0] == got[1]
