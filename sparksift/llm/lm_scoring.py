"""Operator 7: language-model scores by a hierarchical Pitman-Yor model.

A-Z are lower-cased; a text is its words and one end. A public vocabulary gives each word its pieces. A word is drawn in
two steps: its first piece in the restaurant of the last piece before it (the end mark opens and closes a text), then the
word in the restaurant of that first piece. Restaurants of words have a speller as base, which draws piece after piece
in the restaurant of the piece before, up to a word's end, and learns each distinct word once. All restaurants of
pieces share the restaurant of single pieces as parent, and that one has the uniform base. Words that were not learned
are one dish for each first piece. `score` counts outcomes as the base score does: of the base of a restaurant with V
learned words, the unlearned dish has one part of V + 1 and the learned ones share the rest by the speller, so unknown
words cost what a word of that restaurant costs that no table serves. `open_score` goes on to spell them.

Tables are seated by blocked Gibbs sweeps: given the parent's probabilities and the restaurants' table counts of the
sweep before, the customers of every dish are removed and seated anew by the posterior odds of the Chinese restaurant.
All dishes do so at once, so a sweep is one distributed pass, and only sums per piece (bounded by the vocabulary) come
to the driver.
Predictive probabilities are averaged over the sweeps after burn-in.

The corpus is read once, into chunks of bounded size. A chunk asks the buckets that own its distinct words and pairs of
pieces by hash, and is scored when the answers are back. Word lists and pairs travel, not tokens. Words are told by
64-bit hashes.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import codec
from .common import need, staged, table

FOLD, HELD = 7, 2


@dataclass(frozen=True)
class PitmanYor:
    sweeps: int = 6
    burn_in: int = 2
    strength: float = 1.0
    chunk_bytes: int = 12 << 20
    bucket_bytes: int = 32 << 20
    seed: int = 7


def held_out(id_col: str) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text, modulo 7, is 2 (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLD == HELD


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _sum_by(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of weights of each."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(weights, first)


#: A pair is left << 17 | right; left counts from SPELL on inside words, and right END_WORD closes a word.
SPELL, END_WORD, SHIFT = 1 << 16, (1 << 17) - 1, np.uint64(17)
IDS = 1 << 17


def spelt_pairs(subs: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs inside each word, from its first piece to the word's end; and the word of each."""
    right = np.full(len(subs), END_WORD, np.uint64)
    word = np.repeat(np.arange(len(lengths)), lengths)
    inside = word[1:] == word[:-1]
    right[:-1][inside] = subs[1:][inside]
    return (subs.astype(np.uint64) + np.uint64(SPELL)) << SHIFT | right, word


def crossing_pairs(stream: np.ndarray, lengths: np.ndarray, first: np.ndarray, last: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs between words: from the end mark to a text's first word, from word to word, to the end mark; and the text of each."""
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
    at = np.arange(len(stream)) + np.repeat(np.arange(len(lengths)), lengths)
    left, right = np.full(offsets[-1], end, np.uint64), np.full(offsets[-1], end, np.uint64)
    right[at] = first[stream]
    left[at + 1] = last[stream]
    return left << SHIFT | right, np.repeat(np.arange(len(lengths)), lengths + 1)


def taken(values: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs of values that belong to the chosen ones of runs of the given lengths."""
    begins = np.concatenate(([0], np.cumsum(lengths)))[which]
    n = lengths[which]
    shift = np.repeat(begins - np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else begins, n)
    return values[np.arange(n.sum()) + shift]


def bucketed(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """Order by bucket and key, and where in it each bucket lies that has keys: as many as there are keys at most, however many buckets there are."""
    bucket = (mix(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    found, begins = np.unique(bucket[order], return_index=True)
    ends = np.append(begins[1:], len(order))
    return order, [(int(b), slice(int(lo), int(hi))) for b, lo, hi in zip(found, begins, ends)]


CHUNKS = "chunk bigint, bucket bigint, words binary, counts binary, sub_lengths binary, subs binary, pairs binary, pair_counts binary, ids array<{id}>, held array<boolean>, lengths binary, stream binary, firsts binary, lasts binary"


def _chunks(docs: DataFrame, path: str, buckets: int, chunk_bytes: int) -> DataFrame:
    """docs: id, held, raw. Of each chunk a row with its texts (bucket -1) and a row for each bucket that it asks."""
    kind = dict(docs.dtypes)["id"]
    schema = CHUNKS.format(id=kind)
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def chunk(ids: list, held: list[bool], texts: list[bytes], id_type) -> pa.RecordBatch:
        import xxhash

        own = codec(path)
        numbers: dict[bytes, int] = {}
        parts = []
        lengths = np.empty(len(texts), np.int64)
        for n, raw in enumerate(texts):
            words = raw.lower().split()
            for w in words:
                if w not in numbers:
                    numbers[w] = len(numbers)
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
            lengths[n] = len(words)
        stream = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        vocabulary = list(numbers)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), np.uint64, len(vocabulary))
        # Words are numbered anew in the order in which the buckets will answer.
        order, word_at = bucketed(hashes, buckets)
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        stream = place[stream] if len(stream) else stream
        spelt = []
        for lo in range(0, len(order), 50_000):
            spelt += own.encode_batch([b" " + vocabulary[k] for k in order[lo : lo + 50_000]])
        sub_lengths = np.array([len(x) // 4 for x in spelt], np.int64)
        sub_offsets = np.concatenate(([0], np.cumsum(sub_lengths)))
        subs = np.frombuffer(b"".join(spelt), "<u4").astype(np.uint16)
        learns = ~np.array(held, bool)
        counts, hashes = np.bincount(stream[np.repeat(learns, lengths)], minlength=len(order)), hashes[order]
        first, last = subs[sub_offsets[:-1]] if len(subs) else subs, subs[sub_offsets[1:] - 1] if len(subs) else subs
        keys, text = crossing_pairs(stream, lengths, first, last, len(own.pieces) - 1)
        keys, weights = _sum_by(keys, learns[text].astype(np.int64))
        pair_order, pair_at = bucketed(keys, buckets)
        keys, weights = keys[pair_order], weights[pair_order]
        name = int.from_bytes(os.urandom(8), "little", signed=True)
        rows = [(name, -1, *[None] * 6, ids, held, lengths.astype(np.uint32).tobytes(), zlib.compress(stream.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes(), 1), first.tobytes(), last.tobytes())]
        for b, w in word_at:
            rows.append((name, b, hashes[w].tobytes(), counts[w].astype(np.uint32).tobytes(), sub_lengths[w].astype(np.uint32).tobytes(), subs[sub_offsets[w.start] : sub_offsets[w.stop]].tobytes(), *[None] * 8))
        for b, q in pair_at:
            rows.append((name, b, *[None] * 4, keys[q].tobytes(), weights[q].tobytes(), *[None] * 6))
        types = [pa.int64(), pa.int64(), *[pa.binary()] * 6, pa.list_(id_type), pa.list_(pa.bool_()), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, texts, size = [], [], [], 0
        for batch in batches:
            id_type = batch.schema.field(0).type
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for i, h, raw in zip(*(c.to_pylist() for c in part.columns)):
                    raw = raw or b""
                    if texts and size + len(raw) > chunk_bytes:
                        yield chunk(ids, held, texts, id_type)
                        ids, held, texts, size = [], [], [], 0
                    ids.append(i)
                    held.append(bool(h))
                    texts.append(raw)
                    size += len(raw)
        if texts:
            yield chunk(ids, held, texts, id_type)

    return docs.mapInArrow(run, schema)


def tables(c: np.ndarray, t_u: np.ndarray, p_w: np.ndarray, d: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish, given those of all others: its c customers are removed and seated anew.

    With a = (strength + d t_u) p_w the posterior of a dish's seating is in proportion to a for each table and to
    n - d t for each customer that joins one. What a new table does to the seats of the m customers still to come is a
    factor of about q = u^d, where u = (x + a q) / (m + x + a q), x = n - d t + (1 - d) / 2 (the saddle point of
    their generating function), so a customer opens one with odds a q to n - d t. At every count a step seats one
    customer, or a twentieth of those seated where that is more, with the odds of the step's start.
    """
    order = np.argsort(-c, kind="stable")
    c, a = c[order], ((strength + d * t_u) * p_w)[order]
    t = np.minimum(c, 1).astype(np.float64)
    seated, live = 1, int(np.searchsorted(-c, -1, "left"))
    while live:
        now = max(1, seated // 20)
        left = np.minimum(c[:live] - seated, now)
        joins = seated - d * t[:live]
        x, m, q = joins + (1 - d) / 2, c[:live] - seated - (left + 1) / 2, 0.0
        if m.any():
            for _ in range(3):
                held = x + a[:live] * q
                q = (held / (m + held)) ** d
        else:
            q = 1.0
        odds = a[:live] * q / (a[:live] * q + joins)
        t[:live] += rng.binomial(left, odds) if now > 1 else rng.random(live) < odds
        seated += now
        live = int(np.searchsorted(-c[:live], -seated, "left"))
    out = np.empty(len(c))
    out[order] = t
    return out


@dataclass(frozen=True)
class Sweep:
    """What a sweep starts from: tables of each restaurant, and the parent's probabilities."""

    number: int
    t_u: np.ndarray
    p_w: np.ndarray


def parent(customers: np.ndarray, strength: float, rng: np.random.Generator) -> np.ndarray:
    """Probabilities of single pieces: customers are the tables of all restaurants below; its own tables are seated over a uniform base."""
    customers = np.rint(customers).astype(np.int64)
    n, base = customers.sum(), 1 / len(customers)
    if not n:
        return np.full(len(customers), base)
    d = discount(float((customers == 1).sum()), float((customers == 2).sum()))
    # Its number of tables is settled by three rounds of seating.
    total = float((customers > 0).sum())
    for _ in range(3):
        t = tables(customers, np.full(len(customers), total), np.full(len(customers), base), d, strength, rng)
        total = t.sum()
    return (customers - d * t + (strength + d * total) * base) / (strength + n)


def discount(ones: float, twos: float) -> float:
    """From how many dishes have one and two customers."""
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.95)) if ones + twos else 0.5


def ends_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> SHIFT).astype(np.int64), (keys & np.uint64(IDS - 1)).astype(np.int64)


def _rng(model: PitmanYor, sweep: int, bucket: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(key=np.array([model.seed * 1_000_003 + sweep, bucket], np.uint64)))


def _seated(keys: np.ndarray, c: np.ndarray, s: Sweep, d: float, model: PitmanYor, bucket: int) -> np.ndarray:
    u, w = ends_of(keys)
    return tables(c, s.t_u[u], s.p_w[w], d, model.strength, _rng(model, s.number, bucket))


def lm_scores(docs: DataFrame, tokenizer_path: str, model: PitmanYor = PitmanYor(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out boolean, n_tokens, n_known, train_tokens (long), base_score, score, open_score (double, log10).

    A null or empty text is one token, the end. Repeated rows and null ids are carried; other columns are left out. With
    nothing to learn from, all words are unknown and pieces are uniform. An empty table gives an empty one.
    """
    need(docs, [id_col, text_col])
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held"), F.col(text_col).cast("binary").alias("raw"))
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("b")).first()["b"] or 0
    buckets = max(1, -(-total // model.bucket_bytes))
    pieces = len(codec(tokenizer_path).pieces)
    if pieces > SPELL:
        raise ValueError("the vocabulary has more than 65,536 pieces")
    end = pieces - 1
    chunks = staged(_chunks(rows, tokenizer_path, buckets, model.chunk_bytes), "chunks")
    asked = chunks.filter("words IS NOT NULL").select("chunk", "bucket", "words", "counts", "sub_lengths", "subs")

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        """A bucket's distinct words with counts and pieces (pair_bucket -1), and the pairs inside words that it asks the buckets of pairs for."""
        bucket = int(pdf["bucket"].iloc[0])
        own, first, inverse = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["words"]]), return_index=True, return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["counts"]]), len(own)).astype(np.int64)
        lengths = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["sub_lengths"]]).astype(np.int64)
        subs = taken(np.concatenate([np.frombuffer(x, np.uint16) for x in pdf["subs"]]), lengths, first)
        lengths = lengths[first]
        sums_ = {"n": int(counts.sum()), "v": int((counts > 0).sum()), "ones": int((counts == 1).sum()), "twos": int((counts == 2).sum())}
        out = [{"bucket": bucket, "pair_bucket": -1, "keys": subs.tobytes(), "counts": counts.tobytes(), "lengths": lengths.astype(np.uint32).tobytes()} | sums_]
        pairs, word = spelt_pairs(subs, lengths)
        keys, n = _sum_by(pairs, (counts[word] > 0).astype(np.int64))
        order, at = bucketed(keys, buckets)
        keys, n = keys[order], n[order]
        none = dict.fromkeys(sums_, 0)
        out += [{"bucket": bucket, "pair_bucket": b, "keys": keys[q].tobytes(), "counts": n[q].tobytes(), "lengths": None} | none for b, q in at]
        return pd.DataFrame(out)

    owned = staged(asked.groupBy("bucket").applyInPandas(gather, "bucket bigint, pair_bucket bigint, keys binary, counts binary, lengths binary, n bigint, v bigint, ones bigint, twos bigint"), "buckets")
    inside = owned.filter("pair_bucket >= 0").select(F.lit(False).alias("chunked"), F.col("bucket").alias("asker"), "pair_bucket", "keys", "counts")
    between = chunks.filter("pairs IS NOT NULL").select(F.lit(True).alias("chunked"), F.col("chunk").alias("asker"), F.col("bucket").alias("pair_bucket"), F.col("pairs").alias("keys"), F.col("pair_counts").alias("counts"))
    pairs_asked = inside.unionByName(between)

    def together(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return _sum_by(np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["keys"]]), np.concatenate([np.frombuffer(x, np.int64) for x in pdf["counts"]]))

    def united(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, c = together(pdf)
        return pd.DataFrame([{"bucket": int(pdf["pair_bucket"].iloc[0]), "a": keys.tobytes(), "b": c.tobytes()}])

    held_pairs = staged(pairs_asked.groupBy("pair_bucket").applyInPandas(united, "bucket bigint, a binary, b binary"), "pairs")

    def sums(of_table: DataFrame, of) -> dict[str, np.ndarray]:
        """Sums by piece over a table of buckets: of(bucket, a, b) gives name: (pieces, values)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for bucket, *parts in zip(*(x.to_pylist() for x in batch.columns)):
                    for name, (pieces_, values) in of(bucket, *parts).items():
                        total_ = np.bincount(pieces_, values, IDS)
                        at = np.flatnonzero(total_)
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(total_[at], pa.float64())], ["name", "at", "n"])

        out: dict[str, np.ndarray] = {}
        for r in of_table.mapInArrow(run, "name string, at bigint, n double").groupBy("name", "at").agg(F.sum("n").alias("n")).collect():  # a few rows a piece of the vocabulary
            out.setdefault(r["name"], np.zeros(IDS))[r["at"]] = r["n"]
        return out

    def learned_pairs(a: bytes, b: bytes):
        keys, c = np.frombuffer(a, np.uint64), np.frombuffer(b, np.int64)
        keys, c = keys[c > 0], c[c > 0]
        return keys, c, *ends_of(keys)

    def first_sums(bucket, a, b):
        _, c, u, w = learned_pairs(a, b)
        one = np.ones(len(c))
        return {"all": (u, c), "ones": (u, c == 1), "twos": (u, c == 2), "u": (u, one), "w": (w, one)}

    empty = np.zeros(IDS)
    start = sums(held_pairs, first_sums)
    c_u, t_u, t_w = (start.get(x, empty) for x in ("all", "u", "w"))
    d = discount(start.get("ones", empty).sum(), start.get("twos", empty).sum())
    sweeps: list[Sweep] = []
    for number in range(model.sweeps):
        # Dishes of pieces: the vocabulary and the end of a word.
        p_w = np.zeros(IDS)
        dishes = np.append(np.arange(pieces), END_WORD)
        p_w[dishes] = parent(t_w[dishes], model.strength, _rng(model, number, (1 << 64) - 1))
        sweeps.append(Sweep(number, t_u, p_w))
        if number == model.sweeps - 1:
            break
        shared = sc.broadcast(sweeps[-1])  # two numbers a piece of the vocabulary

        def seat(bucket, a, b, shared=shared):
            keys, c, u, w = learned_pairs(a, b)
            t = _seated(keys, c, shared.value, d, model, bucket)
            return {"u": (u, t), "w": (w, t)}

        got = sums(held_pairs, seat)
        t_u, t_w = got.get("u", empty), got.get("w", empty)
    kept = sc.broadcast((sweeps[model.burn_in :] or sweeps[-1:], c_u, d))

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        """log10 of the averaged predictive probability of each pair that was asked for."""
        use, all_u, disc = kept.value
        here = int(pdf["pair_bucket"].iloc[0])
        keys, c = together(pdf)
        u, w = ends_of(keys)
        p, learned = np.zeros(len(keys)), c > 0
        for s in use:
            t = np.zeros(len(keys))
            t[learned] = _seated(keys[learned], c[learned], s, disc, model, here)
            p += (np.maximum(c - disc * t, 0) + (model.strength + disc * s.t_u[u]) * s.p_w[w]) / (model.strength + all_u[u])
        logs = np.log10(p / len(use))
        return pd.DataFrame([{"chunked": bool(f), "asker": int(b), "bucket": here, "keys": x, "logs": logs[np.searchsorted(keys, np.frombuffer(x, np.uint64))].tobytes()} for f, b, x in zip(pdf["chunked"], pdf["asker"], pdf["keys"])])

    pair_answers = staged(pairs_asked.groupBy("pair_bucket").applyInPandas(answer, "chunked boolean, asker bigint, bucket bigint, keys binary, logs binary"), "answers")

    def looked_up(pdf: pd.DataFrame, pairs: np.ndarray) -> np.ndarray:
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["keys"]])
        logs = np.concatenate([np.frombuffer(x, np.float64) for x in pdf["logs"]])
        order = np.argsort(keys)
        return logs[order][np.searchsorted(keys, pairs, sorter=order)]

    def spell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Of a bucket of words the counts, and the first piece and log10 probability of the spelling after it."""
        if not len(left):
            return pd.DataFrame({"bucket": [], "counts": [], "logs": [], "firsts": []})
        r = left.iloc[0]
        lengths, subs = np.frombuffer(r["lengths"], np.uint32).astype(np.int64), np.frombuffer(r["keys"], np.uint16)
        pairs, word = spelt_pairs(subs, lengths)
        first = subs[np.concatenate(([0], np.cumsum(lengths)[:-1]))]
        return pd.DataFrame([{"bucket": int(r["bucket"]), "counts": r["counts"], "logs": np.bincount(word, looked_up(right, pairs), len(lengths)).tobytes(), "firsts": first.tobytes()}])

    tables_of = owned.filter("pair_bucket < 0").select("bucket", "keys", "counts", "lengths")
    to_buckets = pair_answers.filter("NOT chunked").select(F.col("asker").alias("bucket"), "keys", "logs")
    spelt = staged(tables_of.groupBy("bucket").cogroup(to_buckets.groupBy("bucket")).applyInPandas(spell, "bucket bigint, counts binary, logs binary, firsts binary"), "spelt")

    # Restaurants of words, one for each first piece.
    whole = owned.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("n", "v", "ones", "twos")]).first()
    ends = rows.filter(~F.col("held")).count()
    n, v = int(whole["n"]) + ends, int(whole["v"]) + (ends > 0)
    word_d, strength = discount(whole["ones"], whole["twos"]), model.strength

    def word_part(c: bytes, logs: bytes, firsts: bytes):
        return np.frombuffer(c, np.int64), 10.0 ** np.frombuffer(logs, np.float64), np.frombuffer(firsts, np.uint16).astype(np.int64)

    def first_words(bucket, *parts):
        c, p, f = word_part(*parts)
        return {"all": (f, c), "t": (f, c > 0), "known": (f, np.where(c > 0, p, 0))}

    got = sums(spelt, first_words)
    c_f, t_f, known = (got.get(x, empty) for x in ("all", "t", "known"))
    # The base of learned words is the speller's probability times scale, that of the unlearned dish is fresh; spare is what the speller leaves to unlearned words.
    scale, fresh = np.divide(t_f, (t_f + 1) * known, out=np.zeros(IDS), where=known > 0), 1 / (t_f + 1)
    spare = np.clip(1 - known, 1e-12, 1)
    based = sc.broadcast((scale, fresh, spare))  # three numbers a piece of the vocabulary
    word_sweeps = []
    for number in range(model.sweeps):
        word_sweeps.append((1000 + number, t_f))
        if number == model.sweeps - 1:
            break
        shared = sc.broadcast(word_sweeps[-1])

        def seat_words(bucket, *parts, shared=shared):
            c, p, f = word_part(*parts)
            k, before = shared.value
            return {"t": (f, tables(c, before[f], p * based.value[0][f], word_d, strength, _rng(model, k, bucket)))}

        t_f = sums(spelt, seat_words).get("t", empty)
    kept_words = sc.broadcast((word_sweeps[model.burn_in :] or word_sweeps[-1:], c_f))

    def word_answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Of the words that each chunk asked a bucket for: counts, log10 of the averaged probability after the first piece, and that with unlearned words spelt."""
        if not len(left):
            return pd.DataFrame({"chunk": [], "bucket": [], "keys": [], "counts": [], "logs": [], "open": []})
        use, all_f = kept_words.value
        scale_, fresh_, spare_ = based.value
        bucket = int(left["bucket"].iloc[0])
        asked_ = [np.frombuffer(x, np.uint64) for x in left["words"]]
        own = np.unique(np.concatenate(asked_))
        c, spelt_p, f = word_part(*right[["counts", "logs", "firsts"]].iloc[0])
        learned = c > 0
        base, p = np.where(learned, spelt_p * scale_[f], fresh_[f]), np.zeros(len(c))
        for k, before in use:
            t = tables(c, before[f], base, word_d, strength, _rng(model, k, bucket))
            p += (np.maximum(c - word_d * t, 0) + (strength + word_d * before[f]) * base) / (strength + all_f[f])
        logs = np.log10(p / len(use))
        wide = logs + np.where(learned, 0, np.minimum(np.log10(spelt_p / spare_[f]), 0))
        at = [np.searchsorted(own, x) for x in asked_]
        return pd.DataFrame([{"chunk": int(k), "bucket": bucket, "keys": None, "counts": c[x].astype(np.uint32).tobytes(), "logs": logs[x].tobytes(), "open": wide[x].astype(np.float32).tobytes()} for k, x in zip(left["chunk"], at)])

    answer_type = "chunk bigint, bucket bigint, keys binary, counts binary, logs binary, open binary"
    answers = asked.select("chunk", "bucket", "words").groupBy("bucket").cogroup(spelt.groupBy("bucket")).applyInPandas(word_answer, answer_type)
    crossing = pair_answers.filter("chunked").select(F.col("asker").alias("chunk"), "bucket", "keys", F.lit(None).cast("binary").alias("counts"), "logs", F.lit(None).cast("binary").alias("open"))
    texts = chunks.filter("bucket < 0").select("chunk", "ids", "held", "lengths", "stream", "firsts", "lasts")
    end_logs = float(np.log10((ends + 1) / (n + v + 1)))

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        words, pairs = right[right["keys"].isna()].sort_values("bucket"), right[right["keys"].notna()]
        join = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in words[name]] or [np.zeros(0, kind)])
        counts, logs, wide = join("counts", np.uint32).astype(np.int64), join("logs", np.float64), join("open", np.float32).astype(np.float64)
        base = np.log10((counts + 1) / (n + v + 1))
        for r in left.itertuples():
            lengths = np.frombuffer(r.lengths, np.uint32).astype(np.int64)
            stream = np.ascontiguousarray(np.frombuffer(zlib.decompress(r.stream), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
            text = np.repeat(np.arange(len(lengths)), lengths)
            per_text = lambda x: np.bincount(text, x[stream], len(lengths))
            keys, of = crossing_pairs(stream, lengths, np.frombuffer(r.firsts, np.uint16), np.frombuffer(r.lasts, np.uint16), end)
            across = np.bincount(of, looked_up(pairs, keys), len(lengths))
            out.append(pd.DataFrame({
                "id": r.ids,
                "held_out": r.held,
                "n_tokens": lengths + 1,
                "n_known": per_text(counts > 0).astype(np.int64) + int(ends > 0),
                "base_score": per_text(base) + end_logs,
                "score": across + per_text(logs),
                "open_score": across + per_text(wide),
            }))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "held_out": [], "n_tokens": [], "n_known": [], "base_score": [], "score": [], "open_score": []})

    kind = dict(rows.dtypes)["id"]
    scored = texts.groupBy("chunk").cogroup(answers.unionByName(crossing).groupBy("chunk")).applyInPandas(score, f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, open_score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", "open_score")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; null counts as empty (one token, the end), repeated rows each give a row, an empty table gives an empty one."""
    import public_tokenizers

    return lm_scores(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
