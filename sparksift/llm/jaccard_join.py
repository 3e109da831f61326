"""Operator 9: Jaccard self-join on word shingles with Bayesian pruning of candidates.

Texts are sets of 64-bit hashes of five consecutive words (A-Z lower-cased; words are runs of digits, a-z and
anything beyond ASCII). Equal sets are one node. Banded MinHash values put nodes into buckets: a link of the threshold
or more shares none with a chance of under 1e-7. Nodes of a bucket are compared by their MinHash values step by step;
a pair goes when the posterior probability that its similarity reaches the threshold (uniform prior) is below
`tolerance`. Pairs that stay join nodes to groups, so that a group holds likely links and not what a passage or two
chains together. Within a group the same pruning tells which blocks of texts a node has likely links in; only there
its text goes, and pairs are verified on the whole sets. Tasks give back link counts and a spanning forest, never pairs.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import OWN, byte_groups, need, staged, table
from .components import components

SLICE_BYTES = 1 << 19
#: Nodes (two longs each) that may be broadcast to find their rows; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Bands that two nodes share in one bucket's first node's company before they count as one group without comparison.
TIGHT_BANDS = 6
#: Pairs that are compared at once in a task.
TILE = 256


@dataclass(frozen=True)
class Join:
    words: int = 5
    threshold: float = 0.8
    bands: int = 56
    rows: int = 6
    compared: int = 256
    step: int = 32
    tolerance: float = 1e-9
    #: Nodes by their signatures in one task are two blocks of this many; texts are two blocks of about text_block bytes.
    block: int = 4_096
    text_block: int = 4 << 20

    def __post_init__(self):
        if not 0 < self.threshold <= 1 or self.compared > self.bands * self.rows:
            raise ValueError(self)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    codes = np.arange(256)
    inside = ((codes >= 0x30) & (codes <= 0x39)) | ((codes >= 0x61) & (codes <= 0x7A)) | ((codes >= 0x41) & (codes <= 0x5A)) | (codes >= 0x80)
    lower = np.where((codes >= 0x41) & (codes <= 0x5A), codes + 32, codes)
    return inside, mix(lower.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


_BASE = 0x5851F42D4C957F2D


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def shingles(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after the other, and the offsets where each text's begin (one more than texts).

    A text with words, but fewer than width, has one shingle of them all.
    """
    inside, values = _byte_tables()
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    starts_of = np.concatenate(([0], np.cumsum(lengths)))
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8) if texts else np.zeros(0, np.uint8)
    flags = np.concatenate(([False], inside[raw])).astype(np.int8)
    edge = np.diff(flags)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    up, down = _powers(1 << max(16, (len(raw) + 1).bit_length()))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(values[raw] * up[: len(raw)])))
    word = mix((sums[last] - sums[first]) * down[first])
    doc = np.searchsorted(starts_of, first, "right") - 1
    n = len(word) - width + 1
    rows, keys = [], []
    if n > 0:
        whole = doc[:n] == doc[width - 1 :]
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h = (h ^ word[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        rows.append(doc[:n][whole])
        keys.append(mix(h[whole]))
    counts = np.bincount(doc, minlength=len(texts))
    at = np.concatenate(([0], np.cumsum(counts)))
    for d in np.flatnonzero((counts > 0) & (counts < width)):
        h = np.uint64(counts[d])
        with np.errstate(over="ignore"):
            for w in word[at[d] : at[d + 1]]:
                h = (h ^ w) * np.uint64(0x9E3779B97F4A7C15)
        rows.append(np.array([d]))
        keys.append(np.array([h], np.uint64))
    doc, key = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))
    doc, key = doc[fresh], key[fresh]
    return key, np.searchsorted(doc, np.arange(len(texts) + 1))


@functools.cache
def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.Philox(20240229))
    return rng.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32)


def minhashes(keys: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """n MinHash values of each set that isn't empty, in order."""
    begins = offsets[:-1][offsets[1:] > offsets[:-1]]
    out = np.empty((len(begins), n), np.uint32)
    a, b = _coefficients(n)
    small = (keys >> np.uint64(32)).astype(np.uint32)
    ends = np.append(begins[1:], len(keys))
    for lo, hi in byte_groups((ends - begins).tolist(), 1 << 15):
        part, at = small[begins[lo] : ends[hi - 1]], begins[lo:hi] - begins[lo]
        held = np.empty_like(part)
        for k in range(n):
            np.multiply(part, a[k], out=held)
            np.add(held, b[k], out=held)
            # A second multiplication of the folded value breaks the order that one linear map keeps.
            np.bitwise_xor(held, held >> np.uint32(15), out=held)
            np.multiply(held, np.uint32(0x2C1B3C6D), out=held)
            out[lo:hi, k] = np.minimum.reduceat(held, at)
    return out


@functools.cache
def least_matches(join: Join) -> dict[int, int]:
    """For each number of values compared: matches under which the posterior of reaching the threshold is below the tolerance."""
    out = {}
    for n in range(join.step, join.compared + 1, join.step):
        total, t, m = 0.0, join.threshold, 0
        # With a uniform prior the posterior is Beta(m + 1, n - m + 1); its mass beyond t is P(Binomial(n + 1, t) <= m).
        while m <= n:
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= join.tolerance:
                break
            m += 1
        out[n] = m
    return out


def _signed(docs: DataFrame, id_col: str, text_col: str, join: Join) -> DataFrame:
    """id, th (hash of the text), bytes, node, size, bands, signature of each row; node is null without words."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).cast("binary").alias("raw"))
    kind = dict(rows.dtypes)["id"]
    names = ["id", "th", "bytes", "node", "size", "bands", "signature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()
            for lo, hi in byte_groups(sizes, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                keys, offsets = shingles([x or b"" for x in part.column(2).to_pylist()], join.words)
                full = np.flatnonzero(offsets[1:] > offsets[:-1])
                node, size = np.zeros(hi - lo, np.int64), np.diff(offsets)
                bands, signature = [None] * (hi - lo), [None] * (hi - lo)
                if len(full):
                    values = minhashes(keys, offsets, join.bands * join.rows)
                    sums = np.add.reduceat(mix(keys + np.uint64(0x632BE59BD9B4E019)), offsets[:-1][full])
                    node[full] = mix(sums + size[full].astype(np.uint64)).view(np.int64)
                    h = np.tile(mix(np.arange(1, join.bands + 1, dtype=np.uint64)), (len(full), 1))
                    for k in range(join.rows):
                        h = mix((h ^ values[:, k :: join.rows][:, : join.bands].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
                    h = h.view(np.int64)
                    short = values[:, : join.compared].astype(np.uint16)
                    for r, d in enumerate(full):
                        bands[d], signature[d] = h[r], short[r].tobytes()
                mask = size == 0
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes[lo:hi], pa.int64()), pa.array(node, mask=mask), pa.array(size.astype(np.int64)), pa.array(bands, pa.list_(pa.int64())), pa.array(signature, pa.binary())], names)

    return rows.mapInArrow(run, f"id {kind}, th bigint, bytes bigint, node bigint, size bigint, bands array<bigint>, signature binary")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets on the left with sets on the right."""
    sets = [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    keep = counts[inverse] > 1
    column, owner = shared[inverse[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out, width = np.zeros((len(left), len(right)), np.float32), 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (lo, lo + width))
        x = np.zeros((len(sets), width), np.float32)
        x[owner[a:b], column[a:b] - lo] = 1
        out += x[: len(left)] @ x[len(left) :].T
    return out


def _likely(size: np.ndarray, signature: np.ndarray, i: np.ndarray, j: np.ndarray, join: Join) -> np.ndarray:
    """Which pairs of rows i with rows j aren't pruned; a row isn't paired with itself."""
    # Sizes bound the similarity: it can't pass their ratio.
    live = np.minimum(size[i][:, None], size[j]) >= join.threshold * np.maximum(size[i][:, None], size[j])
    live &= i[:, None] != j
    matches = np.zeros(live.shape, np.int16)
    for n, least in least_matches(join).items():
        if not live.any():
            break
        for k in range(n - join.step, n):
            matches += signature[i, k][:, None] == signature[j, k]
        live &= matches >= least
    return live


def _tiles(left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Pieces of the rows on the left with pieces of those on the right, each pair of pieces once; whether both are one piece."""
    for a in range(0, len(left), TILE):
        for b in range(a if same else 0, len(right), TILE):
            yield left[a : a + TILE], right[b : b + TILE], same and a == b


def _top(root: list[int], k: int) -> int:
    while root[k] != k:
        root[k] = root[root[k]]
        k = root[k]
    return k


def _join_up(root: list[int], x: np.ndarray, y: np.ndarray) -> None:
    for p, q in zip(x.tolist(), y.tolist()):
        p, q = _top(root, p), _top(root, q)
        if p != q:
            root[max(p, q)] = min(p, q)


def _columns(rows: list[tuple]):
    return lambda k: np.array([r[k] for r in rows])


def _signatures(rows: list[tuple], k: int) -> np.ndarray:
    return np.frombuffer(b"".join(r[k] for r in rows), np.uint16).reshape(len(rows), -1)


def _per_task(dealt: DataFrame, close, schema: str) -> DataFrame:
    """Runs close on the rows of each task. A task is told by the first three columns, and its rows lie side by side in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, []
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                for row in zip(*(c.to_pylist() for c in batch.slice(lo, 512).columns)):
                    if row[:3] != task:
                        if len(held) > 1:
                            yield close(held)
                        task, held = row[:3], []
                    held.append(row)
        if len(held) > 1:
            yield close(held)

    return dealt.mapInArrow(run, schema)


def _dealt(rows: DataFrame, key: str, block: str, blocks: str) -> DataFrame:
    """key, bi, bj, side and the other columns: each row once for every pair of blocks that its own block is in."""
    rest = [c for c in rows.columns if c not in (key, block, blocks)]
    tasks = rows.withColumn("against", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
    return tasks.select(key, F.least(block, "against").alias("bi"), F.greatest(block, "against").alias("bj"), F.when(F.col(block) <= F.col("against"), 0).otherwise(1).alias("side"), *rest)


def _side_by_side(tasks: DataFrame) -> DataFrame:
    key = tasks.columns[:3]
    return tasks.repartition(*key).sortWithinPartitions(*key, "node")


def _bucket_forest(tasks: DataFrame, join: Join) -> DataFrame:
    """u, v: a spanning forest over labels of the likely pairs of each bucket. tasks: band, bi, bj, side, node, label, size, signature."""

    def close(rows: list[tuple]) -> pa.RecordBatch:
        column = _columns(rows)
        side, label, size, signature = column(3), column(5), column(6), _signatures(rows, 7)
        same = rows[0][1] == rows[0][2]
        i = np.flatnonzero(side == 0)
        names, at = np.unique(label, return_inverse=True)
        root = list(range(len(names)))
        for a, b, _ in _tiles(i, i if same else np.flatnonzero(side == 1), same):
            # Nodes of one label are together already.
            if len(names) > 1 and (label[a][:, None] != label[b]).any():
                x, y = np.nonzero(_likely(size, signature, a, b, join) & (label[a][:, None] != label[b]))
                _join_up(root, at[a[x]], at[b[y]])
        moved = [k for k in range(len(names)) if _top(root, k) != k]
        return pa.RecordBatch.from_arrays([pa.array(names[moved], pa.int64()), pa.array(names[[_top(root, k) for k in moved]], pa.int64())], ["u", "v"])

    return _per_task(_side_by_side(tasks), close, "u bigint, v bigint")


def _likely_blocks(tasks: DataFrame, join: Join) -> DataFrame:
    """node, other: the blocks of texts in which a node has a likely pair. tasks: label, bi, bj, side, node, size, text_block, signature."""

    def close(rows: list[tuple]) -> pa.RecordBatch:
        column = _columns(rows)
        side, node, size, block, signature = column(3), column(4), column(5), column(6), _signatures(rows, 7)
        same = rows[0][1] == rows[0][2]
        i, found = np.flatnonzero(side == 0), set()
        for a, b, _ in _tiles(i, i if same else np.flatnonzero(side == 1), same):
            x, y = np.nonzero(_likely(size, signature, a, b, join))
            x, y = a[x], b[y]
            for p, q in ((x, y), (y, x)):
                both = np.unique(np.stack([p, block[q]]), axis=1)
                found.update(zip(both[0].tolist(), both[1].tolist()))
        return pa.RecordBatch.from_arrays([pa.array([node[p] for p, _ in found], pa.int64()), pa.array([q for _, q in found], pa.int32())], ["node", "other"])

    return _per_task(_side_by_side(tasks), close, "node bigint, other int").distinct()


def _verified(tasks: DataFrame, join: Join) -> DataFrame:
    """node, links, root of what each task links. tasks: label, bi, bj, side, node, size, copies, signature, raw."""

    def close(rows: list[tuple]) -> pa.RecordBatch:
        column = _columns(rows)
        side, node, size, copies, signature = column(3), column(4), column(5), column(6), _signatures(rows, 7)
        same = rows[0][1] == rows[0][2]
        i = np.flatnonzero(side == 0)
        links, root = np.zeros(len(rows)), list(range(len(rows)))
        for a, b, alike in _tiles(i, i if same else np.flatnonzero(side == 1), same):
            live = _likely(size, signature, a, b, join)
            if alike:
                live &= np.tri(len(a), k=-1, dtype=bool).T
            x, y = np.nonzero(live)
            if not len(x):
                continue
            xs, ys = np.unique(x), np.unique(y)
            whole = np.unique(np.concatenate((a[xs], b[ys])))
            keys, offsets = shingles([rows[k][8] or b"" for k in whole], join.words)
            sets = {k: keys[offsets[n] : offsets[n + 1]] for n, k in enumerate(whole)}
            common = _overlaps([sets[k] for k in a[xs]], [sets[k] for k in b[ys]])[np.searchsorted(xs, x), np.searchsorted(ys, y)]
            x, y = a[x], b[y]
            linked = common >= join.threshold * (size[x] + size[y] - common) - 1e-6
            x, y = x[linked], y[linked]
            links += np.bincount(x, copies[y], len(rows)) + np.bincount(y, copies[x], len(rows))
            _join_up(root, x, y)
        some = np.flatnonzero(links > 0).tolist()
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (node[some].tolist(), links[some].astype(np.int64).tolist(), [int(node[_top(root, k)]) for k in some])], ["node", "links", "root"])

    return _per_task(_side_by_side(tasks), close, "node bigint, links bigint, root bigint")


def _small(df: DataFrame) -> DataFrame:
    """A written table of two longs a row, broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _likely_groups(banded: DataFrame, signatures: DataFrame, join: Join) -> DataFrame:
    """node, label of the nodes that have a likely pair. banded: band, node of buckets with several nodes."""
    centres = banded.groupBy("band").agg(F.min("node").alias("centre"))
    company = banded.join(centres, "band").filter("node <> centre").groupBy("node", "centre").agg(F.count("*").alias("n"))
    # Nodes that share many bands are compared in their group; this only spares comparisons in buckets.
    tight = components(company.filter(F.col("n") >= TIGHT_BANDS).select(F.col("node").alias("u"), F.col("centre").alias("v")))
    labelled = staged(banded.join(tight, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label")), "banded")
    mixed = labelled.groupBy("band").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.ceil(F.count("*") / join.block).cast("int").alias("n_blocks")).filter("a <> b")
    mixed = staged(mixed.select("band", "n_blocks"), "mixed")
    rows = labelled.join(mixed, "band").join(signatures, "node").withColumn("block", F.expr("CAST(pmod(xxhash64(node), n_blocks) AS int)"))
    forest = staged(_bucket_forest(_dealt(rows.select("band", "block", "n_blocks", "node", "label", "size", "signature"), "band", "block", "n_blocks"), join), "forest")
    over = components(forest).select(F.col("node").alias("label"), F.col("label").alias("top"))
    # A label of `over` is a node of its own, alone or in a tight group.
    found = tight.select("node").unionByName(over.select(F.col("label").alias("node"))).distinct()
    own = found.join(tight, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    return staged(own.join(over, "label", "left").select("node", F.coalesce("top", "label").alias("label")), "groups")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join = Join()) -> DataFrame:
    """Per row: id, class_id (least id of the class), n_links long (other rows whose similarity is the threshold or more), text_hash long, class_key long.

    A class is a connected component of links. Texts without words (null, empty) have no shingles and no links; each row
    is its own class, with a null class_key. Repeated rows are links of each other. Equal sets are told by 64-bit
    hashes of sets. Other columns are left out, so their names can't clash. An empty table gives an empty one.
    """
    need(docs, [id_col, text_col])
    spark = docs.sparkSession
    signed = staged(_signed(docs, id_col, text_col, join), "signatures")
    some = signed.filter("node IS NOT NULL")
    nodes = staged(some.groupBy("node").agg(F.count("*").alias("copies"), F.min(F.struct(F.col("id").isNull().alias("bare"), "id", "th")).alias("rep"), F.min("size").alias("size"), F.min("bytes").alias("bytes")), "nodes")
    every = some.select("node", F.explode("bands").alias("band"))
    full = every.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("band")
    banded = staged(every.join(full, "band").distinct(), "buckets")
    # Signatures of the nodes that share a bucket, once each.
    sharing = _small(staged(banded.select("node").distinct(), "sharing"))
    signatures = staged(some.join(sharing, "node", "left_semi").groupBy("node").agg(F.first("signature").alias("signature"), F.first("size").alias("size")), "marks")
    groups = _likely_groups(banded, signatures, join)
    # Blocks of a group by bytes of texts, and by number of signatures.
    members = groups.join(nodes.select("node", "rep", "copies", "bytes"), "node")
    sizes = staged(members.groupBy("label").agg(F.ceil(F.sum("bytes") / join.text_block).cast("int").alias("n_texts"), F.ceil(F.count("*") / join.block).cast("int").alias("n_blocks")).filter("n_texts > 1"), "sizes")
    members = members.join(sizes, "label", "left").withColumn("n_texts", F.coalesce("n_texts", F.lit(1)))
    members = staged(members.select("node", "label", "n_texts", "n_blocks", F.expr("CAST(pmod(xxhash64(node), n_texts) AS int)").alias("text_block"), F.expr("CAST(pmod(xxhash64(node, 1), n_blocks) AS int)").alias("block"), F.col("rep.id").alias("rep_id"), F.col("rep.th").alias("rep_th"), "copies"), "members")
    large = members.filter("n_texts > 1").select("label", "block", "n_blocks", "node", "text_block").join(signatures, "node").select("label", "block", "n_blocks", "node", "size", "text_block", "signature")
    others = staged(_likely_blocks(_dealt(large, "label", "block", "n_blocks"), join), "others")
    tasks = members.join(others, "node", "left").filter("n_texts = 1 OR other IS NOT NULL").withColumn("other", F.coalesce("other", F.lit(0)))
    tasks = tasks.select("label", F.least("text_block", "other").alias("bi"), F.greatest("text_block", "other").alias("bj"), F.when(F.col("text_block") <= F.col("other"), 0).otherwise(1).alias("side"), "node", "copies")
    narrow = _small(staged(members.select("node", F.xxhash64("rep_id", "rep_th").alias("key")), "wanted"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("key", F.xxhash64("id", F.xxhash64("text")))
    # A row's text may be that of another node only if two hashes agree; what a node's text is, its shingles tell.
    texts = texts.join(narrow, "key").groupBy("node").agg(F.first(F.col("text").cast("binary")).alias("raw"))
    rows = tasks.join(signatures, "node").join(texts, "node").select("label", "bi", "bj", "side", "node", "size", "copies", "signature", "raw")
    linked = staged(_verified(rows, join), "links")
    found = components(linked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    classed = nodes.join(found, "node", "left").join(counts, "node", "left").select("node", "copies", F.col("rep.id").alias("rep_id"), F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    classed = staged(classed, "classes")
    least = staged(classed.groupBy("label").agg(F.min("rep_id").alias("class_id")), "least")
    of_node = classed.join(least, "label").select("node", "class_id", F.col("label").alias("class_key"), (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    out = signed.select("id", "th", "node").join(of_node, "node", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("th").alias("text_hash"),
        "class_key",
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join = Join()) -> DataFrame:
    """docs, all columns, with one row of each class: the one of the least id (with nulls, a null one only where a class has no other).

    Rows without words (null and empty texts too) all stay; of repeated rows one stays; an empty table gives an empty one."""
    found = staged(near_duplicates(docs, id_col, text_col, join), "found")
    kept = found.filter("class_key IS NOT NULL").groupBy("class_key").agg(F.min(F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("id"), F.col("text_hash").alias("th"))).alias("k"), F.count("*").alias("c")).select("k.id", "k.th")
    wordless = found.filter("class_key IS NULL").select(F.col(id_col).alias("id"), F.col("text_hash").alias("th"))

    def rows_of(keys: DataFrame) -> DataFrame:
        keys = keys.distinct().select(F.col("id").alias(f"{OWN}id"), F.col("th").alias(f"{OWN}th"))
        return docs.join(keys, docs[id_col].eqNullSafe(F.col(f"{OWN}id")) & (F.xxhash64(docs[text_col]) == F.col(f"{OWN}th")), "left_semi")

    # Equal rows share id and text; only where there are any is a shuffle of the texts needed to keep one. Rows without words all stay.
    repeated = found.filter("class_key IS NOT NULL").groupBy(id_col, "text_hash").agg(F.count("*").alias("c")).filter("c > 1")
    if repeated.isEmpty():
        return rows_of(kept.unionByName(wordless))
    return rows_of(kept).dropDuplicates([id_col, text_col]).unionByName(rows_of(wordless))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with its class and number of links; rows without words are alone, an empty table gives an empty one."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


#: An exact join of prefixes: sets as similar as 0.8 share one of the rarest shingles of each. Classes by reach over links.
OP9_SQL = r"""
WITH RECURSIVE rows_of AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')))) END AS s
  FROM rows_of WHERE len(w) > 0
),
nodes AS (SELECT row_number() OVER () AS n, s, len(s) AS size, count(*) AS copies, min(doc_id) AS least FROM sets GROUP BY s),
shingles AS (SELECT n, size, unnest(s) AS t FROM nodes),
rarity AS (SELECT t, count(*) AS c FROM shingles GROUP BY t HAVING count(*) > 1),
ranked AS (
  SELECT n, size, t, coalesce(c, 1) AS c, row_number() OVER (PARTITION BY n ORDER BY coalesce(c, 1), t) AS k
  FROM shingles LEFT JOIN rarity USING (t)
),
prefixes AS (SELECT n, size, t FROM ranked WHERE k <= size - (4 * size + 4) // 5 + 1 AND c > 1),
candidates AS (
  SELECT DISTINCT a.n AS x, b.n AS y FROM prefixes a JOIN prefixes b USING (t)
  WHERE a.n < b.n AND 10 * least(a.size, b.size) >= 8 * greatest(a.size, b.size)
),
shared AS (
  SELECT x, y, a.size + b.size AS both_sizes, len(list_intersect(a.s, b.s)) AS common, a.copies AS cx, b.copies AS cy
  FROM candidates JOIN nodes a ON a.n = x JOIN nodes b ON b.n = y
),
links AS (SELECT x, y, cx, cy FROM shared WHERE 10 * common >= 8 * (both_sizes - common)),
sides AS (SELECT x AS n, y AS m, cy AS c FROM links UNION ALL SELECT y, x, cx FROM links),
reach AS (SELECT n, m FROM sides UNION SELECT reach.n, sides.m FROM reach JOIN sides ON reach.m = sides.n),
classes AS (SELECT reach.n, min(o.least) AS least FROM reach JOIN nodes o ON o.n = reach.m GROUP BY reach.n),
counts AS (SELECT n, sum(c) AS c FROM sides GROUP BY n),
of_node AS (
  SELECT s, coalesce(least(classes.least, nodes.least), classes.least, nodes.least) AS class_id, copies - 1 + coalesce(counts.c, 0) AS n_links
  FROM nodes LEFT JOIN classes USING (n) LEFT JOIN counts USING (n)
)
SELECT rows_of.doc_id, CASE WHEN of_node.s IS NULL THEN rows_of.doc_id ELSE class_id END AS class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM rows_of LEFT JOIN sets USING (r) LEFT JOIN of_node ON of_node.s = sets.s
"""
