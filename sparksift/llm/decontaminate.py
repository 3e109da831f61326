"""Operator 10: benchmark decontamination by a broadcast hash set of normalised test n-grams.

A-Z are lower-cased and words are runs of digits, letters a-z and anything beyond ASCII. The benchmark's words
get numbers, its windows are kept by a hash of those numbers, and both go to the executors in one broadcast.
A document's words become numbers (0: not in the benchmark), windows free of 0 are hashed and looked up, and
each hit is verified number by number. Broadcasting is for a benchmark under a byte bound; a larger one is cut
into blocks by a running sum of bytes, which are fetched and scanned one after the other. The hits of all blocks are
put together for each row before anything is cut, so the result doesn't depend on the blocks.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import OWN, byte_groups, need, staged, table

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
#: Bytes of benchmark text for one broadcast; the index in a worker takes some twenty times as much.
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 2 << 20
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def words(raw: bytes) -> list[bytes]:
    return WORD.findall(raw.lower())


class WindowIndex:
    """Windows of the items by length, hash and numbers of their words."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        found: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, raw in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(raw)]
            n = min(window, len(ids))
            for k in range(len(ids) - n + 1) if ids else ():
                found[n][tuple(ids[k : k + n])].add(item)
        self.by_length = {}
        for n, by_ids in found.items():
            keys = np.array(list(by_ids), np.uint64).reshape(-1, n)
            self.by_length[n] = (np.unique(self.hashes(keys)), {k: frozenset(v) for k, v in by_ids.items()})

    @staticmethod
    def hashes(rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.uint64)
        for k in range(rows.shape[1]):
            out = (out ^ rows[:, k]) * _PRIME
            out ^= out >> np.uint64(29)
        return out

    def scan(self, found: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the items with an occurring window."""
        hit, items = np.zeros(len(found), bool), set()
        get = self.numbers.get
        ids = np.fromiter((get(w, 0) for w in found), np.uint64, len(found))
        zeros = np.concatenate(([0], np.cumsum(ids == 0)))
        for n, (hashes, by_ids) in self.by_length.items():
            at = np.flatnonzero(zeros[n:] == zeros[:-n]) if len(ids) >= n else ()
            if not len(at):
                continue
            keys = self.hashes(np.lib.stride_tricks.sliding_window_view(ids, n)[at])
            near = np.searchsorted(hashes, keys)
            for k in at[hashes[np.minimum(near, len(hashes) - 1)] == keys]:
                whose = by_ids.get(tuple(ids[k : k + n].tolist()))
                if whose:
                    hit[k : k + n] = True
                    items |= whose
        return hit, items


def spans(raw: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans of the runs of hit words."""
    out: list[tuple[int, int]] = []
    before = False
    for m, h in zip(WORD.finditer(raw.lower()), hit):
        if h and before:
            out[-1] = (out[-1][0], m.end())
        elif h:
            out.append(m.span())
        before = h
    return out


def without(raw: bytes, cuts: list[tuple[int, int]]) -> bytes:
    """raw with a blank for each of the spans."""
    for a, b in reversed(cuts):
        raw = raw[:a] + b" " + raw[b:]
    return raw


class Blocks:
    """The benchmark's distinct texts in blocks of about block_bytes (one item more at most). The driver holds one block at a time."""

    def __init__(self, bench: DataFrame, item_col: str, text_col: str, block_bytes: int):
        rows = bench.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("binary").alias("t")).filter("i IS NOT NULL AND t IS NOT NULL").distinct()
        self.rows = staged(rows.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id(), "b": F.octet_length("t").cast("long")}), "benchmark")
        total = self.rows.agg(F.coalesce(F.sum("b"), F.lit(0))).first()[0]
        self.n = max(1, -(-total // block_bytes))
        if self.n > 1:
            sums = self.rows.groupBy("part").agg(F.sum("b").alias("s"))
            before = sums.select("part", (F.sum("s").over(Window.orderBy("part")) - F.col("s")).alias("before"))  # a row for each part of the scan
            within = F.sum("b").over(Window.partitionBy("part").orderBy("at")) - F.col("b")
            numbered = self.rows.withColumn("within", within).join(F.broadcast(before), "part")
            self.rows = staged(numbered.select("i", "t", ((F.col("before") + F.col("within")) / block_bytes).cast("long").alias("block")), "benchmark-blocks")

    def indexes(self, window: int) -> Iterator[WindowIndex]:
        for k in range(self.n):
            part = self.rows.filter(F.col("block") == k) if self.n > 1 else self.rows
            yield WindowIndex([(r["i"], bytes(r["t"])) for r in part.select("i", "t").collect()], window)


def _scan(docs: DataFrame, index, text_col: str, cleaned: bool) -> DataFrame:
    """docs with columns n_words, n_hit, items, spans, runs of hit words (OWN prefix); with cleaned, the text with hit spans replaced by a blank until none is left."""
    columns = docs.columns
    place = columns.index(text_col)
    extra = [T.StructField(f"{OWN}n_words", T.LongType()), T.StructField(f"{OWN}n_hit", T.LongType()), T.StructField(f"{OWN}items", T.ArrayType(T.StringType())), *[T.StructField(f"{OWN}{x}", T.ArrayType(T.ArrayType(T.LongType()))) for x in ("spans", "runs")]]
    out = T.StructType([*docs.schema.fields, *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()
            for lo, hi in byte_groups(sizes, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                n_words, n_hit, items, where, runs, texts = [], [], [], [], [], []
                for raw in part.column(place).cast(pa.binary()).to_pylist():
                    found = words(raw or b"")
                    hit, whose = own.scan(found)
                    n = int(hit.sum())
                    cuts = spans(raw, hit) if n else []
                    n_words.append(len(found))
                    n_hit.append(n)
                    items.append(sorted(whose))
                    where.append([list(x) for x in cuts])
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                    runs.append(edges.reshape(-1, 2).tolist())
                    while cleaned and cuts:
                        raw = without(raw, cuts)
                        hit, _ = own.scan(words(raw))
                        cuts = spans(raw, hit)
                    texts.append(raw)
                arrays = list(part.columns)
                if cleaned:
                    arrays[place] = pa.array(texts, pa.binary()).cast(pa.string())
                arrays += [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), *[pa.array(x, pa.list_(pa.list_(pa.int64()))) for x in (where, runs)]]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in out.fields])

    return docs.mapInArrow(run, out)


def _hits(rows: DataFrame, parts: Blocks, window: int) -> DataFrame:
    """row, items, runs of word numbers of the rows that any block hits; rows: OWN row, OWN text. Each block is scanned and written before the next is fetched."""
    sc, out = rows.sparkSession.sparkContext, None
    for index in parts.indexes(window):
        shared = sc.broadcast(index)
        one = _scan(rows, shared, f"{OWN}text", False).filter(F.col(f"{OWN}n_hit") > 0)
        one = staged(one.select(f"{OWN}row", f"{OWN}items", f"{OWN}runs"), "hits")
        shared.destroy()
        out = one if out is None else out.unionByName(one)
    return out.groupBy(f"{OWN}row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"{OWN}items")))).alias(f"{OWN}items"),
        F.flatten(F.collect_list(f"{OWN}runs")).alias(f"{OWN}runs"),
    )


def _marked(rows: DataFrame, cut: bool) -> DataFrame:
    """rows (OWN text, OWN runs) with n_words, n_hit and byte spans of the runs of all blocks; with cut, the text with a blank for each span."""
    place, at = rows.columns.index(f"{OWN}text"), rows.columns.index(f"{OWN}runs")
    out = T.StructType([*rows.schema.fields, T.StructField(f"{OWN}n_words", T.LongType()), T.StructField(f"{OWN}n_hit", T.LongType()), T.StructField(f"{OWN}spans", T.ArrayType(T.ArrayType(T.LongType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()
            for lo, hi in byte_groups(sizes, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                n_words, n_hit, where, texts = [], [], [], []
                for raw, runs in zip(part.column(place).cast(pa.binary()).to_pylist(), part.column(at).to_pylist()):
                    hit = np.zeros(len(words(raw or b"")), bool)
                    for a, b in runs or ():
                        hit[a:b] = True
                    cuts = spans(raw, hit) if hit.any() else []
                    n_words.append(len(hit))
                    n_hit.append(int(hit.sum()))
                    where.append([list(x) for x in cuts])
                    texts.append(without(raw, cuts) if cut else raw)
                arrays = list(part.columns)
                arrays[place] = pa.array(texts, pa.binary()).cast(pa.string())
                arrays += [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(where, pa.list_(pa.list_(pa.int64())))]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in out.fields])

    return rows.mapInArrow(run, out)


def scan(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: id, n_words long, n_hit long, items array of item ids (as strings, sorted), spans array of [from, to) byte offsets.

    A null or empty text has no words and no hits; null items and items without words have no windows; repeated items
    count once, repeated documents each give a row. Other columns are left out. Empty tables give an empty result, or
    no hits. Over several blocks each row's hits are put together; the result is that of one block.
    """
    need(docs, [id_col, text_col])
    need(bench, [item_col, item_text_col])
    rows = docs.select(F.col(id_col).alias(f"{OWN}id"), F.col(text_col).alias(f"{OWN}text"))
    parts = Blocks(bench, item_col, item_text_col, block_bytes)
    if parts.n == 1:
        df = _scan(rows, docs.sparkSession.sparkContext.broadcast(next(parts.indexes(window))), f"{OWN}text", False)
    else:
        rows = staged(rows.withColumn(f"{OWN}row", F.monotonically_increasing_id()), "decontaminate")
        df = _marked(rows.join(_hits(rows, parts, window), f"{OWN}row", "left"), False).withColumn(f"{OWN}items", F.coalesce(f"{OWN}items", F.array().cast("array<string>")))
    return df.select(F.col(f"{OWN}id").alias(id_col), *[F.col(f"{OWN}{c}").alias(c) for c in ("n_words", "n_hit", "items", "spans")])


def decontaminate(docs: DataFrame, bench: DataFrame, action: str = "spans", text_col: str = "text", chars_col: str | None = "n_chars", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs, all columns, without what the benchmark holds: action "spans" takes the hit words out of the text (a blank
    stands for each run, and the text is scanned again, against all blocks, until no window is left), "documents"
    leaves the hit rows out.

    Null texts and rows without hits stay as they are, byte for byte; chars_col gets the new length where the text changed.
    Repeated rows each stay. An empty benchmark changes nothing; an empty table gives an empty one.
    """
    if action not in ("spans", "documents"):
        raise ValueError(action)
    need(docs, [text_col])
    need(bench, [item_col, item_text_col])
    columns = docs.columns
    parts = Blocks(bench, item_col, item_text_col, block_bytes)
    if parts.n == 1:
        df = _scan(docs, docs.sparkSession.sparkContext.broadcast(next(parts.indexes(window))), text_col, action == "spans")
        if action == "documents":
            return df.filter(F.col(f"{OWN}n_hit") == 0).select(*columns)
        changed = F.col(f"{OWN}n_hit") > 0
    else:
        df = staged(docs.withColumn(f"{OWN}row", F.monotonically_increasing_id()), "decontaminate")
        live = df.select(f"{OWN}row", F.col(text_col).alias(f"{OWN}text"))
        if action == "documents":
            return df.join(_hits(live, parts, window).select(f"{OWN}row"), f"{OWN}row", "left_anti").select(*columns)
        # A round scans the rows that the one before cut, against all blocks; a row's last text stands.
        done, number = None, 0
        while True:
            cut = _marked(live.join(_hits(live, parts, window), f"{OWN}row"), True)
            live = staged(cut.select(f"{OWN}row", f"{OWN}text"), "cut")
            if live.isEmpty():
                break
            one = live.withColumn(f"{OWN}round", F.lit(number))
            done, number = one if done is None else done.unionByName(one), number + 1
        if done is None:
            return df.select(*columns)
        last = done.groupBy(f"{OWN}row").agg(F.max_by(f"{OWN}text", f"{OWN}round").alias(f"{OWN}cut"))
        changed = F.col(f"{OWN}cut").isNotNull()
        df = df.join(last, f"{OWN}row", "left").withColumn(text_col, F.coalesce(f"{OWN}cut", text_col))
    if chars_col and chars_col in columns:
        df = df.withColumn(chars_col, F.when(changed, F.length(text_col)).otherwise(F.col(chars_col)).cast(docs.schema[chars_col].dataType))
    return df.select(*columns)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with its hit words and items. Null and empty texts have no words; an empty benchmark gives no hits, an empty table no rows."""
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP10_SQL = rf"""
WITH b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '{_PATTERN}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
       FROM b, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS u(i) WHERE len(w) > 0),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_PATTERN}') AS w FROM documents),
dw AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
       FROM d, (SELECT DISTINCT n FROM bw) AS l, unnest(generate_series(1, len(w) - n + 1)) AS u(i)),
h AS (SELECT doc_id, item, n, i FROM dw JOIN bw USING (n, g)),
hw AS (SELECT doc_id, count(DISTINCT i + k) AS c FROM h, unnest(generate_series(0, n - 1)) AS u(k) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item) AS c, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hw.c, 0)::BIGINT AS n_hit, coalesce(it.c, 0)::BIGINT AS n_items,
       sha256(coalesce(it.s, '')) AS items_sha256, hw.c IS NOT NULL AS contaminated
FROM d LEFT JOIN hw ON hw.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""
