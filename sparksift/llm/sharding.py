"""Operator 8: shards of near equal bytes by Karmarkar-Karp differencing.

Equal texts form a group that goes to one shard whole. Differencing repeatedly takes the two partial partitions of
largest spread and lays the heaviest parts of one on the lightest of the other. It runs in blocks of bounded size:
groups are dealt to blocks by hash, each block ends as one partial partition, and the partial partitions of the
blocks are the items of the next level, until one block is left. The slots of the levels are then composed.

A block alone can't offset a group that is heavier than a shard's share of the block. Where there are such groups they
are laid on shards first, and each block of the others is closed with its part of the room that they leave, as one more
item, so that all blocks together fill up the other shards. The last block is closed on the true sums of all before it.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import need, staged, table


@dataclass(frozen=True)
class Sharding:
    """block_items counts from 16 a shard on."""

    shards: int = 8
    block_items: int = 8192


def differencing(sums: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Items with a sum for each of k slots. Gives the sums of the k shards and, for each item, the shard of each of its slots.

    An item of one slot's weight is [w, 0, 0, ...]. Ties go by the order of the items.
    """
    k = len(sums[0])
    # A partial partition: spread, order, sums from large to small, and where each of them comes from.
    tree: list[tuple] = []
    heap = []
    for n, own in enumerate(sums):
        order = sorted(range(k), key=lambda s: -own[s])
        held = [own[s] for s in order]
        tree.append((None, None, order))
        heap.append((held[-1] - held[0], n, held))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        # Slot i of the left meets slot k - 1 - i of the right.
        both = [left[i] + right[k - 1 - i] for i in range(k)]
        order = sorted(range(k), key=lambda s: -both[s])
        held = [both[s] for s in order]
        tree.append((a, b, order))
        heapq.heappush(heap, (held[-1] - held[0], len(tree) - 1, held))
    _, root, held = heap[0]
    out: list[list[int]] = [[]] * len(sums)
    stack = [(root, list(range(k)))]
    while stack:
        n, place = stack.pop()  # place: the shard of this partition's i-th largest
        a, b, order = tree[n]
        to = [0] * k
        for i, s in enumerate(order):
            to[s] = place[i]
        if a is None:
            out[n] = to
        else:
            stack.append((a, to))
            stack.append((b, to[::-1]))
    return held, out


def _level(items: DataFrame, k: int, block_items: int) -> tuple[DataFrame, int]:
    """items: item long, sums array. Gives item, block, slots of this level (staged) and the number of blocks."""
    n = items.count()
    blocks = max(1, -(-n // block_items))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", F.lit(blocks)), F.lit(blocks)) if blocks > 1 else F.lit(0).cast("long"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item")
        _, slots = differencing([[int(x) for x in s] for s in pdf["sums"]])
        return pd.DataFrame({"item": pdf["item"].to_numpy(), "block": pdf["block"].to_numpy(), "slots": slots, "sums": list(pdf["sums"])})

    out = dealt.groupBy("block").applyInPandas(run, "item bigint, block bigint, slots array<int>, sums array<bigint>")
    return staged(out, "differencing"), blocks


def _level_up(held: list[int], amount: int) -> list[int]:
    """How far each slot lies over the lowest, those over the level to which amount fills them up counted as at it."""
    order = sorted(held)
    level, below = order[0] + amount, order[0]
    for n, h in enumerate(order[1:], 1):
        if h >= level:
            break
        below += h
        level = (amount + below) // (n + 1)
    return [min(h, level) - order[0] for h in held]


def _filled(lights: DataFrame, over: list[int], total: int) -> DataFrame:
    """lights: item, bytes, block. Gives item, bytes, shard, each block closed with its part of `over` by bytes of the total."""
    k = len(over)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item")
        weights = [int(x) for x in pdf["bytes"]]
        # Shards of equal sums are taken in another order by each block, so that what blocks leave over doesn't add up.
        order = np.random.default_rng(int(pdf["block"].iloc[0])).permutation(k).tolist()
        room = [over[s] * sum(weights) // max(total, 1) for s in order]
        _, slots = differencing([[w] + [0] * (k - 1) for w in weights] + [room])
        shard_of = dict(zip(slots[-1], order))
        return pd.DataFrame({"item": pdf["item"].to_numpy(), "bytes": pdf["bytes"].to_numpy(), "shard": [shard_of[s[0]] for s in slots[:-1]]})

    return staged(lights.groupBy("block").applyInPandas(run, "item bigint, bytes bigint, shard int"), "filled")


def _sums(placed: DataFrame, k: int) -> list[int]:
    found = dict(placed.groupBy("shard").agg(F.sum("bytes")).collect())
    return [found.get(s, 0) for s in range(k)]


def balanced(groups: DataFrame, sharding: Sharding = Sharding()) -> DataFrame:
    """groups: item long, bytes long. Gives item, shard int."""
    k = sharding.shards
    n, total = groups.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    # Blocks of fewer groups can't be balanced each.
    block_items = max(sharding.block_items, 16 * k)
    blocks = max(1, -(-n // block_items))
    # Heavier than a shard's share of a block: there are fewer than shards * blocks.
    heavy = groups.select("item", "bytes").filter(F.col("bytes") > total // (k * blocks))
    if blocks == 1 or (heavy := staged(heavy, "heavy")).isEmpty():
        return _by_levels(groups, k, block_items)
    placed = staged(balanced(heavy, sharding).join(heavy, "item").select("item", "bytes", "shard"), "placed-heavy")
    held = _sums(placed, k)
    lights = groups.select("item", "bytes").join(heavy.select("item"), "item", "left_anti")
    lights = staged(lights.withColumn("block", F.pmod(F.xxhash64("item", F.lit(blocks)), F.lit(blocks))), "lights")
    while blocks:
        # Most blocks at once, then fewer and fewer on the sums so far, so that what is left over is that of the last one.
        left = max(1, blocks // 8) if blocks > 1 else 0
        room = total - sum(held)
        part = _filled(lights.filter(F.col("block").between(left, blocks - 1)), _level_up(held, room), room)
        placed = placed.unionByName(part)
        held = [x + y for x, y in zip(held, _sums(part, k))]
        blocks = left
    return placed.select("item", "shard")


def _by_levels(groups: DataFrame, k: int, block_items: int) -> DataFrame:
    items = groups.select("item", F.concat(F.array("bytes"), F.array_repeat(F.lit(0).cast("long"), k - 1)).alias("sums"))
    levels = []
    while True:
        level, blocks = _level(items, k, block_items)
        levels.append(level)
        if blocks == 1:
            break
        parts = level.select("block", F.posexplode("slots").alias("i", "slot"), "sums").select("block", "slot", F.get("sums", F.col("i")).alias("w"))
        totals = parts.groupBy("block").agg(*[F.sum(F.when(F.col("slot") == s, F.col("w")).otherwise(0)).alias(f"s{s}") for s in range(k)])
        items = totals.select(F.col("block").alias("item"), F.array(*[f"s{s}" for s in range(k)]).alias("sums"))
    out = levels[0].select("item", F.col("block").alias("up"), F.col("slots")[0].alias("slot"))
    for level in levels[1:]:
        above = level.select(F.col("item").alias("up"), F.col("block").alias("next"), F.col("slots").alias("to"))
        out = out.join(above, "up").select("item", F.col("next").alias("up"), F.get("to", F.col("slot")).alias("slot"))
    return out.select("item", F.col("slot").alias("shard"))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sharding: Sharding = Sharding()) -> DataFrame:
    """Per row: id, size long (UTF-8 bytes and 1), text_crc32 long, shard int, slot long (gapless from 0 in each shard).

    A null text counts as empty. Rows of equal text (told by a 64-bit hash) share a shard, so a group of more than a
    shard's share of all bytes makes its shard the largest. A group is known by its text's hash, which orders groups
    and deals them to blocks, and slots follow (id, size, crc): the result depends on the rows alone, not on how they
    are partitioned. Rows that agree in these are alike in all that is returned. Repeated rows and null ids are
    carried; other columns are left out. An empty table gives an empty one.
    """
    need(docs, [id_col, text_col])
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("item"))
    rows = staged(rows.withColumn("at", F.monotonically_increasing_id()), "sizes")
    groups = staged(rows.groupBy("item").agg(F.sum("size").alias("bytes")), "groups")
    if groups.isEmpty():
        return rows.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit(None).cast("int").alias("shard"), F.lit(None).cast("long").alias("slot"))
    placed = rows.join(balanced(groups, sharding), "item").drop("item")
    # Rows in order of their slots, in as many parts as there are partitions; `at` only parts rows that are alike.
    order = ["shard", "id", "size", "text_crc32", "at"]
    placed = staged(placed.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "placed")
    # A slot is the rows of its shard in earlier parts, and those before it in its own.
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))  # a row for each shard and part
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy(*order[1:])) - 1
    out = placed.withColumn("within", within).join(before, ["shard", "part"])
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("before") + F.col("within")).cast("long").alias("slot"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents under the law `bytes`; null counts as empty, repeated rows each have a slot, an empty table gives an empty one."""
    out = shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
