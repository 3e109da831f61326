"""Report bundles: evidence, parts under two caps, manifests."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.storage import written
from .ranges import OWN, in_ranges, same, with_sums


def with_evidence(confirmed: DataFrame, evidence: DataFrame, key: str, ref: str) -> DataFrame:
    """confirmed rows with a sorted array of evidence references; an empty array where there is none."""
    grouped = evidence.groupBy(key).agg(F.array_sort(F.collect_list(ref)).alias("evidence"))
    return confirmed.join(grouped, key, "left").withColumn("evidence", F.coalesce("evidence", F.array().cast("array<string>")))


def evidence_parts(evidence: DataFrame, key: str, ref: str, config: Config) -> DataFrame:
    """key, part_no, refs: the references of a key in order, at most max_links to a row, so a key of any number is a number of rows."""
    numbered = split_links(evidence.select(key, ref), key, [ref], config)
    return numbered.groupBy(key, "part_no").agg(F.array_sort(F.collect_list(ref)).alias("refs"))


def split_links(items: DataFrame, bundle: str, order: list[str], config: Config) -> DataFrame:
    """part_no by the cap on links alone. Rows are sorted by ranges and numbered by the sums of earlier ranges, so no task sorts a whole bundle."""
    numbered = with_sums(in_ranges(items, [bundle], order), [bundle], {"_n": F.lit(1)})
    return numbered.withColumn("part_no", F.floor((F.col("_n") - 1) / config.max_links).cast("long")).drop("_n", OWN)


def parts_of(sizes: list[int], max_links: int, max_bytes: int) -> list[int]:
    """Greedy parts: a new one opens when either cap would be passed; an item over the cap is alone."""
    out, part, links, held = [], 0, 0, 0
    for size in sizes:
        if links and (links + 1 > max_links or held + size > max_bytes):
            part, links, held = part + 1, 0, 0
        links, held = links + 1, held + size
        out.append(part)
    return out


#: Rows of a bundle that a task takes at a time, at least twice the links of a part.
BLOCK = 65_536


def split_dual(items: DataFrame, bundle: str, order: str, size: str, config: Config, block: int = BLOCK) -> DataFrame:
    """bundle, order, size to the same and part_no, by both caps: greedy, so an item opens a part where either cap would be passed.

    Where the next part opens follows from where this one does, and is found in the prefix sums; so items are taken in
    blocks of a bundle. A block says, for each place at which a part from before can end in it (its first max_links
    places), where the first part behind the block opens and how many parts lie between. These pointers, few for each block,
    are followed from the bundle's first item by doubling, in the logarithm of a bundle's blocks many rounds. Then each
    block, told where the first part opens in it, numbers its own items. A null size is 0; a null bundle is a bundle.
    """
    block = max(block, 2 * config.max_links)
    narrow = items.select(F.col(bundle).alias("bundle"), F.col(order).alias("item"), F.col(size).cast("long").alias("bytes"))
    summed = with_sums(in_ranges(narrow, ["bundle"], ["item"]), ["bundle"], {"n": F.lit(1), "upto": F.coalesce("bytes", F.lit(0))})
    rows = written(summed.drop(OWN).withColumn("n", F.col("n") - 1).withColumn("block", F.floor((F.col("n")) / block)), "summed")
    kind = dict(narrow.dtypes)["bundle"]

    def opens(n: np.ndarray, bytes_: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """For each row of a run the row at which the next part opens if one opens here; the run's length if that is beyond it."""
        rows_ = np.arange(len(n))
        by_bytes = np.searchsorted(upto, upto - bytes_ + config.max_bytes, side="right")
        return np.minimum(np.maximum(by_bytes, rows_ + 1), np.minimum(rows_ + config.max_links, len(n)))

    def taken(t: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
        t = t.sort_by("n")
        return t, *(pc.fill_null(t.column(c), 0).to_numpy() for c in ("n", "bytes", "upto"))

    blocks = 1 + (rows.agg(F.max("block")).first()[0] or 0)
    # The rows behind a block that its last parts may reach into come with it.
    halo = F.when((F.col("n") % block < config.max_links) & (F.col("block") > 0), F.array("block", F.col("block") - 1)).otherwise(F.array("block"))

    def leave(t: pa.Table) -> pa.Table:
        t, n, size_, upto = taken(t)
        first = int(t.column("of")[0].as_py()) * block
        end = min(block, len(n))
        to = opens(n, size_, upto)
        out, parts = to.copy(), np.ones(len(n), np.int64)
        for k in range(end - 1, -1, -1):  # from the back, so that what lies ahead is known
            if to[k] < end:
                out[k], parts[k] = out[to[k]], parts[to[k]] + 1
        gates = min(config.max_links, end) if first else 1
        if end == len(n):
            gates = 0  # no block follows
        # Where the rest of a bundle belongs to a part from before, that leads to the place behind the bundle's last item.
        return pa.table({"bundle": t.column("bundle").slice(0, gates), "at": n[:gates], "to": n[0] + out[:gates], "parts": parts[:gates]})

    # Where parts open first in each block, with their number: known for the first block, then for 1, 2, 4 and so on more.
    reached, hops = rows.filter("n = 0").select("bundle", F.col("n").alias("at"), F.lit(0).cast("long").alias("part")), blocks - 1
    if hops:
        dealt = rows.withColumn("of", F.explode(halo))
        jump = written(dealt.groupBy("bundle", "of").applyInArrow(leave, f"bundle {kind}, at bigint, to bigint, parts bigint"), "pointers")
    while hops:
        on = jump.select(F.col("bundle").alias("b"), F.col("at").alias("a"), F.col("to").alias("t"), F.col("parts").alias("p"))
        nxt = reached.join(on, same(["bundle"], ["b"]) & (F.col("at") == F.col("a"))).select("bundle", F.col("t").alias("at"), (F.col("part") + F.col("p")).alias("part"))
        reached = written(reached.unionByName(nxt).distinct(), "reached")
        hops //= 2
        if hops:
            twice = jump.join(on, same(["bundle"], ["b"]) & (F.col("to") == F.col("a"))).select("bundle", "at", F.col("t").alias("to"), (F.col("parts") + F.col("p")).alias("parts"))
            jump = written(twice, "pointers")

    def number(t: pa.Table) -> pa.Table:
        t, n, size_, upto = taken(t)
        to, gate = opens(n, size_, upto), int(t.column("gate")[0].as_py() - n[0])
        part = np.zeros(len(n), np.int64)
        while gate < len(n):
            part[gate] = 1
            gate = to[gate]
        first = int(t.column("first")[0].as_py())
        return pa.table({"bundle": t.column("bundle"), "item": t.column("item"), "bytes": t.column("bytes"), "part_no": first - 1 + np.cumsum(part)})

    if blocks == 1:
        held = rows.withColumns({"gate": F.lit(0).cast("long"), "first": F.lit(0).cast("long")})
        return held.groupBy("bundle").applyInArrow(number, f"bundle {kind}, item {dict(narrow.dtypes)['item']}, bytes bigint, part_no bigint")
    gates = reached.select(F.col("bundle").alias("b"), F.floor(F.col("at") / block).alias("of"), F.col("at").alias("gate"), F.col("part").alias("first"))
    held = rows.join(gates, same(["bundle"], ["b"]) & (F.col("block") == F.col("of"))).select("bundle", "item", "bytes", "n", "upto", "block", "gate", "first")
    return held.groupBy("bundle", "block").applyInArrow(number, f"bundle {kind}, item {dict(narrow.dtypes)['item']}, bytes bigint, part_no bigint")


def part_counters(parts: DataFrame) -> DataFrame:
    return parts.groupBy("bundle", "part_no").agg(F.count("*").alias("links"), F.sum("bytes").alias("bytes"))


def running_bytes(items: DataFrame, key: str, order: str, size: str) -> DataFrame:
    """items with the bytes of their key up to each, by ranges as in split_links."""
    return with_sums(in_ranges(items, [key], [order]), [key], {"running": F.col(size)}).drop(OWN)
