"""Connected components by repeated contraction of edge tables; nothing of them is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v long. Gives node, label: label is one node of the component, the same for all its nodes.

    Each round maps a node to that of its neighbours and itself which a hash puts first, and the edges to the images of
    their ends. A hash serves two rounds, in which a star shrinks to its first node; with a new one every other round a
    chain loses half of its nodes a round on the average, in whatever order it is numbered. So rounds grow with the
    logarithm of the nodes. Maps, labels and edges of every round are written to the shared folder. Self-loops and
    repeated edges count for nothing; an empty table gives an empty one.
    """
    edges = staged(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    labels, turn = edges.select(F.col("u").alias("node"), F.col("u").alias("label")).limit(0), 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = lambda x: F.struct(F.xxhash64(x, F.lit(turn // 2)).alias("h"), x.alias("n"))  # noqa: B023, E731
        to = both.groupBy("u").agg(F.min(first(F.col("v"))).alias("a")).select(F.col("u").alias("node"), F.least("a", first(F.col("u")))["n"].alias("to"))
        to = staged(to, "map")
        if turn:
            nxt = to.select(F.col("node").alias("label"), F.col("to"))
            labels = staged(labels.join(nxt, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        else:
            labels = to.withColumnRenamed("to", "label")
        left = to.select(F.col("node").alias("u"), F.col("to").alias("a"))
        right = to.select(F.col("node").alias("v"), F.col("to").alias("b"))
        moved = edges.join(left, "u").join(right, "v").filter("a <> b")
        edges = staged(moved.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
        turn += 1
    return labels
