"""Operator 12 against a plain Merkle tree, and on odd tables."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sparksift.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, pos string, tree string, size string, kids string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain(rows):
    """doc_id, leaf, subroot, root, proof, folded, verified of every row, by one tree on lists."""
    leaf = lambda r, text: sha("".join(field(x) for x in (r[0], r[3], r[2], r[4], text)))
    lower = lambda s: s and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)

    def climb(hashes):
        """Levels from the leaves to one node."""
        levels = [hashes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
        return levels

    def proof(levels, i, h):
        siblings = []
        for level in levels[:-1]:
            run = level[i // 8 * 8 : i // 8 * 8 + 8]
            siblings += run[: i % 8] + run[i % 8 + 1 :]
            h, i = sha("".join([*run[: i % 8], h, *run[i % 8 + 1 :]])), i // 8
        return siblings, h

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((own, climb([leaf(r, r[1]) for r in own])))
    top = climb([levels[-1][0] for _, levels in trees])
    out = []
    for k, (own, levels) in enumerate(trees):
        for i, r in enumerate(own):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            below, h = proof(levels, i, leaf(r, lower(r[1]) if hit else r[1]))
            above, h = proof(top, k, h)
            root = top[-1][0]
            out.append((r[0], leaf(r, r[1]), levels[-1][0], root, sha("".join(below + above)), h, h == root))
    return sorted(map(repr, out))


def table_of(spark, path, rows):
    spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    return str(path)


def got(df):
    return sorted(repr(tuple(r)) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def row(i, text="Some Text", lang="en", source="s"):
    return (i, text, lang, source, len(text or ""))


@pytest.mark.parametrize(
    "rows",
    [
        [row(5)],
        [row(i, f"Text {i}") for i in range(9)],
        [row(k, f"Doc {k} ÄÖ", lang) for lang, n in (("en", 75), ("é", 8), (None, 1), ("zz", 65)) for k in range(n)],
        # One leaf in each of many trees: a top of two levels.
        [row(k, "T", f"l{k}") for k in range(11)],
        [row(None, "A"), row(None, "A"), row(1, None), row(1, ""), row(2, "Same"), row(2, "Same"), row(2, "Same"), (3, "No", None, None, None), row(4, "long word " * 30_000)],
        # Copies make a third of the rows and more.
        [row(7, "Copy") for _ in range(100)] + [row(k, f"T{k}") for k in range(100)],
    ],
)
def test_manifest_equals_plain_tree(spark, tmp_path, rows):
    assert got(merkle.op12_merkle_manifest(spark, table_of(spark, tmp_path, rows))) == plain(rows)


def test_empty(spark, tmp_path):
    df = merkle.op12_merkle_manifest(spark, table_of(spark, tmp_path, []))
    assert df.count() == 0 and df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_nodes_link_to_their_parents(spark):
    leaves = spark.range(600).select(F.lit("x").alias("lang"), F.col("id").alias("doc_id"), merkle.digest(F.col("id").cast("string")).alias("leaf"), F.lit(None).cast("binary").alias("altered"))
    manifest = merkle.build(leaves.unionByName(leaves.limit(3).withColumn("lang", F.lit("y"))), "lang", ["doc_id"], ["doc_id"])
    nodes = {(r["tree"], r["level"], r["pos"]): r for r in manifest.nodes.collect()}
    assert sorted(nodes) == [(-1, 1, 0)] + [(0, 1, k) for k in range(75)] + [(0, 2, k) for k in range(10)] + [(0, 3, 0), (0, 3, 1), (0, 4, 0), (1, 1, 0)]
    for r in nodes.values():
        if r["up_tree"] is None:
            assert r["tree"] == -1
        else:
            up = nodes[r["up_tree"], r["up_level"], r["up_pos"]]
            assert up["kids"][32 * r["place"] : 32 * r["place"] + 32] == r["hash"]


def test_many_partitions_and_the_callers_settings(spark, tmp_path):
    rows = [row(k % 40, f"Text {k % 50}", ("a", "b")[k % 2]) for k in range(200)]
    path = f"{tmp_path}/many"
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(17).write.parquet(f"{path}/documents.parquet")
    held = spark.conf.get("spark.sql.cteRecursionRowLimit")
    assert got(merkle.op12_merkle_manifest(spark, path)) == plain(rows)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == held
