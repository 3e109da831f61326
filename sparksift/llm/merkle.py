"""Operator 12: a Merkle manifest of a dataset, with proofs checked by a recursive query.

Every row is a leaf. The leaves of a language ascend by id, and every eight consecutive nodes have a parent until one is
left, the language's subroot; subroots ascend by language and give the root in the same way. All levels are stored as
node rows: the digests of a node's children, and the link to its parent with the place that it takes there. A recursive
query then climbs from every leaf to the root: a step joins the parent row, appends the siblings that it holds, and
folds the leaf's digest, tampered with or not, into the parent's.

Siblings above the first level are the same for the eight leaves of a run, so one row of the recursion carries their eight
climbs, with a folded digest each and the siblings once. Digests are binary, 32 bytes each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import need, ranked, shared_dir, staged, stored, table

WIDTH = 8
DIGEST = 32
#: The number of the tree over the subroots; languages have theirs from 0.
TOP = -1


def digest(content: Column) -> Column:
    """SHA-256 of bytes, as bytes."""
    return F.unhex(F.sha2(content, 256))


def of_digests(joined: Column) -> Column:
    """SHA-256 of digests that stand one after the other, each taken as its hexadecimal text."""
    return digest(F.lower(F.hex(joined)))


def field(value: Column) -> Column:
    """- for null, else the number of UTF-8 bytes, a colon and the value; integers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def _linked(nodes: DataFrame, level: int, trees: int) -> DataFrame:
    """nodes (tree, pos, size) with the key of the parent and the place among its children; the root has no parent."""
    inner, sub = F.col("size") > 1, (F.col("tree") != TOP) & F.lit(trees > 1)
    at = lambda x, y: F.when(inner, x).when(sub, y)
    return nodes.withColumns(
        {
            "up_tree": at(F.col("tree"), F.lit(TOP)).cast("long"),
            "up_level": at(F.lit(level + 1), F.lit(1)).cast("int"),
            "up_pos": at(F.floor(F.col("pos") / WIDTH), F.floor(F.col("tree") / WIDTH)).cast("long"),
            "place": at(F.col("pos") % WIDTH, F.col("tree") % WIDTH).cast("int"),
        }
    )


NODE = "tree bigint, pos bigint, size bigint, hash binary, kids binary, up_tree bigint, up_level int, up_pos bigint, place int, level int"


class Manifest:
    """Leaves in runs of eight, and the nodes of all levels, in the shared folder.

    runs: tree, pos (of the run), size (of the tree's leaves), leaves array of (pos, the caller's columns, leaf, altered).
    nodes: as NODE; size is the number of nodes of the level in its tree, so 1 marks a subroot or the root.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/merkle-{uuid.uuid4().hex}"
        self.trees, self.runs_path = 0, ""

    @property
    def nodes(self) -> DataFrame:
        return self.spark.read.schema(NODE).parquet(self.root)

    @property
    def runs(self) -> DataFrame:
        return self.spark.read.parquet(self.runs_path)

    def subroots(self) -> DataFrame:
        """tree, subroot."""
        alone = self.runs.filter("size = 1").select("tree", F.col("leaves")[0]["leaf"].alias("subroot"))
        return self.nodes.filter(f"size = 1 AND tree <> {TOP}").select("tree", F.col("hash").alias("subroot")).unionByName(alone)

    def root_hash(self) -> Column:
        """The root as a literal."""
        top = self.nodes.filter("up_tree IS NULL").select("hash") if self.trees > 1 else self.subroots().select("subroot")
        return F.lit(bytes(top.first()[0]))

    def add(self, groups: DataFrame, level: int, part: str) -> DataFrame:
        """groups: tree, pos, size (of the level), kids. Stores the nodes."""
        path = f"{self.root}/tier={part}/level={level}"
        rows = _linked(groups.withColumn("hash", of_digests(F.col("kids"))), level, self.trees)
        rows.select(*[c.split(" ")[0] for c in NODE.split(", ")][:-1]).write.option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def grow(self, nodes: DataFrame, level: int, most: int, part: str) -> None:
        """Levels over nodes (tree, pos, size, hash) of which a tree has at most `most`, until each tree has one node."""
        while most > 1:
            kids = F.array_sort(F.collect_list(F.struct("pos", "hash")))  # eight at most
            runs = nodes.filter("size > 1").groupBy("tree", F.floor(F.col("pos") / WIDTH).alias("up")).agg(kids.alias("k"), F.first("size").alias("s"))
            level, most = level + 1, -(-most // WIDTH)
            nodes = self.add(runs.select("tree", F.col("up").alias("pos"), F.ceil(F.col("s") / WIDTH).alias("size"), F.unhex(F.array_join(F.transform("k", lambda x: F.hex(x["hash"])), "")).alias("kids")), level, part)


def build(leaves: DataFrame, tree_by: str, order: list[str], carry: list[str]) -> Manifest:
    """leaves: tree_by, order, carry, leaf binary, altered binary (null where the leaf is as it was) to a stored manifest.

    Trees are numbered by tree_by, null first; in a tree leaves ascend by order and then by leaf, nulls first. Rows that
    agree in all are alike, so which of them comes first changes no digest. An empty table gives a manifest without nodes.
    """
    out = Manifest(leaves.sparkSession)
    placed = staged(ranked(leaves, [tree_by], [*order, "leaf"], "leaves"), "leaves-ranked")
    sizes = ranked(placed.groupBy(tree_by).agg(F.first("size").alias("held")), [], [tree_by], "trees")
    sizes = staged(sizes.select(F.col(tree_by).alias("of"), F.col("pos").alias("tree"), "held"), "trees-ranked")
    out.trees, most = sizes.agg(F.count("*"), F.max("held")).first()
    rows = placed.join(sizes, F.col(tree_by).eqNullSafe(F.col("of"))).withColumn("run", F.floor(F.col("pos") / WIDTH))
    run = F.array_sort(F.collect_list(F.struct("pos", *[c for c in dict.fromkeys(carry) if c != "pos"], "leaf", "altered")))  # eight at most
    out.runs_path = stored(rows.groupBy("tree", "run").agg(F.first("size").alias("size"), run.alias("leaves")).withColumnRenamed("run", "pos"), "runs")
    # Trees of one leaf have no node of their own; an empty part keeps the table of nodes readable.
    first = out.runs.filter("size > 1").select("tree", "pos", F.ceil(F.col("size") / WIDTH).alias("size"), _kids(F.col("leaves")).alias("kids"))
    level = out.add(first, 1, "languages")
    out.grow(level, 1, -(-(most or 0) // WIDTH), "languages")
    tops = staged(out.subroots().select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(out.trees).cast("long").alias("size"), F.col("subroot").alias("hash")), "subroots")
    out.grow(tops, 0, out.trees, "top")
    return out


def _kids(leaves: Column) -> Column:
    return F.unhex(F.array_join(F.transform(leaves, lambda x: F.hex(x["leaf"])), ""))


#: One digest at a place among joined ones: what stands before it, and behind it.
BEFORE, BEHIND = f"substring({{0}}, 1, {DIGEST} * {{1}})", f"substring({{0}}, {DIGEST} * {{1}} + {DIGEST + 1})"

CLIMB = f"""WITH RECURSIVE climb(tree, run, subroot, folded, above, up_tree, up_level, up_pos, place) AS (
  SELECT tree, pos, subroot, folded, CAST('' AS BINARY), up_tree, up_level, up_pos, place FROM {{runs}}
  UNION ALL
  SELECT c.tree, c.run, CASE WHEN n.tree = c.tree AND n.size = 1 THEN n.hash ELSE c.subroot END,
    transform(c.folded, h -> unhex(sha2(lower(hex(concat({BEFORE.format("n.kids", "c.place")}, h, {BEHIND.format("n.kids", "c.place")}))), 256))),
    concat(c.above, {BEFORE.format("n.kids", "c.place")}, {BEHIND.format("n.kids", "c.place")}),
    n.up_tree, n.up_level, n.up_pos, n.place
  FROM climb c JOIN {{nodes}} n ON n.tree = c.up_tree AND n.level = c.up_level AND n.pos = c.up_pos)
SELECT tree, run, subroot, folded, above FROM climb WHERE up_level IS NULL"""


def climbed(manifest: Manifest) -> DataFrame:
    """tree, run, subroot, folded (the digests that the leaves of a run lead to at the root), above (siblings from the second level to the root).

    A recursive query ends by itself where no parent is left, after as many steps as there are levels (22 for 2**64
    leaves). Spark bounds the rows of a recursion by a setting, which a session of its own lifts; the caller's stays.
    """
    own = manifest.spark.newSession()
    own.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    own.conf.set("spark.sql.shuffle.partitions", manifest.spark.conf.get("spark.sql.shuffle.partitions"))
    runs = own.read.parquet(manifest.runs_path).withColumn("kids", _kids(F.col("leaves")))
    tampered = F.transform("leaves", lambda x: F.coalesce(x["altered"], x["leaf"]))
    swapped = F.expr(f"transform(tampered, (h, i) -> unhex(sha2(lower(hex(concat({BEFORE.format('kids', 'i')}, h, {BEHIND.format('kids', 'i')}))), 256)))")
    start = runs.withColumn("tampered", tampered).withColumn("folded", F.when(F.col("size") > 1, swapped).otherwise(F.col("tampered")))
    first = start.filter("size > 1").withColumn("size", F.ceil(F.col("size") / WIDTH)).withColumn("subroot", F.when(F.col("size") == 1, of_digests(F.col("kids"))))
    alone = start.filter("size = 1").withColumn("subroot", F.col("leaves")[0]["leaf"])
    start = _linked(first, 1, manifest.trees).unionByName(_linked(alone, 0, manifest.trees))
    nodes = own.read.schema(NODE).parquet(manifest.root)
    path = stored(own.sql(CLIMB, runs=start.drop("leaves", "kids", "tampered"), nodes=nodes), "climbed")
    return manifest.spark.read.parquet(path)


def proofs(manifest: Manifest, carry: list[str]) -> DataFrame:
    """Per leaf: carry, leaf, subroot, root, folded_root, siblings (digests from the leaf's level up, left to right, joined)."""
    up = climbed(manifest).withColumnsRenamed({"tree": "up_tree", "run": "up_run"})
    own = manifest.runs.withColumn("kids", F.when(F.col("size") > 1, _kids(F.col("leaves"))).otherwise(F.lit(b"")))
    rows = own.join(up, (F.col("tree") == F.col("up_tree")) & (F.col("pos") == F.col("up_run")))
    each = rows.select("kids", "folded", "above", "subroot", F.posexplode("leaves").alias("i", "l"))
    siblings = F.expr(f"concat({BEFORE.format('kids', 'i')}, {BEHIND.format('kids', 'i')}, above)")
    return each.select(*[F.col(f"l.{c}").alias(c) for c in carry], F.col("l.leaf").alias("leaf"), "subroot", manifest.root_hash().alias("root"), F.get("folded", F.col("i")).alias("folded_root"), siblings.alias("siblings"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A-Z to a-z, and nothing else.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents. Nulls are the field `-`; a null id comes first in its language and is never tampered with, a null
    language is the first tree. Repeated rows are leaves of their own. An empty table gives an empty result. Long texts are
    hashed whole by the executors that read them; no digest depends on how the table is partitioned."""
    docs = table(spark, sf_dir, "documents")
    need(docs, FIELDS)
    lowered = F.translate("text", UPPER, LOWER)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaf = leaf_of([F.col(c) for c in FIELDS])
    altered = F.when(hit & (lowered != F.col("text")), leaf_of([F.col(c) if c != "text" else lowered for c in FIELDS]))
    manifest = build(docs.select("doc_id", "lang", leaf.alias("leaf"), altered.alias("altered")), "lang", ["doc_id"], ["doc_id"])
    if not manifest.trees:
        return docs.limit(0).selectExpr("doc_id", *(f"CAST(NULL AS STRING) AS {c}" for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), "CAST(NULL AS BOOLEAN) AS verified")
    hexed = lambda c: F.lower(F.hex(c))
    rows = proofs(manifest, ["doc_id"])
    return rows.select("doc_id", *[hexed(c).alias(c) for c in ("leaf", "subroot", "root")], F.sha2(hexed("siblings"), 256).alias("proof_sha256"), hexed("folded_root").alias("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql(levels: int = 9, tops: int = 4) -> str:
    """The same in SQL, for tables of up to 8**levels leaves a language and 8**tops languages."""
    enc = lambda t: " || ".join(f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')" for x in (*FIELDS[:-1], t))
    out = [
        f"d AS (SELECT doc_id, lang, sha256({enc('text')}) AS leaf, sha256({enc(f'translate(text, {UPPER!r}, {LOWER!r})')}) AS low FROM documents)",
        "r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, count(*) OVER (PARTITION BY lang) AS n FROM d)",
        "c AS (SELECT doc_id, leaf, low, p, t FROM r)",
        "a0 AS (SELECT t, p AS i, leaf AS h, n FROM r)",
    ]
    # A level: where one node is left, it stays as it is.
    step = lambda k, a, b: f"{b} AS (SELECT t, i // 8 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, (any_value(n) + 7) // 8 AS n FROM {a} GROUP BY t, i // 8)"
    for k in range(levels):
        out.append(step(k, f"a{k}", f"a{k + 1}"))
    out.append(f"b0 AS (SELECT 0 AS t, t AS i, h, (SELECT count(*) FROM a{levels}) AS n FROM a{levels})")
    for k in range(tops):
        out.append(step(k, f"b{k}", f"b{k + 1}"))
    crc = "(SELECT list_reduce(list_prepend(4294967295, b), lambda x, y: xor(x >> 8, tab[(xor(x, y) & 255) + 1])) FROM tb)"
    out.append(
        "tb AS (SELECT list(list_reduce(list_prepend(k, [1, 2, 3, 4, 5, 6, 7, 8]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY k) AS tab FROM generate_series(0::BIGINT, 255) AS g(k))"
    )
    out.append(f"u AS (SELECT doc_id, leaf, t, p, b, xor({crc}, 4294967295) AS crc, low FROM (SELECT *, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda k: ascii(substring(doc_id::VARCHAR, k, 1))::BIGINT) AS b FROM c))")
    out.append("f0 AS (SELECT doc_id, leaf, t, p, p AS i, CASE WHEN crc % 3 = 0 THEN coalesce(low, leaf) ELSE leaf END AS h, '' AS s FROM u)")
    runs = lambda a: f"SELECT t, i // 8 AS g, list(h ORDER BY i) AS hs, any_value(n) AS n FROM {a} GROUP BY t, i // 8"
    fold = "CASE WHEN g.n > 1 THEN sha256(array_to_string(list_concat(list_concat(g.hs[1:{m}], [f.h]), g.hs[{m} + 2:]), '')) ELSE f.h END AS h, CASE WHEN g.n > 1 THEN f.s || array_to_string(list_concat(g.hs[1:{m}], g.hs[{m} + 2:]), '') ELSE f.s END AS s".format(m="(f.i % 8)")
    for k in range(levels):
        out.append(f"f{k + 1} AS (SELECT f.doc_id, f.leaf, f.t, f.p, f.i // 8 AS i, {fold} FROM f{k} f JOIN ({runs(f'a{k}')}) g ON g.t = f.t AND g.g = f.i // 8)")
    out.append(f"g0 AS (SELECT doc_id, leaf, f{levels}.t AS sub, p, f{levels}.t AS i, h, s FROM f{levels})")
    for k in range(tops):
        out.append(f"g{k + 1} AS (SELECT f.doc_id, f.leaf, f.sub, f.p, f.i // 8 AS i, {fold} FROM g{k} f JOIN ({runs(f'b{k}')}) g ON g.g = f.i // 8)")
    return f"WITH {', '.join(out)} SELECT doc_id, leaf, a.h AS subroot, b.h AS root, sha256(g.s) AS proof_sha256, g.h AS folded_root, g.h = b.h AS verified FROM g{tops} g JOIN a{levels} a ON a.t = g.sub, b{tops} b"


OP12_SQL = _sql()
