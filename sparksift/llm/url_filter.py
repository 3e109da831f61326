"""Operator 3: URL filter by mined association rules. DataFrame and SQL functions only; FP-growth runs in the JVM.

A short list of host and path rules judges what it fits. Its verdicts label those urls. Tokens that the same labelled
urls hold are one class: a rule on one of them has the support and confidence of a rule on any of them, so FP-growth
mines combinations of classes, a class fits a url that holds one of its tokens, and no verdict changes by it. A part
that all urls of a site share thus counts once, however many tokens it has. Rules under the support or confidence bound
go, and those that don't raise their label above its share (lift). Every distinct class set is then matched through an
inverted index that files each mined rule under its rarest class; a hit is verified against the whole antecedent. The
best rule (confidence, then support) gives the verdict where no listed rule fits, and `default` does where no mined one
does either.

Itemsets are at most 2 to the number of classes that a url holds, for each distinct class set; classes of labelled urls
are bounded by tokens a url over min_support.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import need, staged, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Listed rules: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


#: Token sets with a mined verdict, and rules, that may be broadcast; beyond it they are joined by a shuffle.
BROADCAST_SETS = 50_000
#: Copies of a token set that one row stands for on the way to FP-growth.
COPIES = 65_536


@dataclass(frozen=True)
class Mining:
    min_support: float = 0.01
    min_confidence: float = 0.8
    over_lift: float = 1 + 1e-9
    default: str = "allow"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest listed rule that fits, and its verdict; nulls if none does. The list is a parameter and becomes part of the plan."""
    best, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        best, verdict = F.when(fits, F.lit(h + p)).otherwise(best), F.when(fits, F.lit(v)).otherwise(verdict)
    return best, verdict


def tokens_of(host: Column, path: Column) -> Column:
    """Sorted distinct tokens: labels of the host, its last label as domain, path parts (numbers and endings as classes)."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    top = F.array(F.concat(F.lit("t:"), F.regexp_extract(host, r"([^.]*)$", 1)))
    parts = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "9")))
    return F.array_sort(F.array_distinct(F.concat(labels, top, parts)))


def forms_of(judged: DataFrame) -> DataFrame:
    """form (a hash of items and listed), items, listed, n: distinct token sets with their listed verdict and rows."""
    forms = judged.groupBy("items", "listed").agg(F.count("*").alias("n"))
    return forms.select(F.xxhash64("items", "listed").alias("form"), "items", "listed", "n")


def classes_of(labelled: DataFrame, least: float) -> DataFrame:
    """token, class, n: tokens of at least `least` rows; those of the same rows have one class, named by the first of them."""
    tokens = labelled.select("form", "n", F.explode("items").alias("token")).groupBy("token").agg(
        F.sum("n").alias("n"), F.bit_xor(F.xxhash64(F.lit(1), "form")).alias("one"), F.bit_xor(F.xxhash64(F.lit(2), "form")).alias("other")
    )
    # Equal sets of forms are told by two 64-bit hashes and the number of rows.
    tokens = tokens.filter(F.col("n") >= least)
    names = tokens.groupBy("n", "one", "other").agg(F.min("token").alias("class"))
    return tokens.join(names, ["n", "one", "other"]).select("token", "class", "n")


def in_classes(forms: DataFrame, classes: DataFrame, *keep: str) -> DataFrame:
    """keep, classes: the class set of each form that holds a token with a class."""
    held = forms.select("form", *keep, F.explode("items").alias("token")).join(F.broadcast(classes.select("token", "class")), "token")
    return held.groupBy("form", *keep).agg(F.array_sort(F.collect_set("class")).alias("classes"))


def mined_rules(sets: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """antecedent array, verdict, confidence, support of rules from class sets to a label. sets: classes array, label string, n rows."""
    grouped = sets.groupBy("classes", "label").agg(F.sum("n").alias("n"))
    items = F.concat("classes", F.array(F.concat(F.lit("y:"), "label"))).alias("items")
    # A set comes once a row that has it. Sets with many rows are laid out in two steps, dealt over the tasks between them.
    some = grouped.select(items, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))).alias("at"))
    dealt = some.select("items", F.least(F.lit(COPIES), F.col("n") - COPIES * F.col("at")).cast("int").alias("times"), "at").repartition("items", "at")
    rows = dealt.select("items", F.explode(F.array_repeat(F.lit(True), F.col("times")))).select("items")
    model = FPGrowth(itemsCol="items", minSupport=mining.min_support, minConfidence=mining.min_confidence).fit(rows)
    # Rules on labels are few; those whose antecedent holds a label say nothing about a url.
    rules = model.associationRules.filter((F.col("lift") > mining.over_lift) & F.col("consequent")[0].startswith("y:"))
    return rules.filter(~F.exists("antecedent", lambda x: x.startswith("y:"))).select(
        F.array_sort("antecedent").alias("antecedent"), F.substring(F.col("consequent")[0], 3, 1 << 20).alias("verdict"), "confidence", "support"
    )


def small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if its rows are counted to be few. df is a written table."""
    return F.broadcast(df) if df.count() <= BROADCAST_SETS else df


def matched(sets: DataFrame, rules: DataFrame, frequency: DataFrame) -> DataFrame:
    """classes, verdict of each distinct class set that a rule fits. frequency: class, n."""
    filed = (
        rules.withColumn("rule", F.xxhash64("antecedent", "verdict"))
        .withColumn("class", F.explode("antecedent"))
        .join(F.broadcast(frequency), "class")
        .groupBy("rule")
        .agg(F.min(F.struct("n", "class", "antecedent", "verdict", "confidence", "support")).alias("r"))
        .select("r.class", "r.antecedent", "r.verdict", "r.confidence", "r.support")
    )
    filed = small(staged(filed, "rules"))
    hits = sets.withColumn("class", F.explode("classes")).join(filed, "class").filter(F.size(F.array_except("antecedent", "classes")) == 0)
    return hits.groupBy("classes").agg(F.max(F.struct("confidence", "support", "verdict")).alias("best")).select("classes", F.col("best.verdict").alias("mined"))


def verdicts(labelled: DataFrame, asked: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """items, mined: the verdicts that rules mined from labelled forms (form, items, listed, n) give to asked ones (form, items), where a rule fits."""
    rows = labelled.agg(F.sum("n")).first()[0]
    classes = staged(classes_of(labelled, math.ceil(mining.min_support * rows)), "classes")
    # Rows without a class stay, in the count that supports are shares of.
    sets = labelled.join(in_classes(labelled, classes), "form", "left")
    rules = mined_rules(sets.select(F.coalesce("classes", F.array().cast("array<string>")).alias("classes"), F.col("listed").alias("label"), "n"), mining)
    held = staged(in_classes(asked, classes, "items"), "asked")
    best = matched(held.select("classes").distinct(), rules, classes.groupBy("class").agg(F.max("n").alias("n")))
    return held.join(best, "classes").select("items", "mined")


def judged_urls(pages: DataFrame, rules, id_col: str, url_col: str) -> DataFrame:
    """id, host, path, rule, listed, items of each row."""
    urls = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    return urls.select("id", "host", "path", rule.alias("rule"), verdict.alias("listed"), tokens_of(F.col("host"), F.col("path")).alias("items"))


def filter_urls(pages: DataFrame, rules=RULES, mining: Mining = Mining(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, rule (null if no listed rule fits), verdict.

    A null url, or one without ://, has an empty host and path: no listed rule fits, and the default or a mined rule
    on empty tokens judges it. Repeated rows each give a row; other columns are left out, so their names can't clash.
    With no labelled url, or with one label on all of them, nothing is mined and the default judges the rest. An empty
    table gives an empty one.
    """
    need(pages, [id_col, url_col])
    judged = judged_urls(pages, rules, id_col, url_col)
    forms = staged(forms_of(judged), "forms")
    labelled = forms.filter(F.col("listed").isNotNull())
    if labelled.isEmpty():
        return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("listed", F.lit(mining.default)).alias("verdict"))
    # Copies of a host and path form have one token set, which may be that of a third of all urls.
    found = small(staged(verdicts(labelled, forms.filter(F.col("listed").isNull()), mining), "verdicts"))
    out = judged.join(found, "items", "left")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("listed", "mined", F.lit(mining.default)).alias("verdict"))


def held_out(pages: DataFrame, rules=RULES, mining: Mining = Mining(), folds: int = 5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """verdict, n, n_right: how the rules mined from all but a fold of the labelled token sets judge the rows of that fold.

    Rows that no mined rule fits have the default verdict. Nothing labelled, or nothing left to mine from, gives no row."""
    need(pages, [id_col, url_col])
    forms = staged(forms_of(judged_urls(pages, rules, id_col, url_col)).filter(F.col("listed").isNotNull()), "labelled")
    fold = F.pmod(F.xxhash64("items"), F.lit(folds))
    learned, asked = forms.filter(fold != 0), forms.filter(fold == 0)
    if learned.isEmpty():
        return asked.select(F.col("listed").alias("verdict"), "n", F.col("n").alias("n_right")).filter(F.lit(False))
    verdict = F.coalesce("mined", F.lit(mining.default))
    out = asked.join(verdicts(learned, asked, mining), "items", "left").select(verdict.alias("verdict"), "n", F.when(verdict == F.col("listed"), F.col("n")).otherwise(0).alias("right"))
    return out.groupBy("verdict").agg(F.sum("n").alias("n"), F.sum("right").alias("n_right"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of pages; null urls and those without :// have an empty host and path. Repeated rows each give a row, an empty table gives an empty one."""
    return filter_urls(table(spark, sf_dir, "pages"))


_CASES = "\n".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'r': '{h}{p}', 'v': '{v}'}}" for h, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1])))
OP3_SQL = rf"""
WITH u AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
j AS (SELECT page_id, host, path, CASE {_CASES} END AS r,
        list_sort(list_distinct(list_concat(list_transform(string_split(host, '.'), lambda x: 'h:' || x), ['t:' || regexp_extract(host, '([^.]*)$', 1)],
          list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'p:' || regexp_replace(x, '[0-9]+', '9', 'g'))))) AS items FROM u),
s AS (SELECT page_id, r, list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1) AS a
      FROM j, unnest(generate_series(1, (1 << len(items)) - 1)) AS g(m)),
n AS (SELECT count(*) AS n FROM j WHERE r IS NOT NULL),
a AS (SELECT a, count(*) AS c FROM s WHERE r IS NOT NULL GROUP BY a),
av AS (SELECT a, r.v AS v, count(*) AS c FROM s WHERE r IS NOT NULL GROUP BY a, r.v),
rules AS (SELECT av.a, av.v, av.c::DOUBLE / a.c AS conf, av.c AS c FROM av JOIN a USING (a) CROSS JOIN n
          JOIN (SELECT r.v AS v, count(*) AS all_v FROM j WHERE r IS NOT NULL GROUP BY r.v) AS share ON share.v = av.v
          WHERE av.c >= ceil(0.01 * n.n) AND av.c::DOUBLE / a.c >= 0.8 AND av.c::DOUBLE * n.n > (1 + 1e-9) * a.c * all_v),
best AS (SELECT page_id, max({{'conf': conf, 'c': rules.c, 'v': rules.v}}) AS b FROM s JOIN rules USING (a) WHERE s.r IS NULL GROUP BY page_id)
SELECT j.page_id, host, path, j.r.r AS rule, coalesce(j.r.v, best.b.v, 'allow') AS verdict FROM j LEFT JOIN best USING (page_id)
"""
