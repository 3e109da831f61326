"""The Jaccard join and the pipeline against brute force."""

import collections
import hashlib
import math
import random
import re
from array import array

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from sparksift.llm import jaccard_join, quality, toxicity
from sparksift.llm.common import table

from ..conftest import SF_DIR
from .test_rules import plainly_cut

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingled(text):
    w = WORD.findall((text or "").encode().lower())
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """Links and class (least id) of each row by number; ids must be distinct or null-free."""
    sets = [shingled(t) for _, t in rows]
    links, parent = collections.Counter(), list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                parent[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), i), i)
    return sorted((rows[k][0], least[top(k)], links[k]) for k in range(len(rows)))


def copies(seed=7):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    out = []
    for n in (30, 80, 300):
        base = [word() for _ in range(n)]
        for k in range(12):
            own = list(base)
            for _ in range(k * n // 200 + (k > 0)):
                own[rnd.randrange(n)] = word()
            out.append(" ".join(own))
            if k % 4 == 0:
                out.append(" ".join(own).upper() + "!")
    passage = " ".join(word() for _ in range(60))
    out += [f"{' '.join(word() for _ in range(40))} {passage} {' '.join(word() for _ in range(40))}" for _ in range(10)]
    return out


def test_join_equals_brute_force(spark, documents, edge_rows):
    rows = [(k, t) for k, t in enumerate([t for _, t in edge_rows if t is None or len(t) < 1000] + copies())]
    for join in (jaccard_join.Join(), jaccard_join.Join(block=3, text_block=600)):
        got = jaccard_join.near_duplicates(documents(rows), join=join).collect()
        assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == brute(rows)
    kept = jaccard_join.one_of_each(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _ in brute(rows)})


def test_a_chain_of_near_misses_stays_linear(spark, documents, monkeypatch):
    """Texts that slide along a passage: neighbours come near the threshold, none reaches it; rows of the last tasks grow with the texts."""
    rnd = random.Random(12)
    sent = []
    verified = jaccard_join._verified

    def counted(tasks, join):
        sent.append(tasks.count())
        return verified(tasks, join)

    monkeypatch.setattr(jaccard_join, "_verified", counted)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(100 + 16 * 240)]
    for n in (120, 240):
        rows = [(k, " ".join(words[16 * k : 16 * k + 100])) for k in range(n)]
        got = jaccard_join.near_duplicates(documents(rows), join=jaccard_join.Join(text_block=4000)).collect()
        assert {r["n_links"] for r in got} == {0} and len({r["class_id"] for r in got}) == n
    assert 0 < sent[1] <= 2.4 * sent[0] and sent[1] <= 5 * 240


def test_components_of_chains_and_stars(spark, monkeypatch):
    """A chain numbered in order is done in rounds that grow with the logarithm; labels are those of a plain search."""
    from sparksift.llm import components as cc

    maps, staged = [], cc.staged
    monkeypatch.setattr(cc, "staged", lambda df, label: (maps.append(label), staged(df, label))[1])
    edges = [(k, k + 1) for k in range(1000)] + [(5000, 5001 + k) for k in range(300)] + [(7000, 7001), (7001, 7000), (7002, 7002)]
    got = cc.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    label = {r["node"]: r["label"] for r in got}
    assert len(got) == len(label) == 1001 + 301 + 2
    assert len({label[k] for k in range(1001)}) == 1 and len({label[5000 + k] for k in range(301)}) == 1 and label[7000] == label[7001]
    assert len(set(label.values())) == 3 and maps.count("map") <= 20
    assert cc.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_join_edges(spark, documents, edge_rows):
    got = jaccard_join.near_duplicates(documents(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    assert {r["n_links"] for r in got if r["doc_id"] == 4} == {1} and {r["n_links"] for r in got if r["doc_id"] != 4} == {0}
    assert jaccard_join.one_of_each(documents(edge_rows)).count() == len(edge_rows) - 1
    assert jaccard_join.near_duplicates(documents(edge_rows).limit(0)).count() == 0
    assert jaccard_join.one_of_each(documents(edge_rows).limit(0)).count() == 0


def test_class_id_is_an_id_where_a_copy_has_one(spark, documents):
    text = "one two three four five six seven eight nine ten"
    got = jaccard_join.near_duplicates(documents([(None, text), (9, text), (8, text + " eleven"), (None, text + " eleven")])).collect()
    assert {r["class_id"] for r in got} == {8} and {r["n_links"] for r in got} == {3}
    got = jaccard_join.near_duplicates(documents([(None, text), (9, text)])).collect()
    assert {r["class_id"] for r in got} == {9}


def test_rows_without_words_stay_beside_repeated_rows(spark, documents):
    bare = [(None, ""), (None, ""), (None, None), (None, None), (7, " . "), (7, " . ")]
    worded = (1, "one two three four five six seven eight nine ten")
    for more in ([worded], [worded, worded]):
        got = [(r["doc_id"], r["text"]) for r in jaccard_join.one_of_each(documents(bare + more)).collect()]
        assert sorted(got, key=str) == sorted([*bare, worded], key=str)


def test_shingles_and_minhashes():
    texts = [t.encode() for t in copies()] + [b"", b"...", b"one two", b"One TWO", b"one", b"a b c d e", "é à".encode()]
    keys, offsets = jaccard_join.shingles(texts)
    sets = [frozenset(keys[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
    for a in range(len(texts)):
        assert len(sets[a]) == len(shingled(texts[a].decode()))
        for b in range(0, a, 5):
            assert len(sets[a] & sets[b]) == len(shingled(texts[a].decode()) & shingled(texts[b].decode()))
    values = jaccard_join.minhashes(keys, offsets, 336)
    assert len(values) == sum(map(bool, sets))
    same = float((values[0] == values[2]).mean())
    assert abs(same - len(sets[0] & sets[2]) / len(sets[0] | sets[2])) < 0.12


def test_bayes_keeps_what_reaches_the_threshold():
    least = jaccard_join.least_matches(jaccard_join.Join())
    rng = np.random.default_rng(1)
    for n, m in least.items():
        assert m < 0.8 * n and (rng.binomial(n, 0.8, 200_000) < m).mean() < 1e-4
        assert (rng.binomial(n, 0.3, 10_000) >= m).mean() < 0.6 if n == 32 else True


def plainly_clean(text):
    """The line rules by hand: the text without failed lines, or None if the document goes."""
    word, chars = re.compile(r"[^\x20\x09-\x0D]+"), lambda x: sum(map(len, word.findall(x)))
    words = word.findall(text)
    places = collections.defaultdict(list)
    for k in range(len(words) - 4):
        places[tuple(words[k : k + 5])].append(k)
    repeated = {k + j for at in places.values() if len(at) > 1 for k in at for j in range(5)}
    if len(words) < 10 or 100 * len(repeated) > 20 * len(words):
        return None
    kept = []
    for line in text.split("\n"):
        n = len(word.findall(line))
        many = lambda pattern, share: len(re.findall(pattern, line)) >= 3 and len(re.findall(pattern, line)) > share * n  # noqa: B023, E731
        stub = n <= 3 and not re.search(quality.ENDING, line)
        fails = many(r"[#*$%&|<>]", 0.5) or many("!!", 0.25) or many("[|»›·•]", 0.25) or many(r"https?://|www[.]", 0.5) or stub or (n <= 30 and re.search(quality.BOILERPLATE, line))
        if not n or not fails:
            kept.append(line)
    clean = "\n".join(kept)
    return clean if chars(clean) >= 0.5 * chars(text) else None


def plainly_scored(model, text):
    """The probability by the model's weights, each feature by its definition."""
    found = set()
    for w in WORD.findall(text.encode().lower()):
        found.add(xxhash.xxh64_intdigest(b"w" + w) >> 1)
        found.update(xxhash.xxh64_intdigest(b"b%d" % n + w[:n]) >> 1 for n in (4, 5, 6) if len(w) > n)
    return 1 / (1 + math.exp(-(model.bias + sum(v for f, v in model.weights.items() if f in found))))


def test_pipeline_equals_steps_by_hand(spark):
    """Each stage by a plain version over the rows that the one before kept. Of the toxicity stage only the fit is the
    operator's own, which test_models holds against the conditions of its optimum."""
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF_DIR, "documents").collect()}
    texts = {i: c for i, t in docs.items() if (c := plainly_clean(t or "")) is not None}
    first = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id bigint, text string")
    model = toxicity.train(first, table(spark, SF_DIR, "labels"))
    texts = {i: t for i, t in texts.items() if plainly_scored(model, t) < 0.5}
    texts = {c: texts[c] for c in {c for _, c, _ in brute(sorted(texts.items()))}}
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in texts.items():
        t = plainly_cut(t, items)
        ids = lib.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect()) == sorted(want)


def test_stages_return_the_columns_of_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).dtypes == docs.dtypes


def test_pipeline_on_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF_DIR, name).limit(0).write.parquet(f"file://{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


def test_queries_on_odd_tables(spark, tmp_path, edge_rows):
    """Nulls, repeated rows and extra columns through the queries themselves."""
    from sparksift.llm.queries import QUERIES

    spark.createDataFrame([(i, t, "en", None, None, "x") for i, t in edge_rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, score string").write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(4, 1, 1), (5, 0, 0), (5, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "x"), (2, "one two three")], "item_id bigint, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, None, None, "x"), (1, "http://A.com/x?y", "<p>", "y"), (None, "no url", "", "z")], "page_id bigint, url string, html string, host string").write.parquet(f"file://{tmp_path}/pages.parquet")
    spark.createDataFrame([(1, 1, "user", "Hi.", "x"), (1, None, None, None, "y"), (None, 2, "tool", "So", "z"), (None, 2, "tool", "So", "z")], "conv_id bigint, turn bigint, role string, text string, pos string").write.parquet(f"file://{tmp_path}/conversations.parquet")
    for name, f in QUERIES.items():
        number, n = int(name[2:].split("_")[0]), f(spark, f"file://{tmp_path}").count()
        assert n >= len(edge_rows) if number == 13 else n == {3: 3, 11: 2}.get(number, len(edge_rows)), name
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() <= len(edge_rows)
