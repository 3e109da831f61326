"""The store by buckets, the sink with commit, registrable domains."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from sparksift.operators import domains
from sparksift.operators.store import BucketStore
from sparksift.sources import bundles, sheets, sinks

SCHEMA = "k bigint, at int, tie int, v string"


def rows(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def files(path):
    return {f"{d}/{f}" for d, _, names in os.walk(f"{path}/data") for f in names if f.startswith("part")}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "s")
    store = BucketStore(spark, path, rows(spark, []).schema, "k", "at", "tie", buckets=16, files=2)
    assert store.read().count() == 0 and store.versions() == []
    store.upsert(rows(spark, [(k, 1, 0, f"old{k}") for k in range(100)] + [(None, 1, 0, "null")]))
    before, first = store.places(), files(path)
    store.upsert(rows(spark, [(7, 2, 0, "new"), (7, 1, 9, "older"), (None, 3, 0, "null2"), (500, 1, 1, "added")]))
    got = {r["k"]: r["v"] for r in store.read().collect()}
    assert got == {k: f"old{k}" for k in range(100)} | {7: "new", None: "null2", 500: "added"}
    after = store.places()
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 3 and first <= files(path)
    for b in set(before) - changed:
        assert after[b] == before[b]
    # A reader of the first version still sees it, until it is forgotten.
    assert {r["k"]: r["v"] for r in store.read(1).collect()}[7] == "old7"
    store.vacuum()
    assert store.versions() == [2] and {r["k"]: r["v"] for r in store.read().collect()} == got and len(files(path)) <= len(first) + 6


def test_a_failed_update_changes_nothing(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "s"), rows(spark, []).schema, "k", "at", "tie", buckets=4)
    store.upsert(rows(spark, [(1, 1, 1, "a")]))
    bad = rows(spark, [(1, 2, 1, "b")]).withColumn("v", F.when(F.col("k") == 1, F.raise_error(F.lit("broken"))).otherwise("x"))
    with pytest.raises(Exception, match="broken"):
        store.upsert(bad)
    assert [tuple(r) for r in store.read().collect()] == [(1, 1, 1, "a")] and store.versions() == [1]
    with pytest.raises(RuntimeError, match="meanwhile"):
        store._publish(1, {})
    assert store.versions() == [1]
    assert store.upsert(rows(spark, [])) == 2 and store.read().count() == 1


def listed(path):
    return sorted(os.path.relpath(f"{d}/{f}", path) for d, _, names in os.walk(path) for f in names)


def test_files_come_with_their_manifest(spark, tmp_path):
    path = str(tmp_path / "f")
    df = spark.range(20, numPartitions=4).select("id", F.format_string("n%d.bin", "id").alias("name"), F.repeat(F.col("id").cast("string"), 5).cast("binary").alias("content"))
    sinks.put(df, path)
    sinks.put(df.limit(0), path)
    got = {r["id"]: r for r in sinks.manifest(spark, path, "id bigint").collect()}
    assert len(got) == 20 and not os.path.exists(f"{path}/_attempts/x") and os.listdir(f"{path}/_attempts") == []
    for k, r in got.items():
        content = open(r["file"].removeprefix("file://"), "rb").read()
        assert content == str(k).encode() * 5 and r["bytes"] == len(content) and r["sha256"] == hashlib.sha256(content).hexdigest()


def failing(path, times):
    """Rows of one partition, of which a task fails after half of its rows as often as told."""

    def run(batches):
        for batch in batches:
            yield batch.slice(0, batch.num_rows // 2)
            mark = f"{path}-tries"
            tries = int(open(mark).read()) if os.path.exists(mark) else 0
            with open(mark, "w") as f:
                f.write(str(tries + 1))
            if tries < times:
                raise RuntimeError("lost")
            yield batch.slice(batch.num_rows // 2)

    return run


def test_a_writer_that_fails_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "f")
    df = spark.range(10, numPartitions=1).select("id", F.format_string("n%d", "id").alias("name"), F.lit(b"x").alias("content"))
    with pytest.raises(Exception, match="lost"):
        sinks.put(df.mapInArrow(failing(path, 99), df.schema), path)
    assert listed(path) == []


def test_an_attempt_that_failed_leaves_no_half_and_no_double(tmp_path):
    """Two attempts of a task, the first of which stops half way, as the commit sees them."""
    from pyspark.sql import Row

    writer = sinks.FilesWriter(str(tmp_path))

    def stopping():
        yield Row(name="a", content=b"1", k=1)
        raise RuntimeError("lost")

    class Here:
        partitionId = staticmethod(lambda: 3)

    held, sinks.TaskContext = sinks.TaskContext, type("T", (), {"get": staticmethod(lambda: Here)})
    try:
        with pytest.raises(RuntimeError):
            writer.write(stopping())
        assert any("_attempts" in x for x in listed(tmp_path))
        writer.commit([writer.write(iter([Row(name="a", content=b"1", k=1), Row(name="b", content=None, k=2)]))])
    finally:
        sinks.TaskContext = held
    assert [x.split("/", 1)[1] for x in listed(tmp_path)] == ["task-000003/a", "task-000003/b", "task-000003/manifest.jsonl", "task-none/manifest.jsonl"]


def test_report_files_through_the_sink(spark, tmp_path):
    frame = spark.createDataFrame([("b/c", 0, "a.com", "http://a.com/1"), ("b/c", 0, "a.com", "http://a.com/2"), ("b/c", 1, "a.com", "http://a.com/3")], "bundle string, part_no long, host string, url string")
    got = {r["name"]: open(r["file"].removeprefix("file://"), "rb").read() for r in bundles.put_bundles(frame, str(tmp_path)).collect()}
    assert sorted(got) == ["b_c-0.pdf", "b_c-0.xlsx", "b_c-1.pdf", "b_c-1.xlsx"]
    assert got["b_c-0.pdf"].startswith(b"%PDF-") and list(sheets.read_links(got["b_c-0.xlsx"])) == ["http://a.com/1", "http://a.com/2"]


def plain(host, suffixes):
    try:
        name = host if host.isascii() else host.encode("idna").decode()
    except UnicodeError:
        return None, None
    labels = name.split(".")
    if "" in labels or name.replace(".", "").isdigit():
        return None, None
    n = 1
    for k in range(1, len(labels) + 1):
        tail = ".".join(labels[-k:])
        if f"!{tail}" in suffixes:
            n = k - 1
            break
        if tail in suffixes:
            n = max(n, k)
        if f"*.{tail}" in suffixes and k < len(labels):
            n = max(n, k + 1)
    return ".".join(labels[-n:]), ".".join(labels[-n - 1 :]) if len(labels) > n else None


def test_registrable_domains(spark):
    hosts = ["example.com", "www.a.example.co.uk", "co.uk", "uk", "x.ck", "y.x.ck", "www.ck", "a.www.ck", "city.kawasaki.jp", "b.city.kawasaki.jp", "z.other.kawasaki.jp", "kawasaki.jp", "bücher.de", "www.bücher.co.uk", "10.0.0.1", "unknown.zone", "zone", "a..b", "ü" * 80 + ".de", "", None, "example.com"]
    got = {r["host"]: (r["suffix"], r["domain"]) for r in domains.registrable(spark.createDataFrame([(h,) for h in hosts], "x string"), "x", domains.rules(spark)).collect()}
    assert got == {h: plain(h, domains.SUFFIXES) for h in hosts if h is not None}


def test_staged_tables_can_be_cleared(spark, tmp_path, monkeypatch):
    from sparksift.functions import storage

    monkeypatch.setattr(storage, "shared_dir", lambda spark: f"file://{tmp_path}/own")
    held = storage.written(spark.range(5).toDF("id"), "held")
    assert held.count() == 5 and os.listdir(tmp_path / "own")
    storage.clear(spark)
    assert not os.path.exists(tmp_path / "own") and storage.written(spark.range(0), "again").count() == 0
