"""Every registered query of the library against its SQL, over the smallest tables."""

import datetime
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from sparksift.plans import catalogue

from .conftest import SF_DIR

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v) if isinstance(v, (datetime.date, datetime.datetime)) else v


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(repr(tuple(plain(r[n]) for n in names)) for r in df.collect())


def sql_rows(sql, sf_dir=SF_DIR):
    with duckdb.connect() as c:
        for t in TABLES:
            path = f"{sf_dir}/{t}.parquet"
            if os.path.exists(path):
                c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
        out = c.sql(sql)
        names = sorted(out.columns)
        at = [out.columns.index(n) for n in names]
        return names, sorted(repr(tuple(plain(r[k]) for k in at)) for r in out.fetchall())


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n in catalogue.ORACLE_SQL])
def test_query_equals_sql(spark, name):
    assert spark_rows(catalogue.QUERIES[name](spark, SF_DIR)) == sql_rows(catalogue.ORACLE_SQL[name])


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n not in catalogue.ORACLE_SQL])
def test_query_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_has_all_hosts(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 32


@pytest.mark.parametrize("gone", [("sparksift/llm", "tests/llm"), ("sparksift/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_the_subpackage(tmp_path, gone):
    root = Path(__file__).resolve().parents[1]
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in gone:
        at = copy / name
        shutil.rmtree(at) if at.is_dir() else at.unlink()
    (copy / "sparksift/llm/__pycache__").mkdir(parents=True)  # what a deletion of sources may leave
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print('NAMES', *e.queries(), '|', *e.oracle_sql())"], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True)
    names, _, sql = said.stdout.partition("NAMES ")[2].partition(" | ")
    assert set(names.split()) == set(catalogue.QUERIES) and set(sql.split()) == set(catalogue.ORACLE_SQL), said.stderr


def test_every_sql_has_a_query():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
