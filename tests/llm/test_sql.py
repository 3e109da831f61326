"""Queries that SQL can express, against it."""

import pytest

from sparksift.llm.queries import ORACLE_SQL, QUERIES

from ..conftest import SF_DIR
from ..test_catalogue import spark_rows, sql_rows


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == sql_rows(ORACLE_SQL[name])


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
