"""Every registered query: same rows as its SQL, or at least some rows where SQL cannot say it."""

import pytest

import __spark_entry__ as registered
from workloads.compare import compare

ORACLE = registered.oracle_sql()
QUERIES = registered.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, sf_dir, con):
    ok, note = compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert {r["Class"] for r in registered.entry(spark).collect()} == {"All", "small", "medium", "large"}
