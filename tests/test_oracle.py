"""Every registered query against its DuckDB oracle (small scale factor)."""

import os

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.own_queries()))
def test_query_matches_oracle(spark, con, name):
    sql = E.own_oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    problems, ns, nd = compare(spark, con, name, E.queries()[name], sql, SF)
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "top_day" in df.columns
