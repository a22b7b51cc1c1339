"""Every registered query of the core against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import oracle
import pytest

from orthoscape.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, con, name):
    assert oracle.differences(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() >= 0 and df.columns


def test_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
