"""The registered queries: against SQL where it is given, else their contract's shape."""

from __future__ import annotations

import os

import oracle
import pytest

from orthoscape.llm.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, name):
    assert oracle.differences(spark, oracle.connect(SF), name, QUERIES[name], ORACLE_SQL[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL) - {"op7_best_fit_packing"}))
def test_one_row_a_document(spark, name):
    got = QUERIES[name](spark, SF).select("doc_id").collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    assert sorted(r[0] for r in got) == sorted(r[0] for r in docs)
