"""The driver's correctness gate, run here at sf0.001: every registered
query against its DuckDB oracle (row count, column names, value hash)."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

from tallyspark.plans.catalog import ORACLE, QUERIES  # noqa: E402

NAMES = sorted(set(entry.queries()) & set(QUERIES))


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, small_dir, name):
    r = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], small_dir, con)
    assert r["cols_match"], r
    assert r["types_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 84
    assert df.count() > 0
