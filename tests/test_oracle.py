"""Every registered query against its DuckDB twin on the driver tables (small scale)."""

import os

import pytest

from parcelflow.plans.oracle import ORACLE_SQL
from parcelflow.plans.registry import QUERIES
from tests.oracle_compare import canon, compare, digest  # noqa: F401

SF = os.environ.get("PARCELFLOW_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res[0] == "match", res


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0
    assert df.columns == entry(spark).columns
