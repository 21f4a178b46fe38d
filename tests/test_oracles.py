"""Every registered query against its DuckDB oracle (rows, columns, values)."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from marquee.plans.catalog import all_oracles as oracle_sql
from marquee.plans.catalog import all_queries as queries
from conftest import SF_SMALL
from oracle_check import compare, duck

KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF_SMALL, key, queries()[key], oracle_sql()[key], con)
    assert r["cols_match"], r
    assert r["types_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "movie_key"
