"""Differential test: every catalogue query against its DuckDB twin on the
sf0.01 tables (order-insensitive rows, names and types)."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from scripts.check_oracle import compare, open_duckdb
from tunelake.plans.catalogue import ORACLE_SQL, QUERIES

from conftest import SF001

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    if not os.path.exists(f"{SF001}/lineitem.parquet"):
        pytest.skip("shared test tables not present")
    return open_duckdb(SF001)


def test_every_query_has_an_oracle_or_is_iterative():
    assert set(QUERIES) <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())
    assert set(QUERIES) - set(ORACLE_SQL) == {"text_classifier"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    n, problems = compare(spark, duck, SF001, QUERIES[name], ORACLE_SQL.get(name))
    assert not problems, problems
    assert n > 0


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["spotify_id", "track_name", "artist_name", "daily_rank", "country",
                          "snapshot_date", "popularity"]
