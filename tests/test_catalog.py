"""Every query with a SQL twin gives the same values in another engine."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tools.check_queries import TABLES, compare  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_values(spark, engine, name):
    status, note, _ = compare(spark, engine, SF, name, SQL[name])
    assert status in ("ok", "near"), note


def test_entry(spark):
    assert entry(spark).count() > 0 and set(SQL) <= set(queries())
