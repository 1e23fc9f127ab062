"""Every registered query against its DuckDB oracle on sf0.001 (driver gate in small)."""
import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from surveyfold.plans import registry  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_matches_oracle(spark, con, name):
    sdf = registry.queries()[name](spark, SF_SMALL)
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "EPOP" in df.columns
