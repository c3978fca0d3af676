"""Every registered query against its DuckDB oracle on sf0.001."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
# The training-data queries have tests of their own.
NAMES = sorted(E._QUERIES)
# Checks that a sound pipeline passes; each has a failing counterpart above.
CLEAN = {"chk_accepted_segment", "chk_ship_before_order", "chk_converted_null", "chk_unique_common_name"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    dcols = [x[0] for x in res.description]
    assert sorted(df.columns) == sorted(dcols)
    want = rows_of(dcols, res.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
    assert want or name in CLEAN


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 100 and "net_usd" in df.columns
