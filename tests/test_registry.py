"""Every registered query equals its DuckDB oracle on the smallest data set; the entry point runs."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from parity import norm  # noqa: E402

import __spark_entry__ as entry_mod  # noqa: E402
from sparkloom.plans.testdata import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_contract_keys():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert len(entry_mod.queries()) >= 39


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "record_loaded" in df.columns


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    cols = df.columns
    rows = df.collect()
    res = con.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    got = sorted(tuple(norm(r[i]) for i in order) for r in rows)
    want = sorted(tuple(norm(r[i]) for i in oorder) for r in orows)
    assert got == want
