"""Every registered query against its DuckDB oracle (sf0.001, fast) + entry smoke."""

import importlib.util
import os

import duckdb
import pytest

from conftest import SF001

HERE = os.path.dirname(os.path.abspath(__file__))
_spec = importlib.util.spec_from_file_location(
    "check_oracles", os.path.join(HERE, "..", "tools", "check_oracles.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)

import __spark_entry__ as entry_mod  # noqa: E402

from orderlens.plans.driver import QUERIES as DRIVER_QUERIES  # noqa: E402

QUERIES = {k: v for k, v in entry_mod.queries().items() if k in DRIVER_QUERIES}
ORACLES = {k: v for k, v in entry_mod.oracle_sql().items() if k in DRIVER_QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLES[name])
    orows = rel.fetchall()
    sc, sh, _ = check.digest(df.columns, srows)
    oc, oh, _ = check.digest(rel.columns, orows)
    assert sc == oc
    assert len(srows) == len(orows)
    assert sh == oh
    stypes = check.spark_types(df)
    for c, t in zip(rel.columns, rel.types):
        if not str(t).startswith("VARCHAR"):
            assert stypes[c.lower()] == str(t), c


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns[:3] == ["order_id", "line_no", "contact_id"]
    assert df.count() >= 0
