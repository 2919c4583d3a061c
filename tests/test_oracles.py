"""Every registered query against its DuckDB oracle on the smallest driver tables.

Mirrors the driver's correctness gate (row count, column names, order-insensitive
value hash) at sf0.001, plus the contract of ``__spark_entry__``.
"""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import TABLES, digest  # noqa: E402

from tierflow.plans.catalog import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
NO_ORACLE = set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "cumulative_episodes" in df.columns
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert {q for q in set(qs) - set(sqls) if q in QUERIES} == NO_ORACLE


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    sqls = E.oracle_sql()
    cur = duck.execute(sqls[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, df.columns)[0] == digest(drows, dcols)[0]
