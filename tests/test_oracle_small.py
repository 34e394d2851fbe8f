"""Registered batch queries vs their DuckDB oracle text on sf0.001."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from aerolap.sources.tables import TABLES
from tools.check_oracle import digest

FAST = [k for k in E.oracle_sql() if k.startswith(("q_", "ext_", "op_"))
        and k not in ("op_zip_ingest", "op_csv_by_name", "op_csv_scan", "op_kv_roundtrip")]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(rel.columns, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["start_date", "src", "mid", "dst", "dep1", "dep2",
                          "delay1", "delay2", "total_delay"]
