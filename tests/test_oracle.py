"""Every registered query against its oracle SQL on DuckDB (sf0.001), exact value match."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from ledgerlake.plans.catalog import QUERIES
from ledgerlake.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return "D" + str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def normalized(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle_sql():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() == 10
    assert "usage_rank" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    scols, srows = normalized(sdf.columns, [tuple(r) for r in sdf.collect()])
    rel = con.sql(ORACLE[name])
    ocols, orows = normalized(rel.columns, rel.fetchall())
    assert scols == ocols
    assert len(srows) == len(orows)
    assert srows == orows
