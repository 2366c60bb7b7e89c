"""Every registered query against its SQL equivalent on the supplied tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from fluxloom.plans.inputs import NAMES
from tools.check_oracle import rows

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    # DuckDB 2.0 now and then ends with an internal error where several threads aggregate the same joined rows.
    con.execute("SET threads=1")
    for name in NAMES:
        # Tables, not views: one query's fault in reading Parquet would end the connection for all after it.
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert got
        return
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["sensor", "ndays", "min", "max", "years"]
