"""Every registered query with a SQL oracle gives the same rows as DuckDB
(sf0.001; the driver repeats this at sf0.01)."""

import duckdb
import pytest

from tools.oracle_check import TABLES, rows_of

from __spark_entry__ import entry, oracle_sql, queries

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_a_callable():
    qs, sq = queries(), oracle_sql()
    assert set(sq) <= set(qs)
    assert len(qs) >= 40


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    rel = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, rel.fetchall())


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) >= {"accuracy", "n"}
