"""Every registered query against its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from fieldlake.oracle import oracles
from fieldlake.registry import queries
from tools.oracle_check import TABLES, rows_of

QUERIES = queries()
ORACLES = oracles()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLES[name])
    o_names = [d[0] for d in rel.description]
    o_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(o_names)
    assert rows_of(df.columns, s_rows) == rows_of(o_names, o_rows)
