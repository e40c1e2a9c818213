import duckdb
import pytest

import __spark_entry__ as se
from rivulet.sources.tables import TABLES, table_path


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["c_custkey", "c_name", "o_orderkey", "o_orderstatus", "o_orderdate",
                          "o_orderpriority", "no_result"]


def test_oracle_keys_are_queries():
    assert set(se.oracle_sql()) <= set(se.queries())


def _norm(v):
    return "<null>" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_duckdb(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_small, t)}')")
    df = se.queries()[name](spark, sf_small)
    cur = con.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    srows = sorted(tuple(_norm(r[c]) for c in order) for r in df.collect())
    drows = sorted(tuple(_norm(r[dcols.index(c)]) for c in order) for r in cur.fetchall())
    assert srows == drows
