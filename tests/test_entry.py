"""Queries against their SQL oracles on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# The slow iterative ones are covered by their own modules.
SLOW = {"kmeans_k_sweep", "dbscan_grid", "dbscan_summary", "dbscan_sizes", "svc_nystrom", "svc_polynomial"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query_matches_oracle(spark, sf, duck, name):
    got = entry.queries()[name](spark, sf).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got)
        return
    want = duck.execute(sql).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = {c: got[c].dtype for c in cols}
    a = got[cols].sort_values(cols).reset_index(drop=True)
    b = want[cols].astype(key).sort_values(cols).reset_index(drop=True)
    assert a.equals(b)


def test_flagship(spark):
    assert entry.entry(spark).count() == 1
