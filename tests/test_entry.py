"""Driver contract and a smoke run of every registered query at sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from postlens.plans import catalog


OWN = sorted(catalog.REGISTRY)


def test_queries_and_oracles_have_the_same_names():
    assert set(OWN) <= set(E.queries()) and set(OWN) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(OWN) == 68


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["author_id", "username", "sum_retweet_count", "sum_reply_count",
                          "sum_like_count", "sum_quote_count"]


@pytest.mark.parametrize("name", OWN)
def test_query_runs_at_smallest_scale(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() >= 0
    assert all(c for c in df.columns)


def test_oracle_matches_spark_on_small_data(spark):
    """A few queries compared with DuckDB at sf0.001 (the full set runs in scripts/check_oracle.py)."""
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("events", "documents", "customer", "part"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("interaction_totals", "media_counts_by_user", "interval_join_full_outer", "top_words"):
        sdf = E.queries()[name](spark, SF_SMALL)
        s = sorted((tuple(r) for r in sdf.select(sorted(sdf.columns)).collect()), key=repr)
        res = con.execute(E.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        d = sorted((tuple(r[i] for i in idx) for r in res.fetchall()), key=repr)
        assert s == d, name
