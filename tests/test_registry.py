"""Registry and oracle stay in step; the four marts match the oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry

VIEWS = "region nation customer supplier part orders lineitem".split()


def test_every_query_has_oracle_sql():
    from tradewind.oracle import all_sql
    from tradewind.plans.registry import queries as own
    assert set(own()) == set(all_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(own()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "lifetime_rank" in df.columns


def _norm(v):
    return repr(v) if isinstance(v, float) else (None if v is None else str(v))


@pytest.mark.parametrize("key", ["seller_profile", "churn_risk", "category_analysis", "customer_and_delivery",
                                 "fact_orders", "dq_report", "kpi_yoy", "state_month_matrix"])
def test_marts_match_oracle(spark, key):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{sf}/{v}.parquet')")
    sdf = entry.queries()[key](spark, sf)
    res = con.execute(entry.oracle_sql()[key])
    cols = [c[0] for c in res.description]
    assert sdf.columns == cols
    key_fn = lambda row: tuple((0, "") if x is None else (1, x) for x in row)
    a = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=key_fn)
    b = sorted((tuple(_norm(x) for x in r) for r in res.fetchall()), key=key_fn)
    assert a == b
