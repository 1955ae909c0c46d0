"""Means over known amounts, the ordered fold, percentiles by selection."""

import random

import pytest
from pyspark.sql import functions as F

from tests.builders import item, market, money, order
from tradewind.operators import category, churn, customer, seller
from tradewind.operators.ranking import percentiles_cont


def _months(spark, amounts):
    """One seller, one order a month; an unknown amount is an item of unknown freight."""
    orders = [order(i, 1, "delivered", f"2020-{i:02d}-05 10:00:00") for i in range(1, len(amounts) + 1)]
    items = [(i, 1, 1, 1, money(a or 0), None if a is None else money(0)) for i, a in enumerate(amounts, 1)]
    return market(spark, orders=orders, order_items=items,
                  customers=[(1, 7, "00001", "City", "SP")])


def test_rolling_mean_over_known_months(spark):
    ts = churn.seller_timeseries(churn.seller_history_of(_months(spark, [100, None, 200]))).orderBy("year_month").collect()
    assert [r.rolling_6m_avg for r in ts] == [100.0, 100.0, 150.0]
    assert [r.prev_month_revenue and float(r.prev_month_revenue) for r in ts] == [None, 100.0, None]


def test_order_value_and_category_mean_over_known_amounts(spark):
    m = _months(spark, [100, None, 50, 10])
    row = customer.customer_and_delivery(m).first()
    assert row.avg_order_value == 53.33 and row.total_revenue == 160.0 and row.total_orders == 4
    rows = category.category_analysis(m).collect()          # the last month is not complete
    assert {r.avg_monthly_revenue for r in rows} == {75.0} and {r.months_active for r in rows} == {3}
    stats = seller.order_value_stats(m).first()
    assert stats["items"] == 4 and stats.avg_freight_value == 0.0 and stats.avg_item_revenue == 53.33


def test_nothing_known(spark):
    m = _months(spark, [None, None])
    assert customer.customer_and_delivery(m).first().avg_order_value is None
    assert seller.order_value_stats(m).first().avg_item_revenue is None
    assert [r.rolling_6m_avg for r in churn.seller_timeseries(churn.seller_history_of(m)).collect()] == [None, None]


def _plain_fold(amounts):
    zero = [a is not None and a == 0 for a in amounts]
    streak = 0
    for z in reversed(zero):
        streak += 1
        if not z:
            break
    known = [a for a in amounts[-6:] if a is not None]
    at = lambda k: float(amounts[k]) if len(amounts) >= -k and amounts[k] is not None else None
    return at(-1), at(-2), at(-4), sum(known) / len(known) if known else None, streak, int(all(zero))


def test_fold_equals_plain_fold(spark):
    rng = random.Random(1)
    orders, items, want, oid = [], [], {}, 0
    for s in range(1, 10):
        amounts = [rng.choice([0, 0, 10, 25, None]) for _ in range(rng.randint(1, 11))]
        want[s] = _plain_fold(amounts)
        for k, a in enumerate(amounts, 1):
            oid += 1
            orders.append(order(oid, 1, "delivered", f"2020-{k:02d}-05 10:00:00"))
            items.append((oid, 1, 1, s, money(a or 0), None if a is None else money(0)))
    fold = churn.seller_fold(churn.seller_history_of(market(spark, orders=orders, order_items=items)))
    late = {r.seller_id: r for r in churn.latest_month(fold).collect()}
    streak = {r.seller_id: r for r in churn.zero_month_streak(fold).collect()}
    as_float = lambda v: None if v is None else float(v)
    got = {s: (as_float(late[s].latest_revenue), as_float(late[s].prev_month_revenue), as_float(late[s].revenue_3m_ago),
               late[s].rolling_6m_avg, streak[s].streak_length, streak[s].all_zeros_in_streak) for s in late}
    assert {s: v[:3] + v[4:] for s, v in got.items()} == {s: v[:3] + v[4:] for s, v in want.items()}
    assert all(g[3] == pytest.approx(w[3]) if w[3] is not None else g[3] is None for g, w in zip(got.values(), (want[s] for s in got)))


def test_fold_takes_one_exchange_after_the_monthly_grain(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = _months(spark, [1, 2, 3, 4])
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        monthly = churn.seller_monthly(m)
        full = churn.churn_signals(churn.seller_fold(churn.seller_history(monthly, m.sellers)))
        # The seller side of the join has its own exchange; months take one more.
        assert plan(full).count("Exchange hashpartitioning") == plan(monthly).count("Exchange hashpartitioning") + 2
        assert "Window" not in plan(full)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_two_smallest_days(spark):
    m = market(spark, customers=[(i, 7 if i < 4 else 8, "1", "C", "SP") for i in range(1, 6)],
               orders=[order(1, 1, "delivered", "2020-03-01 10:00:00"), order(2, 2, "delivered", "2020-01-09 10:00:00"),
                       order(3, 3, "delivered", "2020-02-01 10:00:00"), order(4, 4, "delivered", "2020-02-01 09:00:00"),
                       order(5, 5, "delivered", "2020-02-01 08:00:00")],
               order_items=[item(i, 1, 1, 1, 5) for i in range(1, 6)])
    paid = customer.paid_orders(m)
    figures = customer.person_figures(paid)
    assert {r[0]: str(r[1]) for r in customer.second_purchase(figures).collect()} == {7: "2020-02-01", 8: "2020-02-01"}
    plan = figures._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "distinct" not in plan and "window" not in plan


@pytest.mark.parametrize("kind", ["spread", "one value", "two thirds", "powers", "few"])
def test_percentiles_by_selection(spark, monkeypatch, kind):
    from tradewind.operators import ranking
    monkeypatch.setattr(ranking, "FEW", 5)                  # narrow down to the end
    monkeypatch.setattr(ranking, "BUCKETS", 8)
    rng = random.Random(2)
    values = {"spread": [round(rng.uniform(-1e6, 1e6), 2) for _ in range(3000)], "one value": [4.25] * 500,
              "two thirds": [7.5] * 2000 + [rng.uniform(0, 15) for _ in range(1000)],
              "powers": [float(2 ** (i % 60)) for i in range(1000)], "few": [3.0, 1.0]}[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 3, "x double")
    got = percentiles_cont(df, "x", {"a": 0.0, "b": 0.5, "c": 0.8, "d": 1.0}).first()
    ref = df.select(*[F.percentile("x", p) for p in (0.0, 0.5, 0.8, 1.0)]).first()
    assert tuple(got) == pytest.approx(tuple(ref), rel=1e-12)


def test_percentiles_of_nothing(spark):
    assert tuple(percentiles_cont(spark.createDataFrame([], "x double"), "x", {"a": 0.5, "b": 0.8}).first()) == (None, None)
