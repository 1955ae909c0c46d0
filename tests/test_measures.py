"""Micro-fixtures for the dashboard measures."""

import datetime as dt

from pyspark.sql import functions as F

from tests.builders import item, market, order
from tradewind.operators import measures, star


def test_activity_stage_buckets(spark):
    df = spark.createDataFrame([(m,) for m in (0, 3, 4, 6, 7, 12, 13, 40)], "m long")
    got = [r[0] for r in df.select(measures.activity_stage(F.col("m"))).collect()]
    assert got == ["New", "New", "Early", "Early", "Established", "Established", "Veteran", "Veteran"]


def test_acquisition_trend_recovers_a_line(spark):
    # new persons per cohort month: 3, 5, 7, 9 (y = 2x + 1)
    rows, pid = [], 0
    for k, n in enumerate([3, 5, 7, 9]):
        for _ in range(n):
            pid += 1
            rows.append((pid, dt.date(2020, 1 + k, 1)))
    cd = spark.createDataFrame(rows + [(999, None)], "customer_unique_id long, cohort_month date")
    out = sorted((r.x, r.new_customers, r.trend_new_customers) for r in measures.acquisition_trend(cd).collect())
    assert out == [(1, 3, 3.0), (2, 5, 5.0), (3, 7, 7.0), (4, 9, 9.0)]


def test_moving_average_counts_gap_days_as_zero_and_peak_tie(spark):
    m = market(spark,
               orders=[order(1, 1, "delivered", "2024-01-01 10:00:00"), order(2, 1, "delivered", "2024-01-03 10:00:00"),
                       order(3, 1, "canceled", "2024-01-04 10:00:00")],
               order_items=[item(1, 1, 1, 1, 30), item(2, 1, 1, 1, 30)])
    daily = measures.daily_revenue(star.fact_orders(m), star.dim_date(m))
    ma = {r.date: (r.revenue, r.ma7) for r in measures.revenue_moving_avg(daily).collect()}
    assert ma[dt.date(2024, 1, 2)] == (0.0, 15.0) and ma[dt.date(2024, 1, 4)] == (0.0, 15.0)
    peak = measures.peak_day(daily).first()
    assert (peak.peak_date, peak.peak_revenue) == (dt.date(2024, 1, 1), 30.0)     # tie -> earliest day
    wd = {r.day_name: r.days for r in measures.revenue_by_weekday(daily).collect()}
    assert sum(wd.values()) == 4


def test_top20_share_and_state_matrix_totals(spark):
    orders = [order(i, 1, "delivered", "2024-01-05 10:00:00") for i in range(1, 11)]
    items = [item(i, 1, 1, i, 10 * i) for i in range(1, 11)]          # seller i sells 10*i
    m = market(spark, sellers=[(i, "00001", "C", "SP") for i in range(1, 11)], orders=orders, order_items=items,
               customers=[(1, 1, "00001", "C", "SP")])
    from tradewind.operators import seller
    t = measures.top20_share(seller.seller_lifetime_totals(seller.daily_seller_revenue(m))).first()
    assert (t.top20_sellers, t.top20_revenue, t.total_revenue, t.top20_share_pct) == (2, 190.0, 550.0, 34.55)
    mx = {(r.customer_state, r.month, r.level): r.revenue
          for r in measures.state_month_matrix(star.fact_orders(m), m.customers).collect()}
    assert mx[(None, None, 3)] == 550.0 and mx[("SP", None, 1)] == 550.0 and mx[(None, dt.date(2024, 1, 1), 2)] == 550.0


def test_customer_kpis_bases(spark):
    cd = spark.createDataFrame(
        [(1, 2, 100.0, 1, 1, 2, 2, 2), (2, 1, 50.0, 0, 1, 1, 0, 1), (3, 0, 0.0, 0, 0, 0, 1, 1)],
        "customer_unique_id long, total_orders long, total_revenue double, is_repeat_customer long, "
        "on_time_orders long, delivered_orders long, canceled_orders long, total_orders_all long")
    k = measures.customer_kpis(cd).first()
    assert (k.customers_with_orders, k.clv, k.returning_rate_pct, k.cancellation_rate_pct, k.on_time_rate_pct) == \
        (2, 75.0, 50.0, 75.0, 66.67)
