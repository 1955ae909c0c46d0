"""Micro-fixtures for the quirks the marts must keep."""

from pyspark.sql import functions as F

from tests.builders import item, market, order
from tradewind.operators import category, churn, customer, seller


def _rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_tied_revenue_rank_ntile_and_cumulative(spark):
    # sellers 1 and 2 tie at 100, seller 3 has 50
    m = market(spark,
               orders=[order(1, 1, "delivered", "2020-01-01 10:00:00")],
               order_items=[item(1, 1, 1, 2, 100), item(1, 2, 1, 1, 100), item(1, 3, 1, 3, 50)])
    out = {r.seller_id: r for r in seller.seller_profile(m).collect()}
    assert [out[i].lifetime_rank for i in (1, 2, 3)] == [1, 1, 3]
    assert [out[i].lifetime_quartile for i in (1, 2, 3)] == [1, 2, 3]     # NTILE ties broken by seller_id
    assert [out[i].cumulative_revenue_pct for i in (1, 2, 3)] == [40.0, 80.0, 100.0]
    assert [out[i].is_top80_seller for i in (1, 2, 3)] == [1, 1, 0]


def test_mode_tie_goes_to_smallest_value(spark):
    cats = ["b", "a", "c", "a", "b"]
    m = market(spark,
               products=[(i + 1, c, 1, 1, 1, 1, 1) for i, c in enumerate(cats)],
               orders=[order(1, 1, "delivered", "2020-01-01 10:00:00")],
               order_items=[item(1, i + 1, i + 1, 1, 10) for i in range(5)])
    daily = seller.daily_seller_revenue(m).first()
    assert daily.primary_category == "a" and daily.items_sold == 5


def test_growth_edges(spark):
    # last day 2020-04-10; l30 window [03-11, 04-10), p30 [02-10, 03-11)
    m = market(spark,
               orders=[order(1, 1, "delivered", "2020-03-20 10:00:00"), order(2, 1, "delivered", "2020-04-10 10:00:00"),
                       order(3, 1, "delivered", "2020-03-01 10:00:00")],
               order_items=[item(1, 1, 1, 1, 10), item(2, 1, 1, 2, 5), item(3, 1, 1, 3, 7)])
    out = {r.seller_id: r for r in seller.seller_profile(m).collect()}
    assert out[1].mom_growth_pct is None and out[1].revenue_l30d == 10.0      # grows from zero
    assert out[2].revenue_90d is None                                          # last day itself is excluded
    assert out[3].mom_growth_pct == -100.0


def test_zero_month_streaks_and_signal(spark):
    # seller 1: A Z Z ; seller 2: Z Z ; seller 3: A Z A   (months Jan..Mar, then a 4th month to pass tenure)
    months = ["2020-01-05", "2020-02-05", "2020-03-05", "2020-04-05"]
    pattern = {1: [10, 0, 0, 0], 2: [0, 0, 0, 0], 3: [10, 0, 10, 10]}
    orders, items = [], []
    oid = 0
    for s, vals in pattern.items():
        for mth, v in zip(months, vals):
            oid += 1
            orders.append(order(oid, 1, "delivered", mth + " 10:00:00"))
            items.append(item(oid, 1, 1, s, v))
    m = market(spark, orders=orders, order_items=items)
    fold = churn.seller_fold(churn.seller_history_of(m))
    streak = {r.seller_id: r.streak_length for r in churn.zero_month_streak(fold).collect()}
    assert streak == {1: 4, 2: 4, 3: 1}
    risk = {r.seller_id: r for r in churn.churn_risk(m).collect()}
    assert risk[1].consecutive_zero_months == 4 and risk[3].consecutive_zero_months == 1
    assert 0 <= risk[2].churn_risk_score <= 100
    # S3 is capped at 25: seller 2 has no revenue signals (all bases 0), only the streak
    assert risk[2].churn_risk_score == 25.0


def test_churn_streak_three_two_one(spark):
    m = market(spark,
               orders=[order(i, 1, "delivered", f"2020-0{i}-05 10:00:00") for i in range(1, 5)],
               order_items=[item(1, 1, 1, 1, 10), item(2, 1, 1, 1, 0), item(3, 1, 1, 1, 0), item(4, 1, 1, 1, 0)])
    assert churn.zero_month_streak(churn.seller_fold(churn.seller_history_of(m))).first().streak_length == 4   # zeros + the preceding active month


def test_share_zero_base_is_stable_and_first_month_labels(spark):
    # category x: Jan revenue 0.00 share 0, Feb revenue > 0; category y appears only in Feb; data ends Mar 31
    m = market(spark,
               products=[(1, "x", 1, 1, 1, 1, 1), (2, "y", 1, 1, 1, 1, 1), (3, "z", 1, 1, 1, 1, 1)],
               orders=[order(1, 1, "delivered", "2020-01-10 10:00:00"), order(2, 1, "delivered", "2020-02-10 10:00:00"),
                       order(3, 1, "delivered", "2020-03-31 10:00:00")],
               order_items=[item(1, 1, 1, 1, 0), item(1, 2, 3, 1, 10), item(2, 1, 1, 1, 5), item(2, 2, 2, 1, 5),
                            item(3, 1, 3, 1, 1)])
    out = {(r.category_name_en, str(r.month)): r for r in category.category_analysis(m).collect()}
    assert out[("X", "2020-01-01")].share_trend == "Returned"
    assert out[("X", "2020-02-01")].share_trend == "Stable"        # previous share 0.00 -> no division error
    assert out[("Y", "2020-02-01")].share_trend == "New"
    # a month counts only once a later month has started: data ending on Mar 31 drops March
    assert ("Z", "2020-03-01") not in out and ("Z", "2020-01-01") in out


def test_partial_last_month_dropped(spark):
    m = market(spark, orders=[order(1, 1, "delivered", "2020-01-10 10:00:00"),
                              order(2, 1, "delivered", "2020-02-10 10:00:00")],
               order_items=[item(1, 1, 1, 1, 10), item(2, 1, 1, 1, 10)])
    months = {str(r.month) for r in category.category_analysis(m).collect()}
    assert months == {"2020-01-01"}


def test_cancel_only_customer_and_same_day_repeat(spark):
    m = market(spark,
               customers=[(1, 100, "01000", "Sp", "SP"), (2, 200, "02000", "Rio", "RJ")],
               orders=[order(1, 1, "canceled", "2020-01-01 10:00:00"),
                       order(2, 2, "delivered", "2020-01-02 08:00:00", "2020-01-05 08:00:00", "2020-01-10 00:00:00"),
                       order(3, 2, "delivered", "2020-01-02 20:00:00", "2020-01-20 08:00:00", "2020-01-10 00:00:00")],
               order_items=[item(2, 1, 1, 1, 10), item(3, 1, 1, 1, 30)])
    out = {r.customer_unique_id: r for r in customer.customer_and_delivery(m).collect()}
    c = out[100]
    assert (c.total_orders, c.revenue_tier, c.avg_order_value, c.canceled_orders, c.has_cancellation) == \
        (0, "No Completed Orders", None, 1, 1)
    r = out[200]
    assert (r.total_orders, r.is_repeat_customer, r.days_to_repeat, r.on_time_orders, r.delivered_orders) == (2, 1, 0, 1, 2)
    assert r.avg_delivery_days == 10.5 and r.total_revenue == 40.0 and r.avg_order_value == 20.0


def test_any_value_skips_nulls(spark):
    m = market(spark, customers=[(1, 9, "1", None, "SP"), (2, 9, "1", "Rio", None)])
    r = customer.all_customers(m.customers).first()
    assert (r.customer_state, r.customer_city) == ("SP", "Rio")


def test_properties_on_test_data(spark):
    from tradewind.sources.testdata import load_testdata
    m = load_testdata(spark, "/root/testdata/sf0.01")
    prof = seller.seller_profile(m)
    assert prof.agg(F.max("cumulative_revenue_pct")).first()[0] == 100.0
    sizes = [r["count"] for r in prof.groupBy("lifetime_quartile").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    share = category.category_analysis(m).groupBy("seller_state", "month").agg(F.sum("revenue_share_pct").alias("s"))
    assert share.filter(F.abs(F.col("s") - 100) > 0.5).count() == 0
    risk = churn.churn_risk(m)
    assert risk.filter((F.col("churn_risk_score") < 0) | (F.col("churn_risk_score") > 100)).count() == 0


def test_streaks_three_two_one_and_s3(spark):
    months = ["2020-01-05", "2020-02-05", "2020-03-05"]
    pattern = {1: [10, 0, 0], 2: [0, 0], 3: [10, 0, 10]}          # A Z Z / Z Z / A Z A
    orders, items, oid = [], [], 0
    for s, vals in pattern.items():
        for mth, v in zip(months, vals):
            oid += 1
            orders.append(order(oid, 1, "delivered", mth + " 10:00:00"))
            items.append(item(oid, 1, 1, s, v))
    m = market(spark, orders=orders, order_items=items)
    streaks = churn.zero_month_streak(churn.seller_fold(churn.seller_history_of(m)))
    assert {r.seller_id: r.streak_length for r in streaks.collect()} == {1: 3, 2: 2, 3: 1}
    # S3 alone: latest rows with no revenue signal and enough tenure
    state = "named_struct('last', DATE '2020-06-01', 'recent', array(CAST(0 AS DECIMAL(38,6))), 'streak', streak_length, 'zeros', 1)"
    fold = streaks.selectExpr("seller_id", "'SP' AS seller_state", "DATE '2020-01-01' AS cohort_month", f"{state} AS s")
    scores = {r.seller_id: r.churn_risk_score for r in churn.churn_signals(fold).collect()}
    assert scores == {1: 25.0, 2: 25.0, 3: 0.0}


def test_dimension_keys_are_unique(spark):
    from tradewind.operators import star
    from tradewind.sources.testdata import load_testdata
    m = load_testdata(spark, "/root/testdata/sf0.001")
    for df, key in [(star.dim_seller(m), "seller_id"), (star.dim_customer(m), "customer_unique_id"),
                    (star.dim_product(m), "product_id"), (star.dim_date(m), "date")]:
        assert df.groupBy(key).count().filter(F.col("count") > 1).count() == 0
