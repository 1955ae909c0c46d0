import datetime as dt

import pytest

from tests.builders import item, market, money, order
from tradewind.operators import quality, staging, star


def test_payments_text_order_and_total(spark):
    m = market(spark, order_payments=[(1, "10", "voucher", 1, money(5)), (1, "2", "card", 3, money(20))])
    r = star.payments_deduped(m.order_payments).first()
    assert (r.payment_type, r.payment_installments, float(r.total_payment_value)) == ("voucher", 1, 25.0)


def test_fact_orders_grain_and_flags(spark):
    m = market(spark,
               orders=[order(1, 7, "delivered", "2020-01-01 10:00:00", "2020-01-03 00:00:00", "2020-01-02 00:00:00"),
                       order(2, 7, "canceled", "2020-01-01 10:00:00")],
               order_items=[item(1, 1, 1, 1, 10, 1), item(1, 2, 2, 1, 5), item(2, 1, 1, 1, 9)],
               order_payments=[(1, "1", "card", 2, money(16))])
    rows = star.fact_orders(m).collect()
    assert len(rows) == 2 and {r.order_id for r in rows} == {1}
    assert all(r.delivered_on_time is False and r.total_payment_value == 16.0 for r in rows)
    assert sorted(r.gross_revenue for r in rows) == [5.0, 11.0]


def test_dim_date_weekend_and_spine(spark):
    m = market(spark, orders=[order(1, 1, "delivered", "2024-06-01 10:00:00"), order(2, 1, "canceled", "2024-06-03 23:00:00")])
    rows = {r.date: r for r in star.dim_date(m).collect()}
    assert sorted(rows) == [dt.date(2024, 6, 1), dt.date(2024, 6, 2), dt.date(2024, 6, 3)]
    sat, sun, mon = rows[dt.date(2024, 6, 1)], rows[dt.date(2024, 6, 2)], rows[dt.date(2024, 6, 3)]
    assert (sat.day_of_week_num, sat.is_weekend, sun.day_of_week_num, sun.is_weekend, mon.is_weekend) == (6, True, 0, True, False)
    assert (mon.week_start, mon.year_month_label, sun.day_name, sun.month_name) == (dt.date(2024, 6, 3), "2024-06", "Sunday", "June")


def test_dim_customer_smallest_id_and_geo(spark):
    m = market(spark, customers=[(5, 1, "01234", "A", "SP"), (3, 1, "09999", "B", "RJ")],
               geolocation=[("01234", 2.0, 1.0), ("09999", None, 5.0), ("09999", 1.0, 2.0)])
    r = star.dim_customer(m).first()
    assert (r.customer_id, r.customer_zip_code, r.customer_lat, r.customer_lng) == (3, "09999", 1.0, 2.0)


def test_staging_cleaning(spark):
    raw = spark.createDataFrame([("s1", "7", "  santa bárbara d'oeste ", " sp "), ("s2", "1234567", "", "rj")],
                                "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    rows = staging.clean_sellers(raw).collect()
    assert tuple(rows[0]) == ("s1", "00007", "Santa Bárbara D'Oeste", "SP")
    assert tuple(rows[1]) == ("s2", "12345", None, "RJ")
    orders = spark.createDataFrame([("o1", "c", "delivered", "2020-01-01 10:00:00", None, None, None, None),
                                    ("o2", "c", "delivered", "not a time", None, None, None, None),
                                    ("o3", "c", "delivered", None, None, None, None, None)],
                                   "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
                                   "order_approved_at string, order_delivered_carrier_date string, "
                                   "order_delivered_customer_date string, order_estimated_delivery_date string")
    staged = {r.order_id: r.order_purchase_timestamp for r in staging.clean_orders(orders).collect()}
    assert staged == {"o1": dt.datetime(2020, 1, 1, 10), "o2": None}       # raw NULL dropped, junk kept as NULL
    items = spark.createDataFrame([("o1", "1", "p", "s", "10.5", "1"), ("o9", "1", "p", "s", "3", "1")],
                                  "order_id string, order_item_id string, product_id string, seller_id string, price string, freight_value string")
    kept = staging.clean_order_items(items, staging.clean_orders(orders)).collect()
    assert [r.order_id for r in kept] == ["o1"] and float(kept[0].price) == 10.5


def test_quality_gate(spark):
    good = market(spark, orders=[order(1, 1, "delivered", "2020-01-01 10:00:00")], order_items=[item(1, 1, 1, 1, 10)])
    report = quality.dq_report(good, {k: 0 for k in quality.MIN_ROWS})
    quality.enforce_gate(report)
    bad = market(spark, orders=[order(1, 1, "delivered", "2020-01-01 10:00:00")],
                 order_items=[item(1, 1, 1, 1, 0), item(2, 1, 1, 1, 5)])
    rows = {r.check_name: r for r in quality.dq_report(bad, {k: 0 for k in quality.MIN_ROWS}).collect()}
    assert rows["nonpositive_or_null_price"].value == 1 and rows["orphan_order_items"].value == 1
    with pytest.raises(quality.QualityGateError):
        quality.enforce_gate(quality.dq_report(bad, {k: 0 for k in quality.MIN_ROWS}))
    with pytest.raises(quality.QualityGateError):
        quality.enforce_gate(quality.dq_report(good))           # default minimum row counts
