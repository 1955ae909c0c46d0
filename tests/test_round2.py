"""Exact money, NULL-safe ranking, CSV dialect, splittable joins, lazy staging, clean-up, output order."""

import datetime as dt
import os
import re
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.builders import d, market, money, order
from tradewind.operators import category, churn, customer, measures, seller, star
from tradewind.operators.ranking import COUNT, POS, RANK, RUN, TOTAL, global_positions
from tradewind.operators.staging import clean_order_items, clean_order_payments
from tradewind.session import intermediates, materialize
from tradewind.sources import csv as csv_source
from tradewind.sources.sinks import export_csv
from tradewind.sources.testdata import load_raw_testdata, load_testdata

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- money

def _raw_items(spark, prices):
    rows = [("o", str(i), "p", "s", p, "0") for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "order_id string, order_item_id string, product_id string, seller_id string, "
                                       "price string, freight_value string")


def test_money_keeps_every_digit(spark):
    orders = spark.createDataFrame([("o",)], "order_id string")
    got = clean_order_items(_raw_items(spark, ["12.3456", "1.005", "0.004", "1e3", "x", "", None, "12345678901234567.89"]),
                            orders).orderBy(F.col("order_item_id").cast("int")).collect()
    assert [r.price for r in got] == [Decimal("12.345600"), Decimal("1.005000"), Decimal("0.004000"), Decimal("1000.000000"),
                                      None, None, None, Decimal("12345678901234567.890000")]


@pytest.mark.parametrize("bad", ["0.00000001", "1e25", "1e400", "12.3333333"])
def test_money_that_does_not_fit_stops_the_job(spark, bad):
    payments = spark.createDataFrame([("o", "1", "card", "1", bad)], "order_id string, payment_sequential string, "
                                     "payment_type string, payment_installments string, payment_value string")
    with pytest.raises(Exception, match="order_payments.payment_value needs more digits.* order_id=o payment_sequential=1"):
        clean_order_payments(payments).collect()


def _five_sellers(spark, freights):
    day = [order(i, 1, "delivered", f"2020-01-0{i} 10:00:00") for i in range(1, 6)]
    items = [(i, 1, 1, i, money(p), None if f is None else money(f))
             for i, (p, f) in enumerate(zip([50, 40, 30, 10, 20], freights), 1)]
    return market(spark, orders=day, order_items=items)


def test_a_seller_without_known_revenue_leaves_the_others_alone(spark):
    m = _five_sellers(spark, [0, 0, 0, 0, None])
    rows = {r.seller_id: r for r in seller.seller_profile(m).collect()}
    assert [rows[i].cumulative_revenue_pct for i in range(1, 6)] == [38.5, 69.2, 92.3, 100.0, 100.0]
    assert [rows[i].is_top80_seller for i in range(1, 6)] == [1, 1, 0, 0, 0]
    assert [rows[i].lifetime_rank for i in range(1, 6)] == [1, 2, 3, 4, 5]
    assert rows[5].total_revenue is None


def test_zero_total_revenue_gives_null_shares(spark):
    m = market(spark, orders=[order(1, 1, "delivered", "2020-01-01 10:00:00")],
               order_items=[(1, 1, 1, 1, money(0), money(0))])
    row = seller.seller_profile(m).first()
    assert row.cumulative_revenue_pct is None and row.lifetime_rank == 1
    years = market(spark, orders=[order(1, 1, "delivered", "2019-01-01 10:00:00"), order(2, 1, "delivered", "2020-01-01 10:00:00")],
                   order_items=[(1, 1, 1, 1, money(0), money(0)), (2, 1, 1, 1, money(5), money(0))])
    kpi = {r.year: r for r in measures.kpi_yoy(star.fact_orders(years)).collect()}
    assert kpi[2020].gmv_yoy_pct is None and kpi[2020].gmv == 5.0


# ---------------------------------------------------------------- ranking

def test_null_keys_rank_last_as_one_tie(spark):
    rows = [(i, None if i % 5 == 0 else i % 7 * 10) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, v long")
    w = Window.orderBy(F.col("v").desc_nulls_last(), "id")
    want = {r.id: (r.p, r.k, r.s) for r in df.select(
        "id", F.row_number().over(w).alias("p"), F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).alias("k"),
        F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("s")).collect()}
    got = global_positions(df, "v", "id", amount="v", num_partitions=7).collect()
    assert {r.id: (r[POS], r[RANK], r[RUN]) for r in got} == want
    assert {(r[COUNT], r[TOTAL]) for r in got} == {(200, sum(v or 0 for _, v in rows))}


def test_one_value_over_all_partitions_needs_one_summary_row_each(spark):
    df = spark.range(3000).select("id", F.lit(5).alias("v"))
    got = global_positions(df, "v", "id", num_partitions=30)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert got.agg(F.min(RANK), F.max(RANK), F.max(POS)).first()[:] == (1, 1, 3000)


# ---------------------------------------------------------------- first payment, smallest customer

def test_first_payment_with_null_and_repeated_sequences(spark):
    pay = [(1, None, "voucher", 1, money(5)), (2, "1", "voucher", 2, money(1)), (2, "1", "card", 3, money(1)),
           (2, None, "a", 1, money(1)), (3, None, None, None, money(2)), (3, None, "boleto", 1, money(2))]
    got = {r.order_id: (r.payment_type, r.payment_installments, float(r.total_payment_value))
           for r in star.payments_deduped(market(spark, order_payments=pay).order_payments).collect()}
    assert got == {1: ("voucher", 1, 5.0), 2: ("card", 3, 3.0), 3: ("boleto", 1, 4.0)}


def test_customer_record_without_an_id_comes_last(spark):
    m = market(spark, customers=[(None, 7, "1", "X", "AA"), (3, 7, "2", "Y", "BB"), (None, 8, "3", "Z", "CC")])
    got = {r.customer_unique_id: (r.customer_id, r.customer_city) for r in star.dim_customer(m).collect()}
    assert got == {7: (3, "Y"), 8: (None, "Z")}


# ---------------------------------------------------------------- CSV

def test_reordered_header_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('extra,seller_state,seller_city,seller_id,seller_zip_code_prefix\n'
                    '1,SP,"say ""hi"", ok",a1,00123\n2,RJ,"two\nlines",b2,01\n3,,"",c3,\n')
    cols = csv_source.FILES["sellers"][1]
    rows = csv_source.read_csv(spark, str(path), cols, multiline=True).orderBy("seller_id").collect()
    assert [tuple(r) for r in rows] == [("a1", "00123", 'say "hi", ok', "SP"), ("b2", "01", "two\nlines", "RJ"),
                                        ("c3", None, None, None)]
    with pytest.raises(ValueError, match="no_such"):
        csv_source.read_csv(spark, str(path), [*cols, "no_such"])


def test_export_is_read_back_by_duckdb(spark, tmp_path):
    rows = [(1, 'say "hi", ok', d("2020-01-01 10:00:00"), 1.5, dt.date(2020, 1, 2), True),
            (2, "a,b", d("2020-01-01 10:00:00.250000"), None, None, None), (3, None, None, -0.25, None, False)]
    df = spark.createDataFrame(rows, "id long, t string, ts timestamp_ntz, x double, day date, f boolean")
    assert export_csv(df, f"{tmp_path}/out") == 3
    got = duckdb.sql(f"SELECT * FROM read_csv('{tmp_path}/out/*.csv', header=true, columns={{'id': 'BIGINT', 't': 'VARCHAR', "
                     "'ts': 'TIMESTAMP', 'x': 'DOUBLE', 'day': 'DATE', 'f': 'BOOLEAN'}, quote='\"', escape='\"') ORDER BY id").fetchall()
    assert got == rows
    text = "".join(open(f"{tmp_path}/out/{f}").read() for f in os.listdir(f"{tmp_path}/out") if f.endswith(".csv"))
    assert "2020-01-01 10:00:00," in text and '"say ""hi"", ok"' in text


# ---------------------------------------------------------------- plans

def _hot_market(spark, tmp_path):
    """A third of the items on one order and one seller, spread over files as Spark would write them."""
    n = 60_000
    i = F.col("id")
    hot = i % 3 == 0
    spark.range(n).select(
        F.when(hot, F.lit(0)).otherwise(i).alias("order_id"), i.alias("order_item_id"), (i % 9 + 1).alias("product_id"),
        F.when(hot, F.lit(1)).otherwise(i % 9 + 1).alias("seller_id"), F.lit(1).cast("decimal(28,6)").alias("price"),
        F.lit(0).cast("decimal(28,6)").alias("freight_value")).repartition(8).write.parquet(f"{tmp_path}/items")
    stamp = F.lit("2020-01-01 10:00:00").cast("timestamp_ntz")
    empty = F.lit(None).cast("timestamp_ntz")
    spark.range(n).select(
        i.alias("order_id"), i.alias("customer_id"), F.lit("delivered").alias("order_status"),
        stamp.alias("order_purchase_timestamp"), *[empty.alias(c) for c in (
            "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
            "order_estimated_delivery_date")]).repartition(8).write.parquet(f"{tmp_path}/orders")
    return market(spark).replace(order_items=spark.read.parquet(f"{tmp_path}/items"), orders=spark.read.parquet(f"{tmp_path}/orders"))


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split_or_combined_first(spark, tmp_path):
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "12"}
    old = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        m = _hot_market(spark, tmp_path)
        assert "skew=true" in _final_plan(star.fact_orders(m))
        for df in (churn.seller_monthly(m), category.daily_category_revenue(m)):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert "distinct" not in plan.lower() and "count(distinct" not in plan.lower()
        monthly = churn.seller_monthly(m)
        plan = monthly._jdf.queryExecution().executedPlan().toString()
        # Items are summed per order, seller (map-side first) below the join with orders.
        inner = re.search(r"HashAggregate\(keys=\[order_id#\d+L?, seller_id#\d+L?\], functions=\[partial_sum", plan)
        assert inner and inner.start() > plan.index("SortMergeJoin")
        assert monthly.agg(F.sum("orders")).first()[0] == 40_000 + 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_tables_without_items_run_no_job_while_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-staging", "building")
    m = load_testdata(spark, SF)
    built = [star.dim_date(m), star.dim_seller(m), star.dim_customer(m), star.dim_product(m), m.orders, m.order_payments]
    tables = {"orders", "supplier", "nation", "region", "customer", "part", "lineitem"}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Reading a Parquet footer is the only job, once for each input table.
    assert len(built) == 6 and len(tracker.getJobIdsForGroup("lazy-staging")) <= len(tables)
    assert "order_items" not in vars(m) and "order_items" not in vars(load_raw_testdata(spark, SF))


def test_intermediates_are_deleted_also_after_a_failure(spark):
    with intermediates(spark) as written:
        assert materialize(spark.range(3), "probe").count() == 3
    kept = list(written)
    with pytest.raises(RuntimeError):
        with intermediates(spark) as more:
            materialize(spark.range(3), "probe")
            raise RuntimeError("stop")
    paths = [p.removeprefix("file:") for p in [*kept, *more]]
    assert len(paths) == 2 and not any(os.path.exists(p) for p in paths)


# ---------------------------------------------------------------- output order

def test_sorted_outputs_come_in_their_order(spark):
    m = load_testdata(spark, SF)
    for df, keys in ((seller.seller_profile(m), ["lifetime_rank", "seller_id"]),
                     (category.category_analysis(m), ["month", "seller_state", "rank_in_month"]),
                     (star.dim_date(m), ["date"])):
        rows = [tuple(r[k] for k in keys) for r in df.collect()]
        assert rows == sorted(rows) and len(rows) > 1
    risk = [-r.churn_risk_score for r in churn.churn_risk(m).collect()]
    assert risk == sorted(risk)
    assert customer.customer_and_delivery(m).count() > 0
