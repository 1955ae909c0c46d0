"""Star schema: one fact table and four dimensions — SURVEY §2.K."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import category_label, day_name, month_name, round_half_up, sunday_zero_weekday
from tradewind.operators.common import UNCATEGORIZED, conform, item_revenue, valid_orders
from tradewind.operators.customer import on_time_flag
from tradewind.operators.staging import PRODUCT_SIZES, dedup_geolocation
from tradewind.session import materialize
from tradewind.sources.tables import Marketplace

PAYMENTS_DEDUPED_SCHEMA = [("order_id", "KEY"), ("payment_type", "VARCHAR"), ("payment_installments", "BIGINT"),
                           ("total_payment_value", "DOUBLE")]
FACT_ORDERS_SCHEMA = [
    ("order_id", "KEY"), ("order_item_id", "KEY"), ("product_id", "KEY"), ("seller_id", "KEY"),
    ("customer_id", "KEY"), ("order_date", "DATE"), ("price", "DOUBLE"), ("freight_value", "DOUBLE"),
    ("gross_revenue", "DOUBLE"), ("total_payment_value", "DOUBLE"), ("payment_type", "VARCHAR"),
    ("payment_installments", "BIGINT"), ("order_status", "VARCHAR"), ("order_purchase_timestamp", "TIMESTAMP"),
    ("order_approved_at", "TIMESTAMP"), ("order_delivered_customer_date", "TIMESTAMP"),
    ("order_estimated_delivery_date", "TIMESTAMP"), ("delivered_on_time", "BOOLEAN")]
DIM_SELLER_SCHEMA = [("seller_id", "KEY"), ("seller_zip_code", "VARCHAR"), ("seller_city", "VARCHAR"),
                     ("seller_state", "VARCHAR"), ("seller_lat", "DOUBLE"), ("seller_lng", "DOUBLE")]
DIM_CUSTOMER_SCHEMA = [("customer_id", "KEY"), ("customer_unique_id", "KEY"), ("customer_zip_code", "VARCHAR"),
                       ("customer_city", "VARCHAR"), ("customer_state", "VARCHAR"), ("customer_lat", "DOUBLE"),
                       ("customer_lng", "DOUBLE")]
DIM_PRODUCT_SCHEMA = [("product_id", "KEY"), ("category_name_en", "VARCHAR"), ("category_name_pt", "VARCHAR")] + [
    (c, "BIGINT") for c in PRODUCT_SIZES]
DIM_DATE_SCHEMA = [("date", "DATE"), ("year", "BIGINT"), ("month", "BIGINT"), ("quarter", "BIGINT"),
                   ("day", "BIGINT"), ("day_of_week_num", "BIGINT"), ("day_name", "VARCHAR"),
                   ("month_name", "VARCHAR"), ("is_weekend", "BOOLEAN"), ("week_start", "DATE"),
                   ("month_start", "DATE"), ("quarter_start", "DATE"), ("year_month_label", "VARCHAR")]
DEDUP_GEO_SCHEMA = [("zip_code", "VARCHAR"), ("lat", "DOUBLE"), ("lng", "DOUBLE")]


def payments_deduped(payments: DataFrame) -> DataFrame:
    """K1: per order, the first payment by ``payment_sequential`` (compared as text,
    so '10' < '2') and the total of all its payments — one aggregate, one shuffle.

    A NULL sequence comes last; equal sequences go by type, then instalments, NULLs last."""
    order = [F.col("payment_sequential").isNull().alias("no_sequence"), F.col("payment_sequential").alias("sequence"),
             F.col("payment_type").isNull().alias("no_type"), F.col("payment_type"),
             F.col("payment_installments").isNull().alias("no_installments"), F.col("payment_installments")]
    x = payments.groupBy("order_id").agg(F.min(F.struct(*order)).alias("p"),
                                         F.sum("payment_value").alias("total_payment_value"))
    return x.select("order_id", "p.payment_type", "p.payment_installments", "total_payment_value")


PAYMENT_COLUMNS = {"payment_type", "payment_installments", "total_payment_value"}


def fact_orders(m: Marketplace, columns: Sequence[str] | None = None, of_order: Sequence[str] = ()) -> DataFrame:
    """K2: one row per sold item with order, payment and delivery attributes, or those ``columns`` of it.
    ``of_order``: columns that ``m.orders`` has beside the staged ones, given to each item of the order.

    Valid orders and their payments meet first, both one row per order, and are
    written once: the item join is then a join of its own, whose hot order adaptive
    execution splits (a second join on the same key in one stage would forbid it).
    A reader of no payment column has one join only, as Catalyst leaves out a left join on a
    unique key of which nothing is read; writing would hide from it which columns are read.
    """
    o = valid_orders(m.orders).join(payments_deduped(m.order_payments), "order_id", "left")
    if columns is None or PAYMENT_COLUMNS.intersection(columns):
        o = materialize(o, "fact-orders")
    x = m.order_items.join(o, "order_id")
    out = x.select(
        "order_id", "order_item_id", "product_id", "seller_id", "customer_id",
        F.to_date("order_purchase_timestamp").alias("order_date"),
        round_half_up("price", 2).alias("price"),
        round_half_up("freight_value", 2).alias("freight_value"),
        round_half_up(item_revenue(), 2).alias("gross_revenue"),
        round_half_up("total_payment_value", 2).alias("total_payment_value"),
        "payment_type", "payment_installments", "order_status",
        "order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date",
        "order_estimated_delivery_date",
        (on_time_flag() == 1).alias("delivered_on_time"), *of_order)
    schema = [(c, t) for c, t in FACT_ORDERS_SCHEMA if columns is None or c in columns]
    return conform(out, [*schema, *((c, "KEY") for c in of_order)])


def dim_seller(m: Marketplace) -> DataFrame:
    """K3: sellers with the coordinates of their zip code (NULL when unknown)."""
    geo = dedup_geolocation(m.geolocation)
    x = m.sellers.join(geo, m.sellers.seller_zip_code == geo.zip_code, "left")
    return conform(x.withColumnRenamed("lat", "seller_lat").withColumnRenamed("lng", "seller_lng"),
                   DIM_SELLER_SCHEMA)


def dim_customer(m: Marketplace) -> DataFrame:
    """K4: one row per person — the record with the smallest customer id — with coordinates
    of the first five characters of the zip code."""
    rec = F.min(F.struct(F.col("customer_id").isNull().alias("no_id"), "customer_id", "customer_zip_code_prefix",
                         "customer_city", "customer_state"))     # a record without an id comes last
    people = (m.customers.groupBy("customer_unique_id").agg(rec.alias("c"))
               .select(F.col("c.customer_id").alias("customer_id"), "customer_unique_id",
                       F.col("c.customer_zip_code_prefix").alias("customer_zip_code"),
                       F.col("c.customer_city").alias("customer_city"),
                       F.col("c.customer_state").alias("customer_state")))
    geo = dedup_geolocation(m.geolocation)
    x = people.join(geo, F.left(people.customer_zip_code, F.lit(5)) == geo.zip_code, "left")
    return conform(x.withColumnRenamed("lat", "customer_lat").withColumnRenamed("lng", "customer_lng"),
                   DIM_CUSTOMER_SCHEMA)


def dim_product(m: Marketplace) -> DataFrame:
    """K5: products with their English category label."""
    x = m.products.join(m.category_translation, "product_category_name", "left")
    label = category_label(F.coalesce("product_category_name_english", "product_category_name",
                                      F.lit(UNCATEGORIZED)))
    return conform(x.withColumn("category_name_en", label)
                    .withColumnRenamed("product_category_name", "category_name_pt"), DIM_PRODUCT_SCHEMA)


def dim_date(m: Marketplace) -> DataFrame:
    """K6: one row per calendar day from the first to the last purchase day.

    The spine is ``explode(sequence(min, max))`` over a one-row aggregate: its
    size is the number of days in the range, independent of the order count.
    """
    day = F.to_date("order_purchase_timestamp")
    bounds = m.orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    d = F.col("date")
    spine = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    out = spine.select(
        "date", F.year(d).alias("year"), F.month(d).alias("month"), F.quarter(d).alias("quarter"),
        F.dayofmonth(d).alias("day"), sunday_zero_weekday(d).alias("day_of_week_num"),
        day_name(d).alias("day_name"), month_name(d).alias("month_name"),
        sunday_zero_weekday(d).isin(0, 6).alias("is_weekend"),
        F.trunc(d, "week").alias("week_start"), F.trunc(d, "MM").alias("month_start"),
        F.trunc(d, "quarter").alias("quarter_start"), F.date_format(d, "yyyy-MM").alias("year_month_label"))
    return conform(out, DIM_DATE_SCHEMA).orderBy("date")
