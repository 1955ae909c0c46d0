"""Registered probes of the column helpers over the test tables (I8, O1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import known_mean, round_half_up, title_case, to_month
from tradewind.operators.common import conform
from tradewind.sources.tables import Marketplace
from tradewind.sources.testdata import ParquetTables, raw_customers, raw_sellers

TITLE_CASE_SCHEMA = [("raw_city", "VARCHAR"), ("city", "VARCHAR")]
ROUNDING_SCHEMA = [("seller_id", "KEY"), ("month", "DATE"), ("avg_price_1", "DOUBLE"), ("avg_price_2", "DOUBLE")]


def title_case_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: every distinct raw city text (sellers and customers) with its title case."""
    t = ParquetTables(spark, sf_dir)
    cities = (raw_sellers(t).select(F.col("seller_city").alias("raw_city"))
              .unionByName(raw_customers(t).select(F.col("customer_city").alias("raw_city"))).distinct())
    return conform(cities.withColumn("city", title_case(F.trim("raw_city"))), TITLE_CASE_SCHEMA)


def rounding_probe(m: Marketplace) -> DataFrame:
    """I8: mean item price per (seller, purchase month) rounded to 1 and 2 places."""
    x = m.order_items.join(m.orders.select("order_id", to_month("order_purchase_timestamp").alias("month")),
                           "order_id")
    mean = known_mean("price")
    out = x.groupBy("seller_id", "month").agg(round_half_up(mean, 1).alias("avg_price_1"),
                                              round_half_up(mean, 2).alias("avg_price_2"))
    return conform(out, ROUNDING_SCHEMA)
