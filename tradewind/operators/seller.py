"""Seller profile mart — SURVEY §2.J1-J7.

Grain: one row per seller with at least one non-cancelled sale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import category_label, known_mean, round_half_up
from tradewind.operators.common import conform, item_revenue, mode_of, scalar, valid_orders, with_category
from tradewind.operators.ranking import COUNT, POS, RANK, RUN, TOTAL, global_positions, ntile
from tradewind.operators.staging import MONEY, PURCHASE_MONTH
from tradewind.session import materialize
from tradewind.sources.tables import Marketplace

SELLER_PROFILE_SCHEMA = [
    ("seller_id", "KEY"), ("seller_city", "VARCHAR"), ("seller_state", "VARCHAR"),
    ("total_revenue", "DOUBLE"), ("total_items_sold", "BIGINT"), ("active_days", "BIGINT"),
    ("first_sale_date", "DATE"), ("last_sale_date", "DATE"), ("lifetime_rank", "BIGINT"),
    ("lifetime_quartile", "BIGINT"), ("cumulative_revenue_pct", "DOUBLE"), ("is_top80_seller", "BIGINT"),
    ("revenue_90d", "DOUBLE"), ("revenue_l30d", "DOUBLE"), ("revenue_p30d", "DOUBLE"),
    ("mom_growth_pct", "DOUBLE"), ("top_category", "VARCHAR"), ("items_90d", "BIGINT"),
    ("active_days_90d", "BIGINT"),
]


def sold_items(m: Marketplace) -> DataFrame:
    """Items of valid orders with their purchase date (D1 + C3)."""
    orders = valid_orders(m.orders).select(
        "order_id", F.to_date("order_purchase_timestamp").alias("order_date"))
    return m.order_items.join(orders, "order_id")


def seller_category_day(m: Marketplace) -> DataFrame:
    """(seller, category, day) -> revenue, price sum, item count and count of known prices: the
    grain that the seller and category marts share.  A hot seller is combined map-side here,
    before it meets any other join."""
    items = (with_category(sold_items(m), m.products, m.category_translation)
             .select("seller_id", "order_date", "category", "price", item_revenue().alias("rev")))
    return items.groupBy("seller_id", "order_date", "category").agg(
        F.sum("rev").alias("rev"), F.sum("price").alias("price"), F.count(F.lit(1)).alias("n"),
        F.count("price").alias("n_price"))


def daily_seller_revenue(m: Marketplace) -> DataFrame:
    """(seller, day) -> revenue, item count and the day's most frequent category.

    Two stacked aggregates instead of MODE: (seller, day, category) first — a
    partial aggregate that collapses hot sellers before the shuffle — then
    (seller, day) picking the top category from the per-category counts.
    """
    return daily_of(seller_category_day(m))


def daily_of(grain: DataFrame) -> DataFrame:
    return grain.groupBy("seller_id", "order_date").agg(
        F.sum("rev").alias("gross_revenue"),
        F.sum("n").alias("items_sold"),
        mode_of("category", "n").alias("primary_category"))


def seller_lifetime_totals(daily: DataFrame) -> DataFrame:
    """Lifetime totals.  ``daily`` has one row per (seller, day), so the
    distinct-day count is a plain count."""
    return daily.groupBy("seller_id").agg(
        F.sum("gross_revenue").alias("total_revenue"),
        F.sum("items_sold").alias("total_items_sold"),
        F.count(F.lit(1)).alias("active_days"),
        F.min("order_date").alias("first_sale_date"),
        F.max("order_date").alias("last_sale_date"))


def seller_pareto(totals: DataFrame, sellers: DataFrame) -> DataFrame:
    """Lifetime rank, quartile and cumulative revenue share, computed with the
    distributed global ordering (no single-partition window).

    Sellers without a known revenue rank last as one tie and add nothing to the
    running sum; the share is NULL when the total is 0."""
    ranked = global_positions(totals, "total_revenue", "seller_id", amount="total_revenue")
    pct = round_half_up(F.try_divide(F.col(RUN).cast("double"), F.col(TOTAL).cast("double")) * 100.0, 1)
    out = ranked.select(
        *totals.columns,
        F.col(RANK).alias("lifetime_rank"),
        ntile(F.col(POS), F.col(COUNT), 4).alias("lifetime_quartile"),
        pct.alias("cumulative_revenue_pct"))
    return out.join(sellers.select("seller_id", "seller_city", "seller_state"), "seller_id", "left")


def trailing_90d(daily: DataFrame) -> DataFrame:
    """Days in [max - 90, max) where max is the last sale day overall (half-open)."""
    last = scalar(daily, F.max("order_date"))
    return (daily.filter((F.col("order_date") >= F.date_sub(last, 90)) & (F.col("order_date") < last))
                 .withColumn("max_date", last))


def trailing_of(m: Marketplace) -> DataFrame:
    """J4 straight from the staged tables, for figures that need the last 90 days alone.

    The last sale day takes the order ids of the items (of known products, as in J1); then only
    orders of those days meet items, products and translation.  Where the staged orders are
    partitioned by ``purchase_month``, the scalar prunes their partitions before any file is read."""
    day = F.to_date("order_purchase_timestamp")
    valid = valid_orders(m.orders)
    known = m.order_items.select("order_id", "product_id").join(m.products.select("product_id"), "product_id", "left_semi")
    sold = valid.select("order_id", day.alias("order_date")).join(known, "order_id", "left_semi")
    last = scalar(sold, F.max("order_date"))
    recent = (day >= F.date_sub(last, 90)) & (day < last)
    if PURCHASE_MONTH in m.orders.columns:
        recent = (F.col(PURCHASE_MONTH) >= F.trunc(F.date_sub(last, 90), "MM")) & (F.col(PURCHASE_MONTH) <= last) & recent
    return daily_seller_revenue(m.replace(orders=valid.where(recent))).withColumn("max_date", last)


def seller_periods(trailing: DataFrame) -> DataFrame:
    """90-day totals, last-30 and prior-30 revenue, top category, active days.

    Stacked like J1: (seller, primary category) then seller, so the top category
    comes out of the same pass as the sums.
    """
    d, last = F.col("order_date"), F.col("max_date")
    zero = F.lit(0).cast(MONEY)
    l30 = F.when(d >= F.date_sub(last, 30), F.col("gross_revenue")).otherwise(zero)
    p30 = F.when((d >= F.date_sub(last, 60)) & (d < F.date_sub(last, 30)), F.col("gross_revenue")).otherwise(zero)
    per_cat = trailing.groupBy("seller_id", "primary_category").agg(
        F.sum("gross_revenue").alias("rev"), F.sum("items_sold").alias("items"),
        F.sum(l30).alias("l30"), F.sum(p30).alias("p30"), F.count(F.lit(1)).alias("days"))
    return per_cat.groupBy("seller_id").agg(
        F.sum("rev").alias("revenue_90d"), F.sum("items").alias("items_90d"),
        F.sum("l30").alias("revenue_l30d"), F.sum("p30").alias("revenue_p30d"),
        category_label(mode_of("primary_category", "days")).alias("top_category"),
        F.sum("days").alias("active_days_90d"))


def seller_growth(periods: DataFrame) -> DataFrame:
    """Month-over-month growth of the two 30-day halves."""
    l30, p30 = F.col("revenue_l30d").cast("double"), F.col("revenue_p30d").cast("double")
    growth = (F.when((p30 == 0) & (l30 > 0), F.lit(None).cast("double"))
               .when(p30 == 0, F.lit(0.0))
               .otherwise(round_half_up((l30 - p30) / p30 * 100.0, 1)))
    return periods.withColumn("mom_growth_pct", growth)


def seller_profile(m: Marketplace, sort: bool = True, grain: DataFrame | None = None) -> DataFrame:
    """Lifetime Pareto columns plus trailing-90-day activity (NULL when idle).

    ``grain`` is ``seller_category_day(m)`` if it is at hand."""
    # The seller-day grain feeds three reads (lifetime ranking, last-day subquery,
    # trailing window).  Materialised once in the checkpoint folder: items are scanned and joined once.
    daily = materialize(daily_of(grain) if grain is not None else daily_seller_revenue(m), "seller-daily")
    ranked = seller_pareto(seller_lifetime_totals(daily), m.sellers)
    growth = seller_growth(seller_periods(trailing_90d(daily)))
    out = (ranked.join(growth, "seller_id", "left")
                 .withColumn("is_top80_seller",
                             F.when(F.col("cumulative_revenue_pct") <= 80, 1).otherwise(0)))
    out = conform(out, SELLER_PROFILE_SCHEMA)
    return out.orderBy("lifetime_rank", "seller_id") if sort else out


DAILY_SELLER_SCHEMA = [("seller_id", "KEY"), ("order_date", "DATE"), ("gross_revenue", "DOUBLE"),
                       ("items_sold", "BIGINT"), ("primary_category", "VARCHAR")]
LIFETIME_SCHEMA = [("seller_id", "KEY"), ("total_revenue", "DOUBLE"), ("total_items_sold", "BIGINT"),
                   ("active_days", "BIGINT"), ("first_sale_date", "DATE"), ("last_sale_date", "DATE")]
PARETO_SCHEMA = LIFETIME_SCHEMA + [("seller_city", "VARCHAR"), ("seller_state", "VARCHAR"),
                                   ("lifetime_rank", "BIGINT"), ("lifetime_quartile", "BIGINT"),
                                   ("cumulative_revenue_pct", "DOUBLE")]
TRAILING_SCHEMA = DAILY_SELLER_SCHEMA + [("max_date", "DATE")]
PERIODS_SCHEMA = [("seller_id", "KEY"), ("revenue_90d", "DOUBLE"), ("items_90d", "BIGINT"),
                  ("revenue_l30d", "DOUBLE"), ("revenue_p30d", "DOUBLE"), ("top_category", "VARCHAR"),
                  ("active_days_90d", "BIGINT")]
GROWTH_SCHEMA = PERIODS_SCHEMA + [("mom_growth_pct", "DOUBLE")]
TOP_CATEGORY_SCHEMA = [("seller_id", "KEY"), ("top_category", "VARCHAR")]
VALID_ITEMS_SCHEMA = [("order_id", "KEY"), ("order_item_id", "KEY"), ("seller_id", "KEY"), ("order_date", "DATE"),
                      ("gross_revenue", "DOUBLE")]
ORDER_VALUE_STATS_SCHEMA = [("seller_id", "KEY"), ("items", "BIGINT"), ("avg_item_price", "DOUBLE"),
                            ("avg_freight_value", "DOUBLE"), ("avg_item_revenue", "DOUBLE")]


def filter_valid_orders(m: Marketplace) -> DataFrame:
    """Sold items with their gross revenue (price + freight)."""
    return sold_items(m).select("order_id", "order_item_id", "seller_id", "order_date",
                                item_revenue().alias("gross_revenue"))


def order_value_stats(m: Marketplace) -> DataFrame:
    """Per seller, mean item price, freight and revenue (double, rounded to cents), each over
    the items for which it is known."""
    def mean(c):
        return round_half_up(known_mean(c), 2)
    return sold_items(m).groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("items"), mean(F.col("price")).alias("avg_item_price"),
        mean(F.col("freight_value")).alias("avg_freight_value"), mean(item_revenue()).alias("avg_item_revenue"))
