"""Category revenue-share mart — SURVEY §2.J15-J19.

Grain: (category, month, seller state) for complete months.  The share and
trend helpers take their partition keys as a parameter so the dashboard's
category-grain view (M15-M16) reuses them without the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import category_label, known_mean, round_half_up
from tradewind.operators.common import conform, scalar
from tradewind.operators.seller import seller_category_day
from tradewind.session import materialize
from tradewind.sources.tables import Marketplace

# Fixed values of the source pipeline: trend and average-comparison labels and thresholds.
TREND_NEW, TREND_RETURNED, TREND_GAINING, TREND_LOSING, TREND_STABLE = (
    "New", "Returned", "Gaining Share", "Losing Share", "Stable")
VS_ABOVE, VS_BELOW, VS_ON_TRACK = "Above Average", "Below Average", "On Track"
SHARE_TREND_THRESHOLD = 0.20
AVG_BAND = (0.9, 1.1)

DAILY_CATEGORY_SCHEMA = [("category_name_en", "VARCHAR"), ("seller_state", "VARCHAR"), ("order_date", "DATE"),
                         ("gross_revenue", "DOUBLE"), ("items_sold", "BIGINT"), ("active_sellers", "BIGINT"),
                         ("avg_item_price", "DOUBLE")]
MONTHLY_CATEGORY_SCHEMA = [("category_name_en", "VARCHAR"), ("seller_state", "VARCHAR"), ("month", "DATE"),
                           ("monthly_revenue", "DOUBLE"), ("monthly_items", "BIGINT"), ("active_sellers", "BIGINT"),
                           ("avg_item_price", "DOUBLE")]
CATEGORY_SHARE_SCHEMA = MONTHLY_CATEGORY_SCHEMA + [("revenue_share_pct", "DOUBLE"), ("rank_in_month", "BIGINT")]
CATEGORY_DELTA_SCHEMA = CATEGORY_SHARE_SCHEMA + [
    ("share_delta_pp", "DOUBLE"), ("prev_month_share_pct", "DOUBLE"), ("months_active", "BIGINT"),
    ("avg_monthly_revenue", "DOUBLE"), ("peak_monthly_revenue", "DOUBLE")]
CATEGORY_ANALYSIS_SCHEMA = [
    ("category_name_en", "VARCHAR"), ("seller_state", "VARCHAR"), ("month", "DATE"), ("rank_in_month", "BIGINT"),
    ("monthly_revenue", "DOUBLE"), ("monthly_items", "BIGINT"), ("active_sellers", "BIGINT"),
    ("revenue_share_pct", "DOUBLE"), ("share_delta_pp", "DOUBLE"), ("prev_month_share_pct", "DOUBLE"),
    ("months_active", "BIGINT"), ("avg_monthly_revenue", "DOUBLE"), ("peak_monthly_revenue", "DOUBLE"),
    ("share_trend", "VARCHAR"), ("revenue_vs_avg", "VARCHAR")]


def daily_category_revenue(m: Marketplace, grain: DataFrame | None = None) -> DataFrame:
    """(category, seller state, day) revenue, items, distinct sellers, mean price.

    Built on the (seller, category, day) grain, which has one row per active seller:
    counting them needs no distinct, and a hot seller's items are combined before the
    seller join."""
    sellers = m.sellers.select("seller_id", F.upper(F.trim("seller_state")).alias("seller_state"))
    x = ((grain if grain is not None else seller_category_day(m)).join(sellers, "seller_id")
         .withColumnRenamed("category", "category_name_en"))
    return x.groupBy("category_name_en", "seller_state", "order_date").agg(
        F.sum("rev").alias("gross_revenue"),
        F.sum("n").alias("items_sold"),
        F.count(F.lit(1)).alias("active_sellers"),
        round_half_up(F.try_divide(F.sum("price").cast("double"), F.sum("n_price").cast("double")), 2)
         .alias("avg_item_price"))


def monthly_category(daily: DataFrame) -> DataFrame:
    """Roll days up to months, keeping a month only when the last sale day
    overall falls on or after the first day of the next month (so the month of
    the last sale day is always dropped as possibly partial)."""
    last = scalar(daily, F.max("order_date"))
    month = F.trunc("order_date", "MM")
    exact_price = F.col("avg_item_price").cast("decimal(18,2)")
    out = daily.groupBy("category_name_en", "seller_state", month.alias("month")).agg(
        F.sum("gross_revenue").alias("monthly_revenue"),
        F.sum("items_sold").alias("monthly_items"),
        F.max("active_sellers").alias("active_sellers"),
        round_half_up(known_mean(exact_price), 2).alias("avg_item_price"))
    return out.filter(F.add_months("month", 1) <= last)


def category_share(monthly: DataFrame, by=("seller_state", "month"), category="category_name_en") -> DataFrame:
    """Share of the partition's revenue (2 places) and deterministic rank."""
    w = Window.partitionBy(*by)
    total = F.nullif(F.sum("monthly_revenue").over(w), F.lit(0)).cast("double")
    share = round_half_up(F.col("monthly_revenue").cast("double") * 100.0 / total, 2)
    rank = F.row_number().over(w.orderBy(F.col("monthly_revenue").desc(), F.col(category).asc()))
    return monthly.select("*", share.alias("revenue_share_pct"), rank.alias("rank_in_month"))


def category_share_delta(share: DataFrame, by=("category_name_en", "seller_state")) -> DataFrame:
    """Change of share against the previous *active* month, lifetime stats (the mean over months of
    known revenue)."""
    life = Window.partitionBy(*by)
    ordered = life.orderBy("month")
    prev = F.lag("revenue_share_pct", 1).over(ordered)
    n = F.count(F.lit(1)).over(life)
    return share.select(
        "*",
        round_half_up(F.col("revenue_share_pct") - prev, 2).alias("share_delta_pp"),
        prev.alias("prev_month_share_pct"),
        n.alias("months_active"),
        round_half_up(known_mean("monthly_revenue", life), 2).alias("avg_monthly_revenue"),
        round_half_up(F.max("monthly_revenue").over(life), 2).alias("peak_monthly_revenue"))


def trend_labels(df: DataFrame) -> DataFrame:
    """J19 labels: share trend (relative ±20 %) and revenue vs own average (±10 %)."""
    prev, delta, months = F.col("prev_month_share_pct"), F.col("share_delta_pp"), F.col("months_active")
    ratio = F.try_divide(delta, prev)
    trend = (F.when(prev.isNull() & (months == 1), TREND_NEW)
              .when(prev.isNull() & (months > 1), TREND_RETURNED)
              .when(ratio >= SHARE_TREND_THRESHOLD, TREND_GAINING)
              .when(ratio <= -SHARE_TREND_THRESHOLD, TREND_LOSING)
              .otherwise(TREND_STABLE))
    rev, avg = F.col("monthly_revenue").cast("double"), F.col("avg_monthly_revenue")
    vs = (F.when(rev > avg * AVG_BAND[1], VS_ABOVE)
           .when(rev < avg * AVG_BAND[0], VS_BELOW)
           .otherwise(VS_ON_TRACK))
    return df.withColumn("share_trend", trend).withColumn("revenue_vs_avg", vs)


def daily_category_materialized(m: Marketplace, grain: DataFrame | None = None) -> DataFrame:
    """J15 materialised: the day grain is read twice (monthly roll-up and the
    last-day subquery), and the subquery's filter is pushed into the main scan,
    so the two plans cannot share an exchange.  Materialise it once instead of
    joining all items twice."""
    return materialize(daily_category_revenue(m, grain), "category-daily")


def category_deltas_of(m: Marketplace, grain: DataFrame | None = None) -> DataFrame:
    return category_share_delta(category_share(monthly_category(daily_category_materialized(m, grain))))


def category_analysis(m: Marketplace, sort: bool = True, grain: DataFrame | None = None) -> DataFrame:
    """The category mart."""
    out = trend_labels(category_deltas_of(m, grain)).withColumn("category_name_en", category_label("category_name_en"))
    out = conform(out, CATEGORY_ANALYSIS_SCHEMA)
    return out.orderBy("month", "seller_state", "rank_in_month") if sort else out
