"""Customer value and delivery-experience mart — SURVEY §2.J20-J28.

Grain: one row per person (``customer_unique_id``).  Every per-person part is
an aggregate grouped on that key, so the final six-way left-join chain runs on
co-partitioned inputs without further shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import hour_boundary_diff, round_half_up, to_month
from tradewind.operators.common import EXCLUDED_STATUSES, conform, is_valid_status, item_revenue, scalar
from tradewind.operators.ranking import percentiles_cont
from tradewind.session import materialize
from tradewind.sources.tables import Marketplace

# Fixed values of the source pipeline: revenue tiers.
TIER_HIGH, TIER_MID, TIER_LOW, TIER_NONE = "High (80th pct)", "Mid (50th pct)", "Low", "No Completed Orders"
P_HIGH, P_MID = 0.80, 0.50
PERSON = "customer_unique_id"

ALL_CUSTOMERS_SCHEMA = [(PERSON, "KEY"), ("customer_state", "VARCHAR"), ("customer_city", "VARCHAR")]
DELIVERY_METRICS_SCHEMA = [
    ("order_id", "KEY"), ("customer_id", "KEY"), (PERSON, "KEY"), ("order_date", "DATE"),
    ("order_status", "VARCHAR"), ("delivery_days", "BIGINT"), ("approval_lag_hours", "BIGINT"), ("on_time", "BIGINT")]
ORDER_COUNTS_SCHEMA = [(PERSON, "KEY"), ("total_orders_all", "BIGINT"), ("canceled_orders", "BIGINT")]
ORDER_REVENUE_SCHEMA = [("order_id", "KEY"), ("order_revenue", "DOUBLE"), ("order_freight", "DOUBLE"),
                        ("items_in_order", "BIGINT")]
PERCENTILES_SCHEMA = [("p80", "DOUBLE"), ("p50", "DOUBLE")]
SECOND_PURCHASE_SCHEMA = [(PERSON, "KEY"), ("second_purchase_date", "DATE")]
CUSTOMER_DELIVERY_SCHEMA = [(PERSON, "KEY"), ("delivered_orders", "BIGINT"), ("on_time_orders", "BIGINT"),
                            ("avg_delivery_days", "DOUBLE"), ("min_delivery_days", "BIGINT"),
                            ("max_delivery_days", "BIGINT")]
CUSTOMER_SUMMARY_SCHEMA = [(PERSON, "KEY"), ("total_orders", "BIGINT"), ("total_revenue", "DOUBLE"),
                           ("avg_order_value", "DOUBLE"), ("revenue_tier", "VARCHAR"),
                           ("first_purchase_date", "DATE"), ("last_purchase_date", "DATE"), ("cohort_month", "DATE")]
CUSTOMER_AND_DELIVERY_SCHEMA = [
    (PERSON, "KEY"), ("customer_state", "VARCHAR"), ("customer_city", "VARCHAR"), ("cohort_month", "DATE"),
    ("total_orders", "BIGINT"), ("is_repeat_customer", "BIGINT"), ("first_purchase_date", "DATE"),
    ("last_purchase_date", "DATE"), ("customer_lifespan_days", "BIGINT"), ("days_to_repeat", "BIGINT"),
    ("total_revenue", "DOUBLE"), ("avg_order_value", "DOUBLE"), ("revenue_tier", "VARCHAR"),
    ("delivered_orders", "BIGINT"), ("on_time_orders", "BIGINT"), ("avg_delivery_days", "DOUBLE"),
    ("min_delivery_days", "BIGINT"), ("max_delivery_days", "BIGINT"), ("total_orders_all", "BIGINT"),
    ("canceled_orders", "BIGINT"), ("has_cancellation", "BIGINT")]


def all_customers(customers: DataFrame) -> DataFrame:
    """One row per person; state and city of the smallest customer id that has one."""
    def first_non_null(c: str):
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("customer_id"))).alias(c)
    return customers.groupBy(PERSON).agg(first_non_null("customer_state"), first_non_null("customer_city"))


def on_time_flag() -> F.Column:
    d, e = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    return F.when(d.isNotNull() & e.isNotNull() & (d <= e), 1).otherwise(0)


def delivery_metrics(m: Marketplace) -> DataFrame:
    """Valid orders with person, delivery days, approval lag (hours) and on-time flag."""
    o = m.orders.filter(is_valid_status()).join(m.customers.select("customer_id", PERSON), "customer_id")
    purchase = F.col("order_purchase_timestamp")
    return o.select(
        "order_id", "customer_id", PERSON,
        F.to_date(purchase).alias("order_date"), "order_status",
        F.datediff(F.to_date("order_delivered_customer_date"), F.to_date(purchase)).alias("delivery_days"),
        hour_boundary_diff(purchase, "order_approved_at").alias("approval_lag_hours"),
        on_time_flag().alias("on_time"))


def order_counts(m: Marketplace) -> DataFrame:
    """All orders and cancelled/unavailable orders per person (distinct order ids).

    Deduplicated at (person, order) first, then counted per person — two plain
    aggregates instead of two DISTINCT aggregates expanded over the same rows.
    """
    o = m.orders.join(m.customers.select("customer_id", PERSON), "customer_id")
    per_order = o.groupBy(PERSON, "order_id").agg(
        F.max(F.col("order_status").isin(*EXCLUDED_STATUSES).cast("int")).alias("bad"))
    return per_order.groupBy(PERSON).agg(F.count(F.lit(1)).alias("total_orders_all"),
                                         F.sum(F.coalesce("bad", F.lit(0))).alias("canceled_orders"))


def order_revenue(items: DataFrame) -> DataFrame:
    """Revenue, freight and item count per order."""
    return items.groupBy("order_id").agg(F.sum(item_revenue()).alias("order_revenue"),
                                         F.sum("freight_value").alias("order_freight"),
                                         F.count(F.lit(1)).alias("items_in_order"))


def paid_orders(m: Marketplace) -> DataFrame:
    """Valid orders joined to their revenue, one row per order (orders without items drop out)."""
    return delivery_metrics(m).join(order_revenue(m.order_items), "order_id")


def person_figures(paid: DataFrame) -> DataFrame:
    """All per-person figures of paid orders (one row per order) from two stacked aggregates, with no distinct count.

    The (person, day) grain comes first, combined map-side, so a heavy buyer's orders shrink
    to one row per calendar day; a person's days, sorted, then give the second purchase."""
    delivered = F.col("delivery_days").isNotNull()
    days = paid.groupBy(PERSON, "order_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_revenue").alias("rev"), F.count("order_revenue").alias("n_rev"),
        F.count("delivery_days").alias("delivered"), F.sum(F.when(delivered, F.col("on_time"))).alias("on_time"),
        F.sum("delivery_days").alias("wait"), F.min("delivery_days").alias("wait_min"),
        F.max("delivery_days").alias("wait_max"))
    day = F.when(F.col("order_date").isNotNull(), F.struct("order_date", "n"))
    x = days.groupBy(PERSON).agg(
        F.sum("n").alias("orders"), F.sum("rev").alias("rev"), F.sum("n_rev").alias("n_rev"),
        F.min("order_date").alias("first_purchase_date"), F.max("order_date").alias("last_purchase_date"),
        F.slice(F.array_sort(F.collect_list(day)), 1, 2).alias("first_days"),
        F.sum("delivered").alias("delivered"), F.sum("on_time").alias("on_time"), F.sum("wait").alias("wait"),
        F.min("wait_min").alias("wait_min"), F.max("wait_max").alias("wait_max"))
    first, second = F.get("first_days", F.lit(0)), F.get("first_days", F.lit(1))
    return x.withColumn("second_purchase_date", F.when(first["n"] >= 2, first["order_date"]).otherwise(second["order_date"])) \
        .drop("first_days")


def revenue_percentiles(figures: DataFrame) -> DataFrame:
    """Exact 80th and 50th percentile (continuous) of revenue per person."""
    return percentiles_cont(figures, "rev", {"p80": P_HIGH, "p50": P_MID})


def second_purchase(figures: DataFrame) -> DataFrame:
    """Date of each person's second paid order (same day counts)."""
    return figures.select(PERSON, "second_purchase_date").filter(F.col("second_purchase_date").isNotNull())


def customer_delivery(figures: DataFrame) -> DataFrame:
    """Delivered orders, on-time count and delivery-day stats per person."""
    return figures.filter(F.col("delivered") > 0).select(
        PERSON, F.col("delivered").alias("delivered_orders"), F.col("on_time").alias("on_time_orders"),
        round_half_up(F.try_divide(F.col("wait").cast("double"), F.col("delivered").cast("double")), 1).alias("avg_delivery_days"),
        F.col("wait_min").alias("min_delivery_days"), F.col("wait_max").alias("max_delivery_days"))


def customer_summary(figures: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """Orders, revenue, average order value (over orders of known revenue), value tier and cohort per person."""
    thresholds = thresholds if thresholds is not None else revenue_percentiles(figures)
    p80 = scalar(thresholds, F.max("p80"))
    p50 = scalar(thresholds, F.max("p50"))
    total = round_half_up(F.col("rev"), 2)
    tier = F.when(total >= p80, TIER_HIGH).when(total >= p50, TIER_MID).otherwise(TIER_LOW)
    return figures.select(PERSON, F.col("orders").alias("total_orders"), total.alias("total_revenue"),
                          round_half_up(F.try_divide(F.col("rev").cast("double"), F.col("n_rev").cast("double")), 2)
                          .alias("avg_order_value"),
                          tier.alias("revenue_tier"), "first_purchase_date", "last_purchase_date",
                          to_month("first_purchase_date").alias("cohort_month"))


def customer_and_delivery(m: Marketplace, sort: bool = True) -> DataFrame:
    """Every person, with purchase, revenue, delivery and cancellation columns."""
    # Paid orders are read once; the figures, a row per person, feed the percentiles and the mart.
    figures = materialize(person_figures(paid_orders(m)), "person-figures")
    out = (all_customers(m.customers)
           .join(customer_summary(figures), PERSON, "left")
           .join(second_purchase(figures), PERSON, "left")
           .join(customer_delivery(figures), PERSON, "left")
           .join(order_counts(m), PERSON, "left"))
    orders = F.coalesce("total_orders", F.lit(0))
    out = out.select(
        PERSON, "customer_state", "customer_city", "cohort_month",
        orders.alias("total_orders"),
        F.when(orders > 1, 1).otherwise(0).alias("is_repeat_customer"),
        "first_purchase_date", "last_purchase_date",
        F.datediff("last_purchase_date", "first_purchase_date").alias("customer_lifespan_days"),
        F.datediff("second_purchase_date", "first_purchase_date").alias("days_to_repeat"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        "avg_order_value",
        F.coalesce("revenue_tier", F.lit(TIER_NONE)).alias("revenue_tier"),
        "delivered_orders", "on_time_orders", "avg_delivery_days", "min_delivery_days", "max_delivery_days",
        "total_orders_all",
        F.coalesce("canceled_orders", F.lit(0)).alias("canceled_orders"),
        F.when(F.col("canceled_orders") > 0, 1).otherwise(0).alias("has_cancellation"))
    out = conform(out, CUSTOMER_AND_DELIVERY_SCHEMA)
    return out.orderBy(F.col("total_revenue").desc(), PERSON) if sort else out
