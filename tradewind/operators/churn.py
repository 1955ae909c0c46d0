"""Seller churn-risk mart — SURVEY §2.J8-J14.

Grain: one row per seller whose first sale is at least 3 months before their
latest active month.  Lags, rolling mean, streak and latest month come from one
ordered fold over each seller's array of months, which holds at most one struct per
calendar month and takes one shuffle on ``seller_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import month_index_diff, round_half_up, to_month
from tradewind.operators.common import conform, item_revenue, valid_orders
from tradewind.sources.tables import Marketplace

# Fixed values of the source pipeline: score thresholds, tier names and actions.
TIERS = [
    (60, "Critical", "Immediate outreach (likely churned)"),
    (40, "High", "Schedule check-in call this week"),
    (20, "Medium", "Flag for monthly review"),
]
LOW_TIER, LOW_ACTION = "Low", "Monitor"
MIN_TENURE_MONTHS = 3
SIGNAL_CAP = 25

SELLER_MONTHLY_SCHEMA = [("seller_id", "KEY"), ("year_month", "DATE"), ("gross_revenue", "DOUBLE"),
                         ("orders", "BIGINT")]
SELLER_COHORT_SCHEMA = SELLER_MONTHLY_SCHEMA + [("seller_state", "VARCHAR"), ("cohort_month", "DATE"),
                                                ("months_since_first_sale", "BIGINT")]
SELLER_TIMESERIES_SCHEMA = SELLER_COHORT_SCHEMA + [
    ("prev_month_revenue", "DOUBLE"), ("revenue_3m_ago", "DOUBLE"), ("rolling_6m_avg", "DOUBLE"),
    ("is_zero_month", "BIGINT"), ("cumulative_zero_months", "BIGINT")]
ZERO_STREAK_SCHEMA = [("seller_id", "KEY"), ("last_seen_month", "DATE"), ("streak_length", "BIGINT"),
                      ("all_zeros_in_streak", "BIGINT")]
LATEST_MONTH_SCHEMA = [("seller_id", "KEY"), ("latest_month", "DATE"), ("latest_revenue", "DOUBLE"),
                       ("prev_month_revenue", "DOUBLE"), ("revenue_3m_ago", "DOUBLE"), ("rolling_6m_avg", "DOUBLE"),
                       ("months_since_first_sale", "BIGINT"), ("cohort_month", "DATE"), ("seller_state", "VARCHAR")]
CHURN_SIGNALS_SCHEMA = [
    ("seller_id", "KEY"), ("seller_state", "VARCHAR"), ("cohort_month", "DATE"),
    ("months_since_first_sale", "BIGINT"), ("latest_month", "DATE"), ("latest_revenue", "DOUBLE"),
    ("prev_month_revenue", "DOUBLE"), ("revenue_3m_ago", "DOUBLE"), ("rolling_6m_avg_revenue", "DOUBLE"),
    ("mom_revenue_change_pct", "DOUBLE"), ("vs_baseline_pct", "DOUBLE"), ("consecutive_zero_months", "BIGINT"),
    ("all_zeros_in_streak", "BIGINT"), ("churn_risk_score", "DOUBLE")]
CHURN_RISK_SCHEMA = [c for c in CHURN_SIGNALS_SCHEMA if c[0] not in ("revenue_3m_ago", "all_zeros_in_streak")] + [
    ("churn_risk_tier", "VARCHAR"), ("recommended_action", "VARCHAR")]

# Exact sums of money.
SUM = "decimal(38,6)"
#: Months of the rolling mean; the months that the fold keeps (LAG 3 needs four).
ROLLING = 6


def seller_monthly(m: Marketplace) -> DataFrame:
    """(seller, month) revenue and distinct orders of valid orders.

    Items are summed per (order, seller) first: a hot order is combined map-side
    before the order join, and orders are then counted without a distinct."""
    orders = valid_orders(m.orders).select("order_id", to_month("order_purchase_timestamp").alias("year_month"))
    sold = m.order_items.groupBy("order_id", "seller_id").agg(F.sum(item_revenue()).alias("rev"))
    return (sold.join(orders, "order_id")
             .groupBy("seller_id", "year_month")
             .agg(F.sum("rev").alias("gross_revenue"), F.count(F.lit(1)).alias("orders")))


def seller_cohort(monthly: DataFrame, sellers: DataFrame) -> DataFrame:
    """Cohort month (first active month) and months since it (boundary count)."""
    x = monthly.join(sellers.select("seller_id", "seller_state"), "seller_id")
    cohort = F.min("year_month").over(Window.partitionBy("seller_id"))
    return (x.withColumn("cohort_month", cohort)
             .withColumn("months_since_first_sale", month_index_diff("cohort_month", "year_month")))


def seller_history(monthly: DataFrame, sellers: DataFrame) -> DataFrame:
    """One row per seller: state, cohort month and the seller's ``months`` in order.

    The one exchange after ``seller_monthly``; everything up to the score is computed from this row.
    An array holds a struct per calendar month with sales, so its size is bounded by the calendar."""
    months = monthly.groupBy("seller_id").agg(
        F.array_sort(F.collect_list(F.struct("year_month", "gross_revenue", "orders"))).alias("months"))
    return (months.join(sellers.select("seller_id", "seller_state"), "seller_id")
                  .withColumn("cohort_month", F.array_min("months.year_month")))


def _mean(amounts: Column) -> Column:
    """Mean of the known amounts of an array; NULL if none is known."""
    known = F.filter(amounts, lambda v: v.isNotNull())
    total = F.aggregate(known, F.lit(0).cast(SUM), lambda acc, v: (acc + v).cast(SUM))
    return F.try_divide(total.cast("double"), F.size(known).cast("double"))


def seller_timeseries(history: DataFrame) -> DataFrame:
    """Previous *active* month, 3 active months ago, 6-row rolling mean, zero flags."""
    months = F.col("months")

    def derived(x: Column, i: Column) -> Column:
        before = lambda k: F.get(months, i - k)["gross_revenue"]
        six = F.slice(months, F.greatest(i - (ROLLING - 2), F.lit(1)), F.least(i + 1, F.lit(ROLLING)))
        upto = F.slice(months, F.lit(1), i + 1)
        return F.struct(
            x["year_month"].alias("year_month"), x["gross_revenue"].alias("gross_revenue"), x["orders"].alias("orders"),
            before(1).alias("prev_month_revenue"), before(3).alias("revenue_3m_ago"),
            _mean(F.transform(six, lambda s: s["gross_revenue"].cast(SUM))).alias("rolling_6m_avg"),
            F.when(x["gross_revenue"] == 0, 1).otherwise(0).alias("is_zero_month"),
            F.size(F.filter(upto, lambda s: s["gross_revenue"] == 0)).alias("cumulative_zero_months"))

    rows = history.select("seller_id", "seller_state", "cohort_month", F.inline(F.transform(months, derived)))
    return rows.withColumn("months_since_first_sale", month_index_diff("cohort_month", "year_month"))


def seller_fold(history: DataFrame) -> DataFrame:
    """J11 and J12 at once: one ordered pass over each seller's months.

    The state holds the last month, the last six revenues, the length of the stretch of months
    from the last one with revenue on (all of them, if there is none) and whether it is all zeros."""
    start = F.struct(F.lit(None).cast("date").alias("last"), F.array().cast(f"array<{SUM}>").alias("recent"),
                     F.lit(0).alias("streak"), F.lit(1).alias("zeros"))

    def step(acc: Column, x: Column) -> Column:
        zero = F.coalesce(x["gross_revenue"] == 0, F.lit(False))
        seen = F.concat(acc["recent"], F.array(x["gross_revenue"].cast(SUM)))
        return F.struct(x["year_month"].alias("last"),
                        F.slice(seen, F.greatest(F.size(seen) - (ROLLING - 1), F.lit(1)), F.lit(ROLLING)).alias("recent"),
                        F.when(zero, acc["streak"] + 1).otherwise(F.lit(1)).alias("streak"),
                        F.when(zero, acc["zeros"]).otherwise(F.lit(0)).alias("zeros"))

    return history.select("seller_id", "seller_state", "cohort_month", F.aggregate("months", start, step).alias("s"))


def zero_month_streak(fold: DataFrame) -> DataFrame:
    """Gap-and-island — the months since each seller's last month with revenue, that month included."""
    return fold.select("seller_id", F.col("s.last").alias("last_seen_month"), F.col("s.streak").alias("streak_length"),
                       F.col("s.zeros").alias("all_zeros_in_streak"))


def _latest() -> list[Column]:
    back = lambda k: F.try_element_at(F.col("s.recent"), F.lit(-1 - k))
    return [F.col("seller_id"), F.col("s.last").alias("latest_month"), back(0).alias("latest_revenue"),
            back(1).alias("prev_month_revenue"), back(3).alias("revenue_3m_ago"),
            _mean(F.col("s.recent")).alias("rolling_6m_avg"),
            month_index_diff("cohort_month", "s.last").alias("months_since_first_sale"),
            F.col("cohort_month"), F.col("seller_state")]


def latest_month(fold: DataFrame) -> DataFrame:
    """Each seller's newest month with its lags and rolling mean."""
    return fold.select(*_latest())


def _capped(x: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(SIGNAL_CAP), x))


def _drop_signal(base: Column, latest: Column) -> Column:
    return _capped(F.when(base > 0, (base - latest) / base * SIGNAL_CAP).otherwise(F.lit(0)))


def churn_signals(fold: DataFrame) -> DataFrame:
    """Four capped signals (0-25 each) summed into a 0-100 score.

    As in SQL, ``LEAST(25, NULL)`` is 25: an unknown latest revenue against a known base counts as a full drop."""
    x = fold.select(*_latest(), F.col("s.streak").alias("streak_length"), F.col("s.zeros").alias("all_zeros_in_streak")) \
        .filter(F.col("months_since_first_sale") >= MIN_TENURE_MONTHS)
    cur = F.col("latest_revenue").cast("double")
    prev = F.col("prev_month_revenue").cast("double")
    ago3 = F.col("revenue_3m_ago").cast("double")
    avg6 = F.col("rolling_6m_avg")
    streak = F.col("streak_length")
    s3 = _capped(F.when(F.coalesce(streak, F.lit(0)) >= 2, (streak - 1) * SIGNAL_CAP).otherwise(F.lit(0)))
    score = F.least(F.lit(100), _drop_signal(prev, cur) + _drop_signal(ago3, cur) + s3 + _drop_signal(avg6, cur))
    return x.select(
        "seller_id", "seller_state", "cohort_month", "months_since_first_sale", "latest_month",
        round_half_up(F.coalesce(cur, F.lit(0.0)), 2).alias("latest_revenue"),
        round_half_up(prev, 2).alias("prev_month_revenue"),
        ago3.alias("revenue_3m_ago"),
        round_half_up(avg6, 2).alias("rolling_6m_avg_revenue"),
        F.when(prev.isNull() | (prev == 0), F.lit(None).cast("double"))
         .otherwise(round_half_up((cur - prev) / prev * 100.0, 1)).alias("mom_revenue_change_pct"),
        F.when((avg6 == 0) | avg6.isNull(), F.lit(None).cast("double"))
         .otherwise(round_half_up((cur - avg6) / avg6 * 100.0, 1)).alias("vs_baseline_pct"),
        streak.alias("consecutive_zero_months"),
        F.col("all_zeros_in_streak"),
        round_half_up(score, 1).alias("churn_risk_score"))


def risk_tier(score: Column) -> tuple[Column, Column]:
    tier, action = F.lit(LOW_TIER), F.lit(LOW_ACTION)
    for threshold, name, todo in reversed(TIERS):
        tier = F.when(score >= threshold, name).otherwise(tier)
        action = F.when(score >= threshold, todo).otherwise(action)
    return tier, action


def seller_history_of(m: Marketplace) -> DataFrame:
    return seller_history(seller_monthly(m), m.sellers)


def churn_risk(m: Marketplace, sort: bool = True) -> DataFrame:
    """The at-risk seller list with tier and recommended action."""
    signals = churn_signals(seller_fold(seller_history_of(m)))
    tier, action = risk_tier(F.col("churn_risk_score"))
    out = conform(signals.withColumn("churn_risk_tier", tier).withColumn("recommended_action", action),
                  CHURN_RISK_SCHEMA)
    if sort:
        out = out.orderBy(F.col("churn_risk_score").desc(), F.col("months_since_first_sale").desc(), "seller_id")
    return out
