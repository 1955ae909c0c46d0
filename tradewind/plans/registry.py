"""One callable per operator key: ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole test tables of ``sf_dir`` through the staging
step; intermediate operators are registered with the same declared output
schema as their oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.operators import category as cat
from tradewind.operators import churn, customer, measures, quality, seller, staging, star
from tradewind.operators.common import conform
from tradewind.operators.staging import dedup_geolocation
from tradewind.plans import helpers
from tradewind.session import materialize
from tradewind.sources.tables import Marketplace
from tradewind.sources.testdata import load_testdata

Query = Callable[[SparkSession, str], DataFrame]


def _staged(fn: Callable[[Marketplace], DataFrame], **variant: bool) -> Query:
    """A query over the staged tables of ``sf_dir``, read anew each time: nothing is kept between
    queries, so a changed folder is seen and no query depends on another's files."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_testdata(spark, sf_dir, **variant))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _ts(m: Marketplace) -> DataFrame:
    return churn.seller_timeseries(churn.seller_history_of(m))


def _fold(m: Marketplace) -> DataFrame:
    return churn.seller_fold(churn.seller_history_of(m))


def _figures(m: Marketplace) -> DataFrame:
    return materialize(customer.person_figures(customer.paid_orders(m)), "person-figures")


REGISTRY: dict[str, Query] = {
    # seller profile
    "seller_profile": _staged(seller.seller_profile),
    "seller_profile_odd_money": _staged(seller.seller_profile, odd_money=True),
    # churn risk
    "seller_monthly": _staged(lambda m: conform(churn.seller_monthly(m), churn.SELLER_MONTHLY_SCHEMA)),
    "seller_cohort": _staged(lambda m: conform(churn.seller_cohort(churn.seller_monthly(m), m.sellers),
                                               churn.SELLER_COHORT_SCHEMA)),
    "seller_timeseries": _staged(lambda m: conform(_ts(m), churn.SELLER_TIMESERIES_SCHEMA)),
    "zero_month_streak": _staged(lambda m: conform(churn.zero_month_streak(_fold(m)), churn.ZERO_STREAK_SCHEMA),
                                 zero_months=True),
    "latest_month": _staged(lambda m: conform(churn.latest_month(_fold(m)), churn.LATEST_MONTH_SCHEMA)),
    "churn_signals": _staged(lambda m: conform(churn.churn_signals(_fold(m)), churn.CHURN_SIGNALS_SCHEMA)),
    "churn_risk": _staged(churn.churn_risk),
    "churn_risk_zero_months": _staged(churn.churn_risk, zero_months=True),
    "churn_risk_odd_money": _staged(churn.churn_risk, odd_money=True),
    # category analysis
    "daily_category_revenue": _staged(lambda m: conform(cat.daily_category_revenue(m), cat.DAILY_CATEGORY_SCHEMA)),
    "monthly_category": _staged(lambda m: conform(cat.monthly_category(cat.daily_category_revenue(m)),
                                                  cat.MONTHLY_CATEGORY_SCHEMA)),
    "category_share": _staged(lambda m: conform(
        cat.category_share(cat.monthly_category(cat.daily_category_revenue(m))), cat.CATEGORY_SHARE_SCHEMA)),
    "category_share_delta": _staged(lambda m: conform(cat.category_deltas_of(m), cat.CATEGORY_DELTA_SCHEMA)),
    "category_analysis": _staged(cat.category_analysis),
    "category_analysis_odd_money": _staged(cat.category_analysis, odd_money=True),
    # customer & delivery
    "all_customers": _staged(lambda m: conform(customer.all_customers(m.customers), customer.ALL_CUSTOMERS_SCHEMA)),
    "delivery_metrics": _staged(lambda m: conform(customer.delivery_metrics(m), customer.DELIVERY_METRICS_SCHEMA)),
    "incomplete_orders": _staged(lambda m: conform(customer.order_counts(m), customer.ORDER_COUNTS_SCHEMA)),
    "order_revenue": _staged(lambda m: conform(customer.order_revenue(m.order_items),
                                               customer.ORDER_REVENUE_SCHEMA)),
    "revenue_percentiles": _staged(lambda m: conform(customer.revenue_percentiles(_figures(m)),
                                                     customer.PERCENTILES_SCHEMA)),
    "second_purchase": _staged(lambda m: conform(customer.second_purchase(_figures(m)),
                                                 customer.SECOND_PURCHASE_SCHEMA)),
    "customer_delivery": _staged(lambda m: conform(customer.customer_delivery(_figures(m)),
                                                   customer.CUSTOMER_DELIVERY_SCHEMA)),
    "customer_summary": _staged(lambda m: conform(customer.customer_summary(_figures(m)),
                                                  customer.CUSTOMER_SUMMARY_SCHEMA)),
    "customer_and_delivery": _staged(customer.customer_and_delivery),
    "customer_and_delivery_odd_money": _staged(customer.customer_and_delivery, odd_money=True),
    # star schema
    "payments_deduped": _staged(lambda m: conform(star.payments_deduped(m.order_payments),
                                                  star.PAYMENTS_DEDUPED_SCHEMA)),
    "fact_orders": _staged(star.fact_orders),
    "dedup_geolocation": _staged(lambda m: conform(dedup_geolocation(m.geolocation), star.DEDUP_GEO_SCHEMA)),
    "dim_seller": _staged(star.dim_seller),
    "dim_customer": _staged(star.dim_customer),
    "dim_product": _staged(star.dim_product),
    "dim_date": _staged(star.dim_date),
}


REGISTRY.update({k: _staged(fn) for k, fn in measures.MEASURES.items()})


def _daily(m: Marketplace) -> DataFrame:
    return seller.daily_seller_revenue(m)


REGISTRY.update({
    # staging (B1-B7), counts (A7) and the quality gate
    **{f"stage_{name}": _staged(lambda m, name=name: conform(getattr(m, name), staging.STAGED_SCHEMAS[name]))
       for name in staging.STAGED_SCHEMAS},
    "staging_row_counts": _staged(lambda m: conform(staging.staging_row_counts(m), staging.ROW_COUNTS_SCHEMA)),
    "dq_report": _staged(lambda m: conform(quality.dq_report(m), quality.DQ_SCHEMA)),
    "dq_orphan_items": _staged(lambda m: conform(quality.orphan_items(m.order_items, m.orders),
                                                 staging.STAGED_SCHEMAS["order_items"])),
    # seller-profile steps (J1-J6) and helpers
    "filter_valid_orders": _staged(lambda m: conform(seller.filter_valid_orders(m), seller.VALID_ITEMS_SCHEMA)),
    "daily_seller_revenue": _staged(lambda m: conform(_daily(m), seller.DAILY_SELLER_SCHEMA)),
    "seller_lifetime_totals": _staged(lambda m: conform(seller.seller_lifetime_totals(_daily(m)),
                                                        seller.LIFETIME_SCHEMA)),
    "seller_pareto": _staged(lambda m: conform(seller.seller_pareto(seller.seller_lifetime_totals(_daily(m)),
                                                                    m.sellers), seller.PARETO_SCHEMA)),
    "trailing_90d": _staged(lambda m: conform(seller.trailing_90d(_daily(m)), seller.TRAILING_SCHEMA)),
    "seller_periods": _staged(lambda m: conform(seller.seller_periods(seller.trailing_90d(_daily(m))),
                                                seller.PERIODS_SCHEMA)),
    "seller_growth": _staged(lambda m: conform(seller.seller_growth(seller.seller_periods(seller.trailing_of(m))),
                                               seller.GROWTH_SCHEMA)),
    "seller_top_category": _staged(lambda m: conform(seller.seller_periods(seller.trailing_of(m)),
                                                     seller.TOP_CATEGORY_SCHEMA)),
    "order_value_stats": _staged(lambda m: conform(seller.order_value_stats(m), seller.ORDER_VALUE_STATS_SCHEMA)),
    "order_value_stats_odd_money": _staged(lambda m: conform(seller.order_value_stats(m), seller.ORDER_VALUE_STATS_SCHEMA),
                                           odd_money=True),
    "on_time_flag": _staged(lambda m: m.orders.select("order_id", (customer.on_time_flag() == 1)
                                                      .alias("delivered_on_time"))),
    "round_half_up": _staged(helpers.rounding_probe),
})
REGISTRY["title_case"] = helpers.title_case_probe


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
