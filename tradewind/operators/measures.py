"""Dashboard measures as aggregate DataFrames — SURVEY §2.M.

Inputs are the star schema and the marts.  Money held as 2-place doubles in
those tables is summed after an exact cast back to DECIMAL(18,2), so totals do
not depend on summation order.  Where the dashboard prose leaves a base open,
the choice is stated in the function's docstring.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import category_label, round_half_up
from tradewind.operators import category as cat
from tradewind.operators import churn, customer, seller, star
from tradewind.operators.common import conform, scalar
from tradewind.operators.ranking import COUNT, POS, global_positions, ntile, percentiles_cont
from tradewind.session import materialize
from tradewind.sources.tables import Marketplace

MONEY = "decimal(18,2)"
# Fixed values of the dashboard: activity stages (months since first sale) and the top-k size.
STAGES = [(3, "New"), (6, "Early"), (12, "Established")]
LAST_STAGE = "Veteran"
TOP_SELLERS = 10


def _exact(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(MONEY)


def _revenue(sales: DataFrame) -> Column:
    """The exact revenue of fact rows, or the sums of a rollup grain."""
    return F.col("revenue") if "revenue" in sales.columns else _exact("gross_revenue")


def _items(sales: DataFrame) -> Column:
    return F.sum("items_sold") if "items_sold" in sales.columns else F.count(F.lit(1))


def _with(sales: DataFrame, dimension: DataFrame | None, key: str, column: str) -> DataFrame:
    """``sales`` with ``column``: a rollup's cells have it, fact rows get it from the dimension."""
    return sales if dimension is None else sales.join(dimension.select(key, column), key, "left")


def _whole() -> Window:
    """Window over a whole, already aggregated table (rows bounded by tiers, states or
    calendar months — never by the data volume)."""
    return Window.partitionBy()


def _pct(num: Column, den: Column, places: int = 2) -> Column:
    return round_half_up(F.try_divide(num.cast("double"), den.cast("double")) * 100.0, places)


# ---------------------------------------------------------------- stored rollup

ROLLUP_MONEY = "decimal(38,2)"
CELL_KEYS = ("order_date", "customer_state", "seller_state", "category_name_en")
#: What the rollup reads of the fact; the last is the money it sums.
FACT_COLUMNS = ("order_id", "order_date", "seller_id", "product_id", "gross_revenue")
ROLLUP_CELLS_SCHEMA = [("order_date", "DATE"), ("customer_state", "VARCHAR"), ("seller_state", "VARCHAR"),
                       ("category_name_en", "VARCHAR"), ("revenue", "DOUBLE"), ("items_sold", "BIGINT")]
ROLLUP_ORDERS_SCHEMA = [("order_id", "KEY"), ("order_date", "DATE"), ("revenue", "DOUBLE"), ("items_sold", "BIGINT")]


@dataclass(frozen=True)
class SalesRollup:
    """Sums of the fact at the two grains that the overview measures need, both with
    ``revenue`` (exact, NULL if none is known) and ``items_sold``.

    ``cells``: one row per (day, customer state, seller state, category), bounded by the
    calendar and the fixed lists, however many items were sold.  ``orders``: one row per
    (order, day), since distinct orders cannot be added up over cells."""

    cells: DataFrame
    orders: DataFrame


def rollup_of(fact: DataFrame, sellers: DataFrame, products: DataFrame) -> DataFrame:
    """Both grains from one pass over the fact with its customers' states: two grouping sets, each combined map-side
    before the shuffle, so a hot order, seller or category does not load one task.  ``grain`` is 'order' or 'cell'.

    The sellers and products must have unique keys (they are the "one" sides of the star);
    an item without one of them has NULL there.  A task hashes its share of the products, narrow rows, and sorts no
    items for them: the memory is left to the sums."""
    sold = fact.select(*FACT_COLUMNS[:-1], "customer_state", _exact(FACT_COLUMNS[-1]).alias("revenue"))
    rows = (sold.join(sellers.select("seller_id", "seller_state"), "seller_id", "left")
                .join(products.select("product_id", "category_name_en").hint("shuffle_hash"), "product_id", "left"))
    keys = ["order_id", *CELL_KEYS]
    sums = rows.groupingSets([["order_id", "order_date"], list(CELL_KEYS)], *keys).agg(
        F.sum("revenue").cast(ROLLUP_MONEY).alias("revenue"), F.count(F.lit(1)).alias("items_sold"),
        F.grouping("order_id").alias("_cell"))
    return sums.withColumn("grain", F.when(F.col("_cell") == 1, "cell").otherwise("order")).drop("_cell")


def read_rollup(stored: DataFrame) -> SalesRollup:
    """The two grains of a stored rollup; a reader of one prunes the other's files by ``grain``."""
    sums = ("revenue", "items_sold")
    return SalesRollup(stored.where(F.col("grain") == "cell").select(*CELL_KEYS, *sums),
                       stored.where(F.col("grain") == "order").select("order_id", "order_date", *sums))


def sales_rollup(m: Marketplace) -> SalesRollup:
    """The rollup of the staged tables, written once in the shared folder: the fact is read once for all its measures.

    Orders meet their customers before their items, so the join by customer moves a row an order, not a row an item;
    customers must have unique keys too, and an order without one has NULL there.

    The sellers' states are written first: Spark then plans their join by their measured size, and moves the items for it
    only if that is large (its estimate for the staged sellers is the product of the tables joined in them)."""
    sellers = materialize(m.sellers.select("seller_id", "seller_state"), "seller-states")
    placed = m.orders.join(m.customers.select("customer_id", "customer_state"), "customer_id", "left")
    fact = star.fact_orders(m.replace(orders=placed), FACT_COLUMNS, of_order=["customer_state"])
    sums = rollup_of(fact, sellers, star.dim_product(m))
    return read_rollup(materialize(sums, "sales-rollup", partition_by=["grain"]))


# ---------------------------------------------------------------- market overview (M1-M5)

KPI_YOY_SCHEMA = [("year", "BIGINT"), ("gmv", "DOUBLE"), ("sales", "BIGINT"), ("aov", "DOUBLE"),
                  ("gmv_yoy_pct", "DOUBLE"), ("sales_yoy_pct", "DOUBLE"), ("aov_yoy_pct", "DOUBLE")]


def kpi_yoy(sales: DataFrame) -> DataFrame:
    """M1: GMV (sum of gross revenue), sales (distinct orders) and AOV per calendar
    year, each with its change against the previous year in %; from the fact or the rollup's orders.  The by-year
    table has one row per calendar year, so its year-ordered window is tiny."""
    # Per order and year first (an order repeated on two days counts once), so orders need no distinct count.
    order = sales.groupBy("order_id", F.year("order_date").alias("year")).agg(F.sum(_revenue(sales)).alias("g"))
    y = order.groupBy("year").agg(F.sum("g").alias("g"), F.count("order_id").alias("sales"))
    w = Window.orderBy("year")
    gmv = F.col("g").cast("double")
    aov = gmv / F.col("sales")
    prev_g, prev_s = F.lag(gmv).over(w), F.lag("sales").over(w)
    prev_aov = F.lag(aov).over(w)
    out = y.select(
        "year", gmv.alias("gmv"), "sales", round_half_up(aov, 2).alias("aov"),
        round_half_up(F.try_divide(gmv - prev_g, prev_g) * 100.0, 2).alias("gmv_yoy_pct"),
        round_half_up(F.try_divide((F.col("sales") - prev_s).cast("double"), prev_s.cast("double")) * 100.0, 2).alias("sales_yoy_pct"),
        round_half_up(F.try_divide(aov - prev_aov, prev_aov) * 100.0, 2).alias("aov_yoy_pct"))
    return conform(out, KPI_YOY_SCHEMA)


def daily_revenue(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue per calendar day of the date dimension, from the fact or the rollup's cells; days without sales are 0."""
    day = sales.groupBy("order_date").agg(F.sum(_revenue(sales)).alias("revenue"))
    return (dates.select("date", "day_of_week_num", "day_name")
                 .join(day, dates.date == day.order_date, "left")
                 .select("date", "day_of_week_num", "day_name",
                         F.coalesce("revenue", F.lit(0).cast(MONEY)).alias("revenue")))


MOVING_AVG_SCHEMA = [("date", "DATE"), ("revenue", "DOUBLE"), ("ma7", "DOUBLE"), ("ma30", "DOUBLE")]


def revenue_moving_avg(daily: DataFrame) -> DataFrame:
    """M2: daily revenue with 7- and 30-day trailing means (row frames over the
    calendar spine; its length is the number of days in range, not the data size)."""
    w = Window.orderBy("date")

    def ma(n: int) -> Column:
        f = w.rowsBetween(-(n - 1), 0)
        return round_half_up(F.sum("revenue").over(f).cast("double") / F.count(F.lit(1)).over(f), 2)
    return conform(daily.select("date", "revenue", ma(7).alias("ma7"), ma(30).alias("ma30")), MOVING_AVG_SCHEMA)


PEAK_DAY_SCHEMA = [("peak_date", "DATE"), ("peak_revenue", "DOUBLE")]


def peak_day(daily: DataFrame) -> DataFrame:
    """M3: the day with the highest revenue (earliest on ties)."""
    best = F.min_by(F.struct("date", "revenue"), F.struct((-F.col("revenue")).alias("r"), F.col("date")))
    return conform(daily.agg(best.alias("b")).select(F.col("b.date").alias("peak_date"),
                                                       F.col("b.revenue").alias("peak_revenue")), PEAK_DAY_SCHEMA)


WEEKDAY_SCHEMA = [("day_of_week_num", "BIGINT"), ("day_name", "VARCHAR"), ("avg_daily_revenue", "DOUBLE"),
                  ("days", "BIGINT")]


def revenue_by_weekday(daily: DataFrame) -> DataFrame:
    """M4: mean daily revenue per weekday over the calendar spine (zero days included)."""
    out = daily.groupBy("day_of_week_num", "day_name").agg(
        round_half_up(F.sum("revenue").cast("double") / F.count(F.lit(1)), 2).alias("avg_daily_revenue"),
        F.count(F.lit(1)).alias("days"))
    return conform(out, WEEKDAY_SCHEMA).orderBy(F.col("avg_daily_revenue").desc(), "day_of_week_num")


MATRIX_SCHEMA = [("customer_state", "VARCHAR"), ("month", "DATE"), ("revenue", "DOUBLE"), ("level", "BIGINT")]


def state_month_matrix(sales: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """M5: revenue by (customer state, month) with row, column and grand totals
    (CUBE; ``level`` = GROUPING_ID: 0 cell, 1 state total, 2 month total, 3 grand total).
    The state is the ordering customer's state.  ``sales``: the rollup's cells, or the fact with ``customers``."""
    x = _with(sales, customers, "customer_id", "customer_state")
    out = (x.cube("customer_state", F.trunc("order_date", "MM").alias("month"))
            .agg(F.sum(_revenue(sales)).alias("revenue"), F.grouping_id().alias("level")))
    return conform(out, MATRIX_SCHEMA)


# ---------------------------------------------------------------- sellers

SELLER_KPIS_SCHEMA = [("active_sellers_90d", "BIGINT"), ("growing_sellers", "BIGINT")]


def seller_kpis(profile: DataFrame) -> DataFrame:
    """M6: sellers with activity in the trailing 90 days; sellers with positive MoM growth.

    ``profile`` may be the seller mart or just its growth part (J6): nothing here needs the ranking."""
    out = profile.agg(F.count_if(F.col("revenue_90d").isNotNull()).alias("active_sellers_90d"),
                      F.count_if(F.col("mom_growth_pct") > 0).alias("growing_sellers"))
    return conform(out, SELLER_KPIS_SCHEMA)


TOP20_SCHEMA = [("top20_sellers", "BIGINT"), ("top20_revenue", "DOUBLE"), ("total_revenue", "DOUBLE"),
                ("top20_share_pct", "DOUBLE")]


def top20_share(totals: DataFrame) -> DataFrame:
    """M7: revenue share of the first quintile (NTILE(5) = 1) of sellers by lifetime revenue."""
    pos = global_positions(totals.select("seller_id", F.col("total_revenue").alias("_c")), "_c", "seller_id", rank=False)
    top = ntile(F.col(POS), F.col(COUNT), 5) == 1
    out = pos.agg(F.count_if(top).alias("top20_sellers"),
                  F.sum(F.when(top, F.col("_c"))).alias("tc"), F.sum("_c").alias("ac"))
    out = out.select("top20_sellers", F.col("tc").alias("top20_revenue"), F.col("ac").alias("total_revenue"),
                     _pct(F.col("tc"), F.col("ac")).alias("top20_share_pct"))
    return conform(out, TOP20_SCHEMA)


QUADRANT_SCHEMA = [("seller_id", "KEY"), ("revenue_l30d", "DOUBLE"), ("mom_growth_pct", "DOUBLE"),
                   ("lifetime_quartile", "BIGINT"), ("quadrant", "VARCHAR")]


def seller_quadrants(profile: DataFrame) -> DataFrame:
    """M8: size vs growth quadrants for sellers active in the last 90 days.  Size
    splits at the exact median of last-30-day revenue; growth is MoM % > 0, or
    growing from zero (NULL % with revenue in the last 30 days)."""
    active = profile.filter(F.col("revenue_90d").isNotNull())
    median = scalar(percentiles_cont(active, "revenue_l30d", {"p50": 0.5}), F.max("p50"))
    growing = (F.col("mom_growth_pct") > 0) | (F.col("mom_growth_pct").isNull() & (F.col("revenue_l30d") > 0))
    quad = F.concat(F.when(F.col("revenue_l30d") >= median, "Large").otherwise("Small"), F.lit(" & "),
                    F.when(growing, "Growing").otherwise("Declining"))
    return conform(active.withColumn("quadrant", quad), QUADRANT_SCHEMA)


STATE_REVENUE_SCHEMA = [("seller_state", "VARCHAR"), ("revenue", "DOUBLE"), ("revenue_share_pct", "DOUBLE")]


def revenue_by_state(sales: DataFrame, sellers: DataFrame | None = None) -> DataFrame:
    """M9: revenue per seller state with its share of the total; from the rollup's cells, or the fact with ``sellers``."""
    x = _with(sales, sellers, "seller_id", "seller_state")
    out = x.groupBy("seller_state").agg(F.sum(_revenue(sales)).alias("revenue"))
    total = F.sum("revenue").over(_whole())        # over the state rows
    return conform(out.withColumn("revenue_share_pct", _pct(F.col("revenue"), total)), STATE_REVENUE_SCHEMA)


TOP_SELLERS_SCHEMA = [("seller_id", "KEY"), ("seller_city", "VARCHAR"), ("seller_state", "VARCHAR"),
                      ("total_revenue", "DOUBLE"), ("lifetime_rank", "BIGINT")]


def top_sellers(profile: DataFrame, k: int = TOP_SELLERS) -> DataFrame:
    """The k sellers with the highest lifetime revenue (top-k; the limit is the feature)."""
    return conform(profile, TOP_SELLERS_SCHEMA).orderBy(F.col("total_revenue").desc(), "seller_id").limit(k)


SELLER_RECENT_SCHEMA = [("seller_id", "KEY"), ("seller_city", "VARCHAR"), ("seller_state", "VARCHAR"),
                        ("top_category", "VARCHAR"), ("revenue_90d", "DOUBLE"), ("lifetime_rank", "BIGINT"),
                        ("mom_growth_pct", "DOUBLE")]


def seller_recent(profile: DataFrame) -> DataFrame:
    """The seller table of the dashboard (projection of the profile)."""
    return conform(profile, SELLER_RECENT_SCHEMA)


# ---------------------------------------------------------------- churn

CHURN_KPIS_SCHEMA = [("critical_sellers", "BIGINT"), ("high_sellers", "BIGINT"), ("revenue_at_risk", "DOUBLE")]


def churn_kpis(risk: DataFrame) -> DataFrame:
    """Critical / High seller counts and their latest monthly revenue."""
    tier = F.col("churn_risk_tier")
    critical, high = churn.TIERS[0][1], churn.TIERS[1][1]
    at_risk = tier.isin(critical, high)
    out = risk.agg(F.count_if(tier == critical).alias("critical_sellers"),
                   F.count_if(tier == high).alias("high_sellers"),
                   F.coalesce(F.sum(F.when(at_risk, _exact("latest_revenue"))), F.lit(0).cast(MONEY))
                    .alias("revenue_at_risk"))
    return conform(out, CHURN_KPIS_SCHEMA)


def activity_stage(months: Column) -> Column:
    out = F.lit(LAST_STAGE)
    for upper, name in reversed(STAGES):
        out = F.when(months <= upper, name).otherwise(out)
    return out


CHURN_STAGE_SCHEMA = [("activity_stage", "VARCHAR"), ("churn_risk_tier", "VARCHAR"), ("sellers", "BIGINT"),
                      ("share_of_stage_pct", "DOUBLE")]


def churn_by_stage(risk: DataFrame) -> DataFrame:
    """Tier mix per activity stage (0-3 New, 4-6 Early, 7-12 Established, 13+ Veteran)."""
    g = (risk.withColumn("activity_stage", activity_stage(F.col("months_since_first_sale")))
             .groupBy("activity_stage", "churn_risk_tier").agg(F.count(F.lit(1)).alias("sellers")))
    stage_total = F.sum("sellers").over(Window.partitionBy("activity_stage"))
    return conform(g.withColumn("share_of_stage_pct", _pct(F.col("sellers"), stage_total)), CHURN_STAGE_SCHEMA)


CHURN_TIER_SCHEMA = [("churn_risk_tier", "VARCHAR"), ("sellers", "BIGINT"), ("share_pct", "DOUBLE")]


def churn_tier_counts(risk: DataFrame) -> DataFrame:
    """Sellers per tier and their share."""
    g = risk.groupBy("churn_risk_tier").agg(F.count(F.lit(1)).alias("sellers"))
    total = F.sum("sellers").over(_whole())        # over the tier rows (at most four)
    return conform(g.withColumn("share_pct", _pct(F.col("sellers"), total)), CHURN_TIER_SCHEMA)


# ---------------------------------------------------------------- categories

def category_monthly_overall(m: Marketplace) -> DataFrame:
    """Complete-month revenue per category over all states (the dashboard's grain)."""
    monthly = cat.monthly_category(cat.daily_category_materialized(m))
    return monthly.groupBy("category_name_en", "month").agg(F.sum("monthly_revenue").alias("monthly_revenue"))


def category_trends_overall(m: Marketplace) -> DataFrame:
    """J17-J19 at category grain: share per month, delta per category, labels."""
    share = cat.category_share(category_monthly_overall(m), by=("month",))
    return cat.trend_labels(cat.category_share_delta(share, by=("category_name_en",)))


CATEGORY_KPIS_SCHEMA = [("latest_month", "DATE"), ("top_gainer", "VARCHAR"), ("top_gainer_delta_pp", "DOUBLE"),
                        ("top_loser", "VARCHAR"), ("top_loser_delta_pp", "DOUBLE"),
                        ("gaining_categories", "BIGINT"), ("losing_categories", "BIGINT")]


def category_kpis(trends: DataFrame) -> DataFrame:
    """In the latest complete month, the biggest share gainer and loser (by
    share delta; ties to the smallest name) and the gaining / losing counts."""
    last = scalar(trends, F.max("month"))
    x = trends.filter(F.col("month") == last).withColumn("label", category_label("category_name_en"))
    delta = F.col("share_delta_pp")
    gain = F.min_by(F.struct(F.col("label"), delta), F.when(delta.isNotNull(), F.struct(-delta, F.col("label"))))
    lose = F.min_by(F.struct(F.col("label"), delta), F.when(delta.isNotNull(), F.struct(delta, F.col("label"))))
    out = x.agg(F.max("month").alias("latest_month"), gain.alias("g"), lose.alias("l"),
                F.count_if(F.col("share_trend") == cat.TREND_GAINING).alias("gaining_categories"),
                F.count_if(F.col("share_trend") == cat.TREND_LOSING).alias("losing_categories"))
    out = out.select("latest_month", F.col("g.label").alias("top_gainer"),
                     F.col("g.share_delta_pp").alias("top_gainer_delta_pp"), F.col("l.label").alias("top_loser"),
                     F.col("l.share_delta_pp").alias("top_loser_delta_pp"), "gaining_categories",
                     "losing_categories")
    return conform(out, CATEGORY_KPIS_SCHEMA)


CATEGORY_SNAPSHOT_SCHEMA = [("category_name_en", "VARCHAR"), ("month", "DATE"), ("rank_in_month", "BIGINT"),
                            ("months_active", "BIGINT"), ("prev_month_share_pct", "DOUBLE"),
                            ("revenue_share_pct", "DOUBLE"), ("share_delta_pp", "DOUBLE"),
                            ("share_trend", "VARCHAR"), ("revenue_vs_avg", "VARCHAR")]


def category_snapshot(trends: DataFrame) -> DataFrame:
    """One row per category in the latest complete month."""
    last = scalar(trends, F.max("month"))
    x = trends.filter(F.col("month") == last).withColumn("category_name_en", category_label("category_name_en"))
    return conform(x, CATEGORY_SNAPSHOT_SCHEMA).orderBy("rank_in_month")


CATEGORY_REVENUE_SCHEMA = [("category_name_en", "VARCHAR"), ("revenue", "DOUBLE"), ("items_sold", "BIGINT")]


def revenue_by_category(sales: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Lifetime revenue per category label of the product dimension; from the rollup's cells, or the fact with ``products``."""
    x = _with(sales, products, "product_id", "category_name_en")
    out = x.groupBy("category_name_en").agg(F.sum(_revenue(sales)).alias("revenue"),
                                            _items(sales).alias("items_sold"))
    return conform(out, CATEGORY_REVENUE_SCHEMA).orderBy(F.col("revenue").desc(), "category_name_en")


CATEGORY_RANK_SCHEMA = [("month", "DATE"), ("category_name_en", "VARCHAR"), ("monthly_revenue", "DOUBLE"),
                        ("rank_in_month", "BIGINT")]


def category_rank_monthly(m: Marketplace) -> DataFrame:
    """Category rank per complete month (bump chart)."""
    share = cat.category_share(category_monthly_overall(m), by=("month",))
    return conform(share.withColumn("category_name_en", category_label("category_name_en")), CATEGORY_RANK_SCHEMA)


# ---------------------------------------------------------------- customers

CUSTOMER_KPIS_SCHEMA = [("customers_with_orders", "BIGINT"), ("clv", "DOUBLE"), ("returning_rate_pct", "DOUBLE"),
                        ("cancellation_rate_pct", "DOUBLE"), ("on_time_rate_pct", "DOUBLE")]


def customer_kpis(cd: DataFrame) -> DataFrame:
    """CLV = revenue / persons with a paid order; returning % and the base;
    cancellation % = cancelled / all orders; on-time % = on-time / delivered."""
    out = cd.agg(F.count_if(F.col("total_orders") > 0).alias("buyers"),
                 F.sum(_exact("total_revenue")).alias("rev"), F.sum("is_repeat_customer").alias("rep"),
                 F.sum("canceled_orders").alias("canc"), F.sum("total_orders_all").alias("all_orders"),
                 F.sum("on_time_orders").alias("on_time"), F.sum("delivered_orders").alias("delivered"))
    out = out.select(
        F.col("buyers").alias("customers_with_orders"),
        round_half_up(F.try_divide(F.col("rev").cast("double"), F.col("buyers").cast("double")), 2).alias("clv"),
        _pct(F.col("rep"), F.col("buyers")).alias("returning_rate_pct"),
        _pct(F.col("canc"), F.col("all_orders")).alias("cancellation_rate_pct"),
        _pct(F.col("on_time"), F.col("delivered")).alias("on_time_rate_pct"))
    return conform(out, CUSTOMER_KPIS_SCHEMA)


DELIVERY_STATE_SCHEMA = [("customer_state", "VARCHAR"), ("avg_delivery_days", "DOUBLE"), ("delivered_orders", "BIGINT")]


def delivery_by_state(m: Marketplace) -> DataFrame:
    """Mean delivery days of delivered paid orders per ordering customer's state."""
    paid = customer.paid_orders(m).filter(F.col("delivery_days").isNotNull())
    x = paid.join(m.customers.select("customer_id", "customer_state"), "customer_id", "left")
    out = x.groupBy("customer_state").agg(
        round_half_up(F.sum("delivery_days").cast("double") / F.count(F.lit(1)), 2).alias("avg_delivery_days"),
        F.count(F.lit(1)).alias("delivered_orders"))
    return conform(out, DELIVERY_STATE_SCHEMA).orderBy(F.col("avg_delivery_days").desc(), "customer_state")


TIER_REVENUE_SCHEMA = [("revenue_tier", "VARCHAR"), ("customers", "BIGINT"), ("revenue", "DOUBLE"),
                       ("revenue_share_pct", "DOUBLE")]


def revenue_by_tier(cd: DataFrame) -> DataFrame:
    """Revenue per customer value tier and its share."""
    g = cd.groupBy("revenue_tier").agg(F.count(F.lit(1)).alias("customers"),
                                       F.sum(_exact("total_revenue")).alias("revenue"))
    total = F.sum("revenue").over(_whole())        # over the tier rows (at most four)
    return conform(g.withColumn("revenue_share_pct", _pct(F.col("revenue"), total)), TIER_REVENUE_SCHEMA)


ACQUISITION_SCHEMA = [("cohort_month", "DATE"), ("x", "BIGINT"), ("new_customers", "BIGINT"),
                      ("trend_new_customers", "DOUBLE")]


def acquisition_trend(cd: DataFrame) -> DataFrame:
    """New persons per cohort month and a least-squares trend line with
    X = months since the first cohort + 1.  The fit runs over the cohort table
    (one row per calendar month), and its sums are exact integers, so slope and
    intercept do not depend on summation order."""
    g = (cd.filter(F.col("cohort_month").isNotNull())
           .groupBy("cohort_month").agg(F.count(F.lit(1)).alias("y")))
    w = _whole()
    idx = F.year("cohort_month") * 12 + F.month("cohort_month")
    g = g.withColumn("x", (idx - F.min(idx).over(w) + 1).cast("bigint"))
    n, sx, sy = F.count(F.lit(1)).over(w), F.sum("x").over(w), F.sum("y").over(w)
    sxy, sxx = F.sum(F.col("x") * F.col("y")).over(w), F.sum(F.col("x") * F.col("x")).over(w)
    fit = g.select("*", n.alias("n"), sx.alias("sx"), sy.alias("sy"), sxy.alias("sxy"), sxx.alias("sxx"))
    slope = F.try_divide((F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")).cast("double"),
                         (F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")).cast("double"))
    intercept = (F.col("sy").cast("double") - slope * F.col("sx").cast("double")) / F.col("n").cast("double")
    out = fit.select("cohort_month", "x", F.col("y").alias("new_customers"),
                     round_half_up(intercept + slope * F.col("x").cast("double"), 4).alias("trend_new_customers"))
    return conform(out, ACQUISITION_SCHEMA)


# ---------------------------------------------------------------- wiring from the staged tables

def _profile(m: Marketplace) -> DataFrame:
    return seller.seller_profile(m, sort=False)


def _growth(m: Marketplace) -> DataFrame:
    return seller.seller_growth(seller.seller_periods(seller.trailing_of(m)))


def _cd(m: Marketplace) -> DataFrame:
    return customer.customer_and_delivery(m, sort=False)


# The measures that one stored rollup answers; ``dates`` is the date dimension.
FROM_ROLLUP = {
    "kpi_yoy": lambda r, dates: kpi_yoy(r.orders),
    "revenue_moving_avg": lambda r, dates: revenue_moving_avg(daily_revenue(r.cells, dates)),
    "peak_day": lambda r, dates: peak_day(daily_revenue(r.cells, dates)),
    "revenue_by_weekday": lambda r, dates: revenue_by_weekday(daily_revenue(r.cells, dates)),
    "state_month_matrix": lambda r, dates: state_month_matrix(r.cells),
    "revenue_by_state": lambda r, dates: revenue_by_state(r.cells),
    "revenue_by_category": lambda r, dates: revenue_by_category(r.cells),
}


def market_overview(m: Marketplace) -> dict[str, DataFrame]:
    """All measures of ``FROM_ROLLUP`` from one stored rollup, so one scan of the fact."""
    stored, dates = sales_rollup(m), star.dim_date(m)
    return {name: fn(stored, dates) for name, fn in FROM_ROLLUP.items()}


MEASURES = {
    **{name: (lambda m, fn=fn: fn(sales_rollup(m), star.dim_date(m))) for name, fn in FROM_ROLLUP.items()},
    "sales_rollup_cells": lambda m: conform(sales_rollup(m).cells, ROLLUP_CELLS_SCHEMA),
    "sales_rollup_orders": lambda m: conform(sales_rollup(m).orders, ROLLUP_ORDERS_SCHEMA),
    "seller_kpis": lambda m: seller_kpis(_growth(m)),
    "top20_share": lambda m: top20_share(seller.seller_lifetime_totals(seller.daily_seller_revenue(m))),
    "seller_quadrants": lambda m: seller_quadrants(_profile(m)),
    "top_sellers": lambda m: top_sellers(_profile(m)),
    "seller_recent": lambda m: seller_recent(_profile(m)),
    "churn_kpis": lambda m: churn_kpis(churn.churn_risk(m, sort=False)),
    "churn_by_stage": lambda m: churn_by_stage(churn.churn_risk(m, sort=False)),
    "churn_tier_counts": lambda m: churn_tier_counts(churn.churn_risk(m, sort=False)),
    "category_kpis": lambda m: category_kpis(category_trends_overall(m)),
    "category_snapshot": lambda m: category_snapshot(category_trends_overall(m)),
    "category_rank_monthly": category_rank_monthly,
    "customer_kpis": lambda m: customer_kpis(_cd(m)),
    "delivery_by_state": delivery_by_state,
    "revenue_by_tier": lambda m: revenue_by_tier(_cd(m)),
    "acquisition_trend": lambda m: acquisition_trend(_cd(m)),
}
