"""Staging transforms (cleaning and typing) — SURVEY §2.B."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions import safe_int, title_case
from tradewind.sources.tables import LazyTables, Marketplace, RawMarketplace

# Money keeps every digit of the input: 22 before and 6 after the point.
MONEY = "decimal(28,6)"
ORDER_TIMES = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date")
#: First day of the purchase month: the column that stored orders are partitioned by.
PURCHASE_MONTH = "purchase_month"
PRODUCT_SIZES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
                 "product_photos_qty")


# Text that names no finite number.
NOT_FINITE = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"


def exact_money(raw: DataFrame, col: str, table: str, keys: tuple[str, ...] = ("order_id",)) -> Column:
    """Money without any rounding.

    Text that is no number, and NaN or an infinity, become NULL, which the gate counts for
    prices.  A number with more digits than the type holds stops the job, naming table,
    column and row, instead of being cut."""
    kind = raw.schema[col].dataType
    value = F.col(col).try_cast(MONEY)
    if isinstance(kind, T.DecimalType) and kind.scale <= 6 and kind.precision - kind.scale <= 22:
        return value.alias(col)
    number = F.col(col).try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & ~F.col(col).cast("string").rlike(NOT_FINITE)
    whole = F.col(col).try_cast("decimal(38,16)")
    lost = finite & (value.isNull() | (whole.isNotNull() & (whole != value)))
    row = [x for k in keys for x in (F.lit(f" {k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL")))]
    said = F.concat(F.lit(f"{table}.{col} needs more digits than {MONEY} holds: "), F.col(col).cast("string"), F.lit(" at"), *row)
    return F.when(lost, F.raise_error(said).cast(MONEY)).when(finite, value).alias(col)


def clean_sellers(raw: DataFrame) -> DataFrame:
    """B1: zip padded to 5 characters, city title-cased, state upper-cased."""
    return raw.select(
        "seller_id",
        F.lpad(F.col("seller_zip_code_prefix").cast("string"), 5, "0").alias("seller_zip_code"),
        title_case(F.trim("seller_city")).alias("seller_city"),
        F.upper(F.trim("seller_state")).alias("seller_state"))


def clean_products(raw: DataFrame) -> DataFrame:
    """B2: lenient integer casts of the size columns; rows without an id dropped."""
    return (raw.filter(F.col("product_id").isNotNull())
               .select("product_id", "product_category_name",
                       *[safe_int(c).alias(c) for c in PRODUCT_SIZES]))


def clean_category_translation(raw: DataFrame) -> DataFrame:
    """Projection."""
    return raw.select("product_category_name", "product_category_name_english")


def clean_orders(raw: DataFrame) -> DataFrame:
    """Timestamps cast leniently.  The NULL filter applies to the *raw* purchase
    value, so an unparsable time survives as NULL (the gate's L4 catches it)."""
    return (raw.filter(F.col("order_purchase_timestamp").isNotNull())
               .select("order_id", "customer_id", "order_status",
                       *[F.col(c).try_cast("timestamp_ntz").alias(c) for c in ORDER_TIMES]))


def by_purchase_month(orders: DataFrame) -> DataFrame:
    """Orders with their purchase month, one or several partitions a month: AQE sizes them, so a month
    that holds most orders is written by many tasks and small months share one."""
    return orders.withColumn(PURCHASE_MONTH, F.to_date(F.trunc("order_purchase_timestamp", "MM"))) \
        .hint("rebalance", PURCHASE_MONTH)


def clean_order_items(raw: DataFrame, orders: DataFrame) -> DataFrame:
    """Money cast, and only items whose order was staged (semi join)."""
    typed = raw.select("order_id", "order_item_id", "product_id", "seller_id",
                       *[exact_money(raw, c, "order_items", ("order_id", "order_item_id")) for c in ("price", "freight_value")])
    return typed.join(orders.select("order_id"), "order_id", "left_semi")


def clean_order_payments(raw: DataFrame) -> DataFrame:
    """Installments and value cast; ``payment_sequential`` stays text."""
    return raw.select("order_id", F.col("payment_sequential").cast("string").alias("payment_sequential"),
                      "payment_type", safe_int("payment_installments").alias("payment_installments"),
                      exact_money(raw, "payment_value", "order_payments", ("order_id", "payment_sequential")))


def clean_customers(raw: DataFrame) -> DataFrame:
    """State upper/trim, city title-case/trim; one row per customer id."""
    return raw.select("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                      title_case(F.trim("customer_city")).alias("customer_city"),
                      F.upper(F.trim("customer_state")).alias("customer_state"))


def clean_geolocation(raw: DataFrame) -> DataFrame:
    """B8 (first half): lenient coordinate casts, raw grain kept."""
    return raw.select(F.col("geolocation_zip_code_prefix").alias("zip_code"),
                      F.col("geolocation_lat").try_cast("double").alias("lat"),
                      F.col("geolocation_lng").try_cast("double").alias("lng"))


def dedup_geolocation(geo: DataFrame) -> DataFrame:
    """B8 (second half): one point per zip code.

    The source keeps an arbitrary row; we keep the smallest (lat, lng) with NULLs
    last.  Expressed as a min over a struct so it is a partial (map-side)
    aggregate: a zip code holding a third of all points is still combined
    before the shuffle instead of being sorted in one task.
    """
    key = F.struct(F.col("lat").isNull().alias("lat_null"), F.col("lat").alias("lat"),
                   F.col("lng").isNull().alias("lng_null"), F.col("lng").alias("lng"))
    return (geo.groupBy("zip_code").agg(F.min(key).alias("p"))
               .select("zip_code", F.col("p.lat").alias("lat"), F.col("p.lng").alias("lng")))


STAGE = {
    "sellers": lambda raw: clean_sellers(raw.sellers),
    "products": lambda raw: clean_products(raw.products),
    "category_translation": lambda raw: clean_category_translation(raw.category_translation),
    "orders": lambda raw: clean_orders(raw.orders),
    "order_items": lambda raw: clean_order_items(raw.order_items, clean_orders(raw.orders)),
    "order_payments": lambda raw: clean_order_payments(raw.order_payments),
    "customers": lambda raw: clean_customers(raw.customers),
    "geolocation": lambda raw: clean_geolocation(raw.geolocation),
}


def stage_all(raw: RawMarketplace) -> LazyTables:
    """The staged tables, each planned when it is first read."""
    return LazyTables({name: (lambda stage=stage: stage(raw)) for name, stage in STAGE.items()})


STAGED_SCHEMAS = {
    "sellers": [("seller_id", "KEY"), ("seller_zip_code", "VARCHAR"), ("seller_city", "VARCHAR"),
                ("seller_state", "VARCHAR")],
    "products": [("product_id", "KEY"), ("product_category_name", "VARCHAR")] + [(c, "BIGINT") for c in PRODUCT_SIZES],
    "category_translation": [("product_category_name", "VARCHAR"), ("product_category_name_english", "VARCHAR")],
    "orders": [("order_id", "KEY"), ("customer_id", "KEY"), ("order_status", "VARCHAR")] + [
        (c, "TIMESTAMP") for c in ORDER_TIMES],
    "order_items": [("order_id", "KEY"), ("order_item_id", "KEY"), ("product_id", "KEY"), ("seller_id", "KEY"),
                    ("price", "DOUBLE"), ("freight_value", "DOUBLE")],
    "order_payments": [("order_id", "KEY"), ("payment_sequential", "VARCHAR"), ("payment_type", "VARCHAR"),
                       ("payment_installments", "BIGINT"), ("payment_value", "DOUBLE")],
    "customers": [("customer_id", "KEY"), ("customer_unique_id", "KEY"), ("customer_zip_code_prefix", "VARCHAR"),
                  ("customer_city", "VARCHAR"), ("customer_state", "VARCHAR")],
}
ROW_COUNTS_SCHEMA = [("table_name", "VARCHAR"), ("row_count", "BIGINT")]


def staging_row_counts(m: Marketplace) -> DataFrame:
    """Row count of every staged table, as one DataFrame of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in m.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
