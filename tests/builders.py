"""Hand-made marketplace tables for micro-fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from tradewind.sources.tables import Marketplace

TS = T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)

SCHEMAS = {
    "sellers": T.StructType([T.StructField("seller_id", T.LongType()), T.StructField("seller_zip_code", T.StringType()),
                             T.StructField("seller_city", T.StringType()), T.StructField("seller_state", T.StringType())]),
    "products": T.StructType([T.StructField("product_id", T.LongType()),
                              T.StructField("product_category_name", T.StringType())] +
                             [T.StructField(c, T.IntegerType()) for c in
                              ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
                               "product_photos_qty")]),
    "category_translation": T.StructType([T.StructField("product_category_name", T.StringType()),
                                          T.StructField("product_category_name_english", T.StringType())]),
    "orders": T.StructType([T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
                            T.StructField("order_status", T.StringType())] +
                           [T.StructField(c, TS) for c in
                            ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                             "order_delivered_customer_date", "order_estimated_delivery_date")]),
    "order_items": T.StructType([T.StructField("order_id", T.LongType()), T.StructField("order_item_id", T.LongType()),
                                 T.StructField("product_id", T.LongType()), T.StructField("seller_id", T.LongType()),
                                 T.StructField("price", MONEY), T.StructField("freight_value", MONEY)]),
    "order_payments": T.StructType([T.StructField("order_id", T.LongType()),
                                    T.StructField("payment_sequential", T.StringType()),
                                    T.StructField("payment_type", T.StringType()),
                                    T.StructField("payment_installments", T.IntegerType()),
                                    T.StructField("payment_value", MONEY)]),
    "customers": T.StructType([T.StructField("customer_id", T.LongType()),
                               T.StructField("customer_unique_id", T.LongType()),
                               T.StructField("customer_zip_code_prefix", T.StringType()),
                               T.StructField("customer_city", T.StringType()),
                               T.StructField("customer_state", T.StringType())]),
    "geolocation": T.StructType([T.StructField("zip_code", T.StringType()), T.StructField("lat", T.DoubleType()),
                                 T.StructField("lng", T.DoubleType())]),
}


def d(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def order(order_id, customer_id, status, purchase, delivered=None, estimated=None, approved=None):
    return (order_id, customer_id, status, d(purchase), d(approved) if approved else None, None,
            d(delivered) if delivered else None, d(estimated) if estimated else None)


def item(order_id, n, product_id, seller_id, price, freight=0):
    return (order_id, n, product_id, seller_id, money(price), money(freight))


def market(spark, **rows) -> Marketplace:
    """Marketplace from row lists; missing tables are empty (products default to
    ids 1..9 in category 'cat')."""
    defaults = {
        "sellers": [(i, "00001", "City", "SP") for i in range(1, 10)],
        "products": [(i, "cat", 1, 1, 1, 1, 1) for i in range(1, 10)],
    }
    tables = {}
    for name, schema in SCHEMAS.items():
        data = rows.get(name, defaults.get(name, []))
        tables[name] = spark.createDataFrame(data, schema)
    return Marketplace(**tables)
