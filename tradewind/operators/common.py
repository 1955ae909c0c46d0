"""Building blocks shared by the marts and the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the source pipeline: statuses that do not count as a sale.
EXCLUDED_STATUSES = ("canceled", "unavailable")
UNCATEGORIZED = "uncategorized"


def is_valid_status(col: str = "order_status") -> Column:
    """NOT IN (...) — a NULL status is dropped, as in SQL."""
    return ~F.col(col).isin(*EXCLUDED_STATUSES)


def valid_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(is_valid_status())


def item_revenue() -> Column:
    """Price + freight, exact (DECIMAL)."""
    return F.col("price") + F.col("freight_value")


def with_category(items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """Attach the category key to item rows: English name, else Portuguese, else
    'uncategorized' (D2 inner join to products, D3 left join to the translation, I5).

    Items meet each dimension table directly, so each join is planned from that
    table's own measured size (broadcast while it is under Spark's threshold,
    shuffled beyond it); a products-translation pre-join would multiply the two
    size estimates and force a shuffle of the item stream.
    """
    return (items.join(products.select("product_id", "product_category_name"), "product_id")
                 .join(translation, "product_category_name", "left")
                 .withColumn("category", F.coalesce("product_category_name_english", "product_category_name",
                                                    F.lit(UNCATEGORIZED)))
                 .drop("product_category_name", "product_category_name_english"))


def mode_of(value: str, weight: str) -> Column:
    """Aggregate picking the most frequent ``value`` given per-value counts in
    ``weight``; ties go to the smallest value (deterministic MODE)."""
    return F.min_by(F.col(value), F.struct((-F.col(weight)).alias("w"), F.col(value).alias("v")))


def conform(df: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    """Project and cast to a declared output schema (``KEY`` keeps the input type)."""
    spark_types = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
                   "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "INTEGER": "int"}
    return df.select(*[F.col(c) if t == "KEY" else F.col(c).cast(spark_types[t]).alias(c) for c, t in schema])


def scalar(df: DataFrame, agg: Column) -> Column:
    """A global aggregate used as a scalar subquery (H4 / D9): planned once as a
    partial + final aggregate, no join and no row on the driver."""
    return df.select(agg).scalar()
