"""Raw CSV readers with explicit schemas (A1-A3): no inference pass over the data.

Every column is read as text; staging casts leniently afterwards, so a bad
value becomes NULL instead of failing the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.sources.tables import RawMarketplace

# Fixed values of the source dataset: file names and the columns the pipeline reads.
FILES = {
    "sellers": ("olist_sellers_dataset.csv",
                ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]),
    "products": ("olist_products_dataset.csv",
                 ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                  "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                  "product_width_cm"]),
    "category_translation": ("product_category_name_translation.csv",
                             ["product_category_name", "product_category_name_english"]),
    "orders": ("olist_orders_dataset.csv",
               ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
                "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]),
    "order_items": ("olist_order_items_dataset.csv",
                    ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
                     "freight_value"]),
    "order_payments": ("olist_order_payments_dataset.csv",
                       ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]),
    "customers": ("olist_customers_dataset.csv",
                  ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                   "customer_state"]),
    "geolocation": ("olist_geolocation_dataset.csv",
                    ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
                     "geolocation_state"]),
}


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


BROKEN = "_broken_row"


def _options(multiline: bool) -> dict[str, str]:
    # A quote inside a quoted field is doubled.  Without column pruning every row is parsed whole, so that
    # a row with too few or too many fields is seen whatever columns a query reads.
    return {"header": "true", "quote": '"', "escape": '"', "multiLine": str(multiline).lower(), "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": BROKEN, "columnPruning": "false"}


def _header(spark: SparkSession, path: str, columns: list[str]) -> tuple[list[str], dict[str, str]]:
    """The columns of the header line, and which of them has each wanted name."""
    found = spark.read.options(**_options(False)).csv(path).columns          # reads the header line only
    by_name = {c.strip().lstrip("\ufeff"): c for c in found}
    missing = [c for c in columns if c not in by_name]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; its header has {found}")
    return found, by_name


def read_csv(spark: SparkSession, path: str, columns: list[str], multiline: bool = False) -> DataFrame:
    """Header CSV read as text; columns are found by their names in the header, in any
    order and among others, and leading zeros in codes are kept.

    A quoted line break is read right with ``multiline``; a file is then read by one task, so it
    is off for large files without such fields.  Without it, a row that such a break has cut in two, or any
    other row with too few or too many fields, stops the job: no row is split
    or filled up silently.  (A file of one column is always read with ``multiline``: its rows can't show a cut.)
    A missing column, or files whose headers differ, raise.  ``read_csv_checked`` sets broken rows aside instead.
    """
    rows, by_name = _rows(spark, path, columns, multiline)
    first = F.coalesce(F.col(f"`{by_name[columns[0]]}`"), F.lit(""))
    said = F.concat(F.lit(f"{path}: a row has too few or too many fields, or a line break in quotes (multiline=True reads those): "),
                    F.col(BROKEN), F.lit(" ["), first, F.lit("]"))
    whole = rows.filter(F.when(F.col(BROKEN).isNull(), F.lit(True)).otherwise(F.raise_error(said).cast("boolean")))
    return whole.select(*[F.col(f"`{by_name[c]}`").alias(c) for c in columns])


def _rows(spark: SparkSession, path: str, columns: list[str], multiline: bool) -> tuple[DataFrame, dict[str, str]]:
    found, by_name = _header(spark, path, columns)
    schema = text_schema([*found, BROKEN])
    rows = spark.read.options(**_options(multiline or len(found) == 1)).option("enforceSchema", False).schema(schema).csv(path)
    return rows, by_name


def read_csv_checked(spark: SparkSession, path: str, columns: list[str], types: dict[str, str] | str | None = None,
                     sample_ratio: float = 0.1, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and a table ``row`` of the broken ones as they stand in the file (A1, A2).

    ``types`` maps columns to SQL types, other columns being text; ``"infer"`` takes the types
    that Spark infers from ``sample_ratio`` of the rows; None reads text.  Broken are rows with too
    few or too many fields and rows with a value that its type does not take.  The
    second table counts and shows them: ``rejected.count()`` before ``rows`` is used is the quarantine check.
    """
    found, by_name = _header(spark, path, columns)
    options = _options(multiline or len(found) == 1)
    if types == "infer":
        seen = spark.read.options(**options).options(inferSchema="true", samplingRatio=str(sample_ratio)).csv(path).schema
        of = {f.name: f.dataType for f in seen.fields}
    else:
        given = {by_name[c]: t for c, t in (types or {}).items()}
        of = {c: T.DataType.fromDDL(given.get(c, "string")) for c in found}
    schema = T.StructType([*[T.StructField(c, of[c]) for c in found], T.StructField(BROKEN, T.StringType())])
    rows = spark.read.options(**options).option("enforceSchema", False).schema(schema).csv(path)
    # The conditions name every column, since Spark tries the types of the columns that a query reads alone.
    size = F.length(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in found]))
    whole = rows.filter(F.when(F.col(BROKEN).isNull(), size >= 0).otherwise(size < 0))
    broken = rows.filter(F.when(F.col(BROKEN).isNull(), size < 0).otherwise(size >= 0))
    return whole.select(*[F.col(f"`{by_name[c]}`").alias(c) for c in columns]), broken.select(F.col(BROKEN).alias("row"))


def read_raw_marketplace(spark: SparkSession, data_dir: str, multiline: bool = False) -> RawMarketplace:
    base = data_dir.rstrip("/")
    return RawMarketplace(**{name: read_csv(spark, f"{base}/{fname}", cols, multiline)
                             for name, (fname, cols) in FILES.items()})
