"""Adapters from the TPC-H-like test parquet to the marketplace inputs.

The same mappings are written as SQL views for the oracle (``tradewind.oracle``);
both sides must agree row for row, so any change here is mirrored there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.operators import staging
from tradewind.operators.ranking import POS, RANK, global_positions
from tradewind.sources.tables import LazyTables

class ParquetTables(dict):
    """The Parquet tables of a folder by name, each opened (its footer read) when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._folder = spark, sf_dir.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self[name]


def _minutes(n) -> F.Column:
    return F.make_dt_interval(mins=n.cast("int"))


def _text(col) -> F.Column:
    return col.cast("string")


def raw_sellers(t) -> DataFrame:
    s, n, r = t["supplier"], t["nation"], t["region"]
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)      # nation/region: 25 / 5 rows
             .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
             .select(F.col("s_suppkey").alias("seller_id"),
                     _text(F.col("s_suppkey") % 97).alias("seller_zip_code_prefix"),
                     F.concat(F.lit("  "), F.lower("n_name"), F.lit(" d'oeste ")).alias("seller_city"),
                     F.concat(F.lit(" "), F.lower(F.substring("r_name", 1, 2))).alias("seller_state")))


def raw_products(t) -> DataFrame:
    p = t["part"]
    key = F.lower(F.concat("p_type", F.lit("_"), F.replace("p_brand", F.lit("#"), F.lit("_"))))
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_size") == 13, F.lit(None).cast("string")).otherwise(key).alias("product_category_name"),
        F.when(F.col("p_size") % 10 == 0, F.lit("n/a")).otherwise(_text(F.col("p_size"))).alias("product_weight_g"),
        _text(F.col("p_size")).alias("product_length_cm"),
        _text(F.col("p_retailprice") / 100).alias("product_height_cm"),
        F.when(F.col("p_size") % 7 == 0, F.lit("")).otherwise(_text(F.col("p_size") * 2)).alias("product_width_cm"),
        _text(F.col("p_partkey") % 6).alias("product_photos_qty"))


def raw_category_translation(t) -> DataFrame:
    p = t["part"].filter(F.col("p_type") != "PROMO")
    brand = F.replace("p_brand", F.lit("#"), F.lit("_"))
    return p.select(
        F.lower(F.concat("p_type", F.lit("_"), brand)).alias("product_category_name"),
        F.lower(F.concat(F.lit("en_"), "p_type", F.lit("_"), brand)).alias("product_category_name_english"),
    ).distinct()


def raw_customers(t) -> DataFrame:
    c, n = t["customer"], t["nation"]
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
             .select(F.col("c_custkey").alias("customer_id"),
                     (F.col("c_custkey") - F.col("c_custkey") % 2).alias("customer_unique_id"),
                     F.lpad(_text(F.col("c_custkey") % 97), 5, "0").alias("customer_zip_code_prefix"),
                     F.concat(F.lit(" "), F.lower("n_name")).alias("customer_city"),
                     F.concat(F.lower(F.substring("n_name", 1, 2)), _text(F.col("n_nationkey")), F.lit(" "))
                      .alias("customer_state")))


def typed_orders(t) -> DataFrame:
    o = t["orders"]
    k = F.col("o_orderkey")
    base = k * 37 % 1440
    status = (F.when(k % 37 == 0, "canceled").when(k % 61 == 0, "unavailable")
               .when(F.col("o_orderstatus") == "F", "delivered")
               .when(F.col("o_orderstatus") == "O", "shipped").otherwise("processing"))
    return o.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        (F.col("o_orderdate") + _minutes(base)).alias("order_purchase_timestamp"),
        F.when(k % 53 != 0, F.col("o_orderdate") + _minutes(base + k * 13 % 3000)).alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + _minutes(base + k * 101 % 50000))
         .alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(20))).alias("order_estimated_delivery_date"))


#: Lines of a task that sorts and joins whole orders.  Sized in rows, not by AQE: it goes by compressed bytes, and
#: gives a task more rows the larger the table is.
LINES_PER_TASK = 300_000
#: An order with more lines than that and more than this share of all lines is hot: its lines are not for one task.
HOT_SHARE = 1 / 1000
#: Keys that the sketch of frequent orders follows: its counts are off by at most 3.5 / 16384 of all lines.
TRACKED = 10_000


def hot_orders(lines: DataFrame) -> tuple[int, list]:
    """The number of lines, and the keys of the hot orders (NULL may be one; some may hold slightly fewer lines): one
    pass over the key column into a sketch of bounded size, which brings back at most ``1 / HOT_SHARE`` keys."""
    k = F.col("l_orderkey")
    top = F.expr(f"approx_top_k(l_orderkey, {round(1 / HOT_SHARE)}, {TRACKED})").alias("top")
    n, nulls, found = lines.agg(F.count(F.lit(1)), F.count_if(k.isNull()), top).first()
    many = max(n * HOT_SHARE, LINES_PER_TASK)
    often = [r["item"] for r in found or [] if r["item"] is not None and r["count"] > many]
    return n, often + ([None] if nulls > many else [])


def _by_order(lines: DataFrame, n: int) -> DataFrame:
    """Lines with each order in one task, some ``LINES_PER_TASK`` in each: for tables without a hot order."""
    return lines.repartition(n // LINES_PER_TASK + 1, "l_orderkey")


def typed_order_items(t) -> DataFrame:
    """Items with ``order_item_id`` = ROW_NUMBER() OVER (PARTITION BY order ORDER BY line,
    part, supplier, price, ship date) — (l_orderkey, l_linenumber) repeats in the test data.

    A window per order, which Spark leaves out of plans that do not read the number; joins and sums by order use
    the same exchange.  The lines of an order that holds a large share of all lines do not go to one window task: they
    are numbered by many, as global position minus the order's first position plus one, in the global (order, line, ...) ordering.
    """
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_tax")
    place = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*place)).cast("bigint")
    n, hot = hot_orders(li)
    if not hot:
        return _typed_items(_by_order(li, n).withColumn("order_item_id", number))
    k = F.col("l_orderkey")
    is_hot = F.when(k.isNull(), F.lit(None in hot)).otherwise(k.isin([x for x in hot if x is not None]))
    lines = li.filter(is_hot).select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax",
                                     F.struct(*place).alias("_line"))
    pos = global_positions(lines, "l_orderkey", "_line", descending=False, keep_tie=False)
    return _typed_items(li.filter(~is_hot).withColumn("order_item_id", number)) \
        .unionByName(_typed_items(pos.withColumn("order_item_id", F.col(POS) - F.col(RANK) + 1)))


def _typed_items(lines: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        "order_item_id",
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(18,2)").alias("freight_value"))


def zero_month_items(t, items: DataFrame) -> DataFrame:
    """Items with some seller-months zeroed out, to exercise the zero-month streak."""
    o = t["orders"].select("o_orderkey", "o_orderdate")
    zero = (F.col("seller_id") * 31 + F.year("o_orderdate") * 12 + F.month("o_orderdate")) % 9 < 2
    dz = F.lit(0).cast("decimal(18,2)")
    return (items.join(o, items.order_id == o.o_orderkey)
                 .select("order_id", "order_item_id", "product_id", "seller_id",
                         F.when(zero, dz).otherwise(F.col("price")).alias("price"),
                         F.when(zero, dz).otherwise(F.col("freight_value")).alias("freight_value")))


def odd_money_items(items: DataFrame) -> DataFrame:
    """Items with digits below a cent, unknown freight on some lines and on all lines of some sellers."""
    cut = F.lit("0.0001").cast("decimal(28,6)")
    unknown = (F.col("seller_id") % 7 == 0) | (F.col("order_id") % 11 == 0)
    return items.select(
        "order_id", "order_item_id", "product_id", "seller_id",
        (F.col("price") + F.col("product_id") % 100 * cut).cast("decimal(28,6)").alias("price"),
        F.when(~unknown, F.col("freight_value") + F.col("order_id") % 50 * cut).cast("decimal(28,6)").alias("freight_value"))


def typed_order_payments(t) -> DataFrame:
    li = t["lineitem"]
    return (li.groupBy("l_orderkey", "l_linenumber")
              .agg(F.min("l_returnflag").alias("payment_type"),
                   F.min("l_quantity").cast("int").alias("payment_installments"),
                   F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("payment_value"))
              .select(F.col("l_orderkey").alias("order_id"),
                      _text(F.col("l_linenumber")).alias("payment_sequential"),
                      "payment_type", "payment_installments", "payment_value"))


def raw_geolocation(t) -> DataFrame:
    c = t["customer"]
    return c.select(F.lpad(_text(F.col("c_custkey") % 89), 5, "0").alias("geolocation_zip_code_prefix"),
                    _text(F.col("c_acctbal") / 100).alias("geolocation_lat"),
                    _text(-F.col("c_custkey")).alias("geolocation_lng"))


RAW = {"sellers": raw_sellers, "products": raw_products, "category_translation": raw_category_translation,
       "orders": typed_orders, "order_items": typed_order_items, "order_payments": typed_order_payments,
       "customers": raw_customers, "geolocation": raw_geolocation}


def load_raw_testdata(spark: SparkSession, sf_dir: str, tables: ParquetTables | None = None) -> LazyTables:
    """Raw inputs over the test parquet; numbering the order lines runs only if items are read."""
    t = ParquetTables(spark, sf_dir) if tables is None else tables
    return LazyTables({name: (lambda build=build: build(t)) for name, build in RAW.items()})


def load_testdata(spark: SparkSession, sf_dir: str, zero_months: bool = False, odd_money: bool = False) -> LazyTables:
    """Staged marketplace over the test parquet, each table planned when it is first read."""
    t = ParquetTables(spark, sf_dir)
    staged = staging.stage_all(load_raw_testdata(spark, sf_dir, t))
    if zero_months:
        return LazyTables({n: (lambda n=n: getattr(staged, n)) for n in RAW}
                          | {"order_items": lambda: zero_month_items(t, staged.order_items)})
    if odd_money:
        return LazyTables({n: (lambda n=n: getattr(staged, n)) for n in RAW}
                          | {"order_items": lambda: odd_money_items(staged.order_items)})
    return staged
