"""The test-data adapter's distributed line numbering equals the plain window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewind.sources.testdata import ParquetTables, typed_order_items


def _window_numbers(li):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                                                 "l_shipdate")
    return li.select(F.col("l_orderkey").alias("order_id"), F.row_number().over(w).alias("order_item_id"),
                     F.col("l_partkey").alias("product_id"))


def test_line_numbers_match_window_on_test_data(spark):
    t = ParquetTables(spark, "/root/testdata/sf0.01")
    got = typed_order_items(t).select("order_id", "order_item_id", "product_id")
    ref = _window_numbers(t["lineitem"])
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_line_numbers_with_one_hot_order(spark):
    rows = [(1, i % 5, i, i % 7, float(i % 11), None) for i in range(3000)] + \
           [(k, 1, k, 1, 1.0, None) for k in range(2, 200)]
    li = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, "
                                     "l_extendedprice double, l_shipdate timestamp_ntz").withColumn("l_tax", F.lit(0.01))
    got = typed_order_items({"lineitem": li}).select("order_id", "order_item_id", "product_id")
    ref = _window_numbers(li)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
