"""Order lines of the test-data adapters: numbered only where the number is read, tasks sized by rows, hot orders spread."""

import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F

from tradewind.operators import churn, star
from tradewind.sources import testdata

DAY = datetime.datetime(1996, 1, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """200 orders of 3 lines, one of 400, 50 lines without an order key, linenumbers that repeat."""
    rng = random.Random(3)
    keys = [k for k in range(1, 201) for _ in range(3)] + [500] * 400 + [None] * 50
    rng.shuffle(keys)
    lines = [(k, rng.randrange(9), rng.randrange(5), rng.randrange(1, 4), float(i) + 0.25, DAY, 0.05, "ANR"[i % 3], 7.0)
             for i, k in enumerate(keys)]
    d = str(tmp_path_factory.mktemp("lines"))

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    put("lineitem", lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double,"
                           " l_shipdate timestamp_ntz, l_tax double, l_returnflag string, l_quantity double")
    put("orders", [(k, k % 7, "F", DAY + datetime.timedelta(days=k)) for k in [*range(1, 201), 500]],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz")
    put("supplier", [(k, 0) for k in range(5)], "s_suppkey bigint, s_nationkey int")
    put("nation", [(0, "PERU", 0)], "n_nationkey int, n_name string, n_regionkey int")
    put("region", [(0, "AMERICA")], "r_regionkey int, r_name string")
    return d, lines


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("per_task, hot", [(300_000, []), (300, [500]), (40, [500, None])])
def test_numbers_of_lines_with_and_without_hot_orders(spark, folder, monkeypatch, per_task, hot):
    d, lines = folder
    monkeypatch.setattr(testdata, "LINES_PER_TASK", per_task)
    t = testdata.ParquetTables(spark, d)
    assert testdata.hot_orders(t["lineitem"]) == (len(lines), hot)
    want = collections.Counter()
    by = collections.defaultdict(list)
    for k, part, supplier, number, price, *_ in lines:
        by[k].append((number, part, supplier, price))
    for k, rows in by.items():
        want.update((k, i, *r[1:]) for i, r in enumerate(sorted(rows), 1))
    got = testdata.typed_order_items(t).select("order_id", "order_item_id", "product_id", "seller_id", F.col("price").cast("double"))
    assert collections.Counter(map(tuple, got.collect())) == want
    paid = collections.defaultdict(float)
    for k, _, _, number, price, *_ in lines:
        paid[k, str(number)] += price
    rows = testdata.typed_order_payments(t).collect()
    assert {(r.order_id, r.payment_sequential): float(r.payment_value) for r in rows} == paid and len(rows) == len(paid)


def test_seller_months_leave_out_the_numbering(spark, folder):
    m = testdata.load_testdata(spark, folder[0])
    assert "Window" in _plan(m.order_items) and "tradewind-positions" not in "".join(m.order_items.inputFiles())
    fold = churn.seller_fold(churn.seller_history_of(m))
    assert "Window" not in _plan(fold) and "tradewind-positions" not in "".join(fold.inputFiles())
    assert churn.seller_monthly(m).agg(F.sum("orders")).first()[0] > 0
    fact = star.fact_orders(m)
    assert "Window" in _plan(fact) and "Window" not in _plan(fact.drop("order_item_id"))


def test_tasks_hold_a_bounded_number_of_lines(spark, folder, monkeypatch):
    d, lines = folder
    monkeypatch.setattr(testdata, "LINES_PER_TASK", 405)
    t = testdata.ParquetTables(spark, d)
    assert testdata.hot_orders(t["lineitem"])[1] == []
    assert testdata.typed_order_items(t).rdd.getNumPartitions() == len(lines) // 405 + 1


def test_no_lines(spark, folder, tmp_path):
    spark.read.parquet(f"{folder[0]}/lineitem.parquet").limit(0).write.parquet(str(tmp_path / "lineitem.parquet"))
    t = testdata.ParquetTables(spark, str(tmp_path))
    assert testdata.hot_orders(t["lineitem"]) == (0, []) and testdata.typed_order_items(t).count() == 0
