"""Plan-shape guards: filters reach the parquet scan, unused columns are pruned."""

import tempfile

from tradewind.operators import quality, seller
from tradewind.plans.pipeline import read_staging, write_staging
from tradewind.sources.testdata import load_raw_testdata


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_status_filter_pushed_and_item_columns_pruned(spark):
    root = tempfile.mkdtemp(prefix="tradewind-plan-")
    write_staging(spark, load_raw_testdata(spark, "/root/testdata/sf0.001"), root)
    m = read_staging(spark)
    plan = _plan(seller.daily_seller_revenue(m))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "order_status" in line]
    assert pushed and "Not(In(order_status, [canceled,unavailable]))" in pushed[0]
    items_scan = [line for line in plan.splitlines() if "order_items" in line and "ReadSchema" in line]
    assert items_scan and all("order_item_id" not in line for line in items_scan)
    assert quality.schema_exists(spark, "staging")
