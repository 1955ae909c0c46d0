"""One stored rollup for the overview measures; staged orders by month, pruned by the trailing window."""

import datetime as dt
import os
import tempfile

from tests.builders import item, market, order
from tests.conftest import SF
from tradewind.operators import measures, seller, star
from tradewind.plans.pipeline import read_staging, write_staging
from tradewind.session import intermediates, materialize
from tradewind.sources.testdata import load_raw_testdata, load_testdata


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_rollup_measures_equal_those_of_the_fact(spark):
    m = load_testdata(spark, SF)
    fact, dates = star.fact_orders(m), star.dim_date(m)
    daily = measures.daily_revenue(fact, dates)
    plain = {"kpi_yoy": measures.kpi_yoy(fact), "revenue_moving_avg": measures.revenue_moving_avg(daily),
             "peak_day": measures.peak_day(daily), "revenue_by_weekday": measures.revenue_by_weekday(daily),
             "state_month_matrix": measures.state_month_matrix(fact, m.customers),
             "revenue_by_state": measures.revenue_by_state(fact, m.sellers),
             "revenue_by_category": measures.revenue_by_category(fact, star.dim_product(m))}
    rolled = measures.market_overview(m)
    assert set(plain) == set(rolled) == set(measures.FROM_ROLLUP)
    for name, df in plain.items():
        assert _rows(rolled[name]) == _rows(df), name


def test_overview_reads_the_fact_once(spark):
    m = load_testdata(spark, SF)
    with intermediates(spark) as written:
        overview = measures.market_overview(m)
        stored = [p for p in written if "sales-rollup" in p]
        assert len(stored) == 1
        for name, df in overview.items():
            scans = [line for line in _plan(df).splitlines() if "Scan parquet" in line and "fact-orders" in line]
            assert not scans, name
            assert any("grain" in line for line in _plan(df).splitlines() if "PartitionFilters" in line), name


def test_rollup_moves_nothing_for_payments_and_items_not_for_sellers(spark, monkeypatch):
    written = []
    monkeypatch.setattr(star, "materialize", lambda df, label: written.append(label) or materialize(df, label))

    def noted(df, label, **kw):
        written.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return materialize(df, label, **kw)
    monkeypatch.setattr(measures, "materialize", noted)
    m = load_testdata(spark, SF)
    measures.sales_rollup(m)
    (_, _), (label, plan) = written                              # sellers, rollup: orders with payments are not written
    assert label == "sales-rollup" and "l_returnflag" not in plan and "l_linenumber" not in plan
    assert "hashpartitioning(seller_id" not in plan
    narrow = star.fact_orders(m, measures.FACT_COLUMNS)
    assert len(written) == 2 and set(narrow.columns) == set(measures.FACT_COLUMNS)
    assert _rows(narrow.select(*measures.FACT_COLUMNS)) == _rows(star.fact_orders(m).select(*measures.FACT_COLUMNS))
    paid = [*measures.FACT_COLUMNS, "total_payment_value"]
    assert _rows(star.fact_orders(m, paid).select(*paid)) == _rows(star.fact_orders(m).select(*paid)) and written[2:] == ["fact-orders"] * 3


def test_rollup_moves_orders_not_items_by_customer(spark, monkeypatch):
    plans = []

    def noted(df, label, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString().splitlines())
        return materialize(df, label, **kw)
    monkeypatch.setattr(measures, "materialize", noted)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    orders = [order(i, i % 3 or None, "delivered", "2024-01-01 10:00:00") for i in range(1, 7)]
    items = [item(i, n, n, 1, 10 * i) for i in range(1, 7) for n in (1, 2)]
    m = market(spark, orders=orders, order_items=items, customers=[(1, 1, "00001", "C", "SP"), (2, 2, "00001", "C", "RJ")])
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        r = measures.sales_rollup(m)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    _, plan = plans
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    moved = []
    for i, line in enumerate(plan):
        if "Exchange hashpartitioning(customer_id" in line:
            end = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
            moved.append("\n".join(plan[i:end]))
    assert len(moved) == 2 and not any("price" in x for x in moved)        # orders and customers
    state = {1: "SP", 2: "RJ", 0: None}
    want = {s: (sum(20.0 * i for i in range(1, 7) if state[i % 3] == s), 4) for s in state.values()}
    got = {}
    for c in r.cells.collect():
        g, n = got.get(c.customer_state, (0.0, 0))
        got[c.customer_state] = (g + float(c.revenue), n + c.items_sold)
    assert got == want
    assert {(o.order_id, float(o.revenue), o.items_sold) for o in r.orders.collect()} == {(i, 20.0 * i, 2) for i in range(1, 7)}


def test_rollup_with_unknown_dimensions_unknown_money_and_no_rows(spark):
    orders = [order(1, 1, "delivered", "2024-01-01 10:00:00"), order(2, 7, "delivered", "2024-01-01 11:00:00")]
    items = [item(1, 1, 1, 1, 10), item(1, 2, 99, 1, 5), item(2, 1, 1, 98, 7), (2, 2, 1, 98, None, None)]
    m = market(spark, orders=orders, order_items=items, customers=[(1, 1, "00001", "C", "SP")],
               sellers=[(1, "00001", "C", "RJ")])
    r = measures.sales_rollup(m)
    cells = {(c.customer_state, c.seller_state, c.category_name_en): (c.revenue, c.items_sold) for c in r.cells.collect()}
    known = next(k[2] for k in cells if k[2] is not None)
    assert {k: (float(v[0]), v[1]) for k, v in cells.items()} == {
        ("SP", "RJ", known): (10.0, 1), ("SP", "RJ", None): (5.0, 1), (None, None, known): (7.0, 2)}
    assert {(o.order_id, float(o.revenue), o.items_sold) for o in r.orders.collect()} == {(1, 15.0, 2), (2, 7.0, 2)}
    empty = measures.market_overview(market(spark))
    assert {name: df.count() for name, df in empty.items() if name not in ("peak_day", "state_month_matrix")} == {
        "kpi_yoy": 0, "revenue_moving_avg": 0, "revenue_by_weekday": 0, "revenue_by_state": 0, "revenue_by_category": 0}


def test_trailing_window_prunes_the_months_of_staged_orders(spark):
    root = tempfile.mkdtemp(prefix="tradewind-months-")
    run = write_staging(spark, load_raw_testdata(spark, SF), root)
    m = read_staging(spark, run.database)
    months = [d for d in os.listdir(f"{root}/staging/{run.database}/orders") if d.startswith("purchase_month=")]
    assert len(months) > 12
    recent = seller.trailing_of(m)
    want = _rows(seller.trailing_90d(seller.daily_seller_revenue(m)))
    assert _rows(recent) == want and want
    scans = [line for line in _plan(recent).splitlines() if "PartitionFilters" in line and "purchase_month" in line]
    assert any("Subquery" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in scans)
    read = _partitions_read(recent)
    assert read and min(read) <= 5 < len(months)                 # 90 days touch at most five months


def _partitions_read(df) -> list[int]:
    """Per scan that prunes by month at run time: the partitions that it read."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "FileSourceScanExec" and "purchase_month" in p.toString():
            parts = p.metrics().get("numPartitions")
            if parts.isDefined():
                found.append(parts.get().value())
        if name.endswith("QueryStageExec"):
            todo.append(p.plan())
        children = p.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return found


def test_trailing_window_ends_with_the_last_sale_not_the_last_order(spark):
    orders = [order(1, 1, "delivered", "2024-03-01 10:00:00"), order(2, 1, "delivered", "2024-05-01 10:00:00"),
              order(3, 1, "canceled", "2024-08-01 10:00:00"), order(4, 1, "delivered", "2024-09-01 10:00:00"),
              order(5, 1, "delivered", "2024-10-01 10:00:00")]
    # Order 4 has no item; the item of order 5 has an unknown product.
    m = market(spark, orders=orders, order_items=[item(1, 1, 1, 1, 10), item(2, 1, 1, 1, 20), item(3, 1, 1, 1, 30),
                                                  item(5, 1, 99, 1, 40)])
    got = [(r.order_date, float(r.gross_revenue), r.max_date) for r in seller.trailing_of(m).collect()]
    assert got == [(dt.date(2024, 3, 1), 10.0, dt.date(2024, 5, 1))]
    assert _rows(seller.trailing_of(m)) == _rows(seller.trailing_90d(seller.daily_seller_revenue(m)))
    assert seller.trailing_of(market(spark)).count() == 0
