"""Data-quality gate — SURVEY §2.L.

The checks are one DataFrame of rows ``(check_name, value, rule, passed)``
built from global aggregates (each a partial aggregate; no row reaches the
driver).  ``enforce_gate`` is the only action: it fetches the failing rows
(at most one per check) and raises.

Where the staged tables have just been written, L1-L4 come from metrics observed
in the write jobs (``write_metrics``, ``measured_report``), and only L5 reads tables again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.sources.tables import Marketplace

# Minimum staged row counts (fixed values of the source pipeline; overridable).
MIN_ROWS = {"sellers": 100, "products": 500, "orders": 1000, "order_items": 1000, "order_payments": 1000}


DQ_SCHEMA = [("check_name", "VARCHAR"), ("value", "BIGINT"), ("rule", "VARCHAR"), ("passed", "BOOLEAN")]


class QualityGateError(RuntimeError):
    pass


def _checks(df: DataFrame, checks: list[tuple[str, F.Column, str, object]]) -> DataFrame:
    """Several checks on one table from a single aggregate (one scan), one row each."""
    agg = df.agg(*[value.cast("bigint").alias(f"v{i}") for i, (_, value, _, _) in enumerate(checks)])
    rows = [F.struct(F.lit(name).alias("check_name"), F.col(f"v{i}").alias("value"), F.lit(rule).alias("rule"),
                     passed(F.col(f"v{i}")).alias("passed"))
            for i, (name, _, rule, passed) in enumerate(checks)]
    return agg.select(F.inline(F.array(*rows)))


def min_rows_check(table: str, minimum: int):
    """L2: staged table has at least ``minimum`` rows."""
    return (f"rows:{table}", F.count(F.lit(1)), f">= {minimum}", lambda v: v >= minimum)


def zero_check(name: str, condition: F.Column):
    """L3/L4: no row satisfies ``condition``."""
    return (name, F.count_if(condition), "= 0", lambda v: v == 0)


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items whose order is missing (anti join)."""
    return items.join(orders.select("order_id"), "order_id", "left_anti")


def _value_checks() -> dict[str, list[tuple[str, F.Column]]]:
    """L3/L4: conditions that no row of a table may satisfy."""
    return {"order_items": [("nonpositive_or_null_price", F.col("price").isNull() | (F.col("price") <= 0))],
            "orders": [("null_purchase_timestamp", F.col("order_purchase_timestamp").isNull())]}


def dq_report(m: Marketplace, min_rows: dict[str, int] | None = None) -> DataFrame:
    """L1-L5 as one report DataFrame; each table is scanned once for its checks."""
    limits = dict(MIN_ROWS, **(min_rows or {}))
    extra = {t: [zero_check(*c) for c in checks] for t, checks in _value_checks().items()}
    parts = [_checks(getattr(m, t), [min_rows_check(t, n)] + extra.get(t, [])) for t, n in limits.items()]
    parts += [_checks(getattr(m, t), checks) for t, checks in extra.items() if t not in limits]
    parts.append(orphan_check(m))
    return reduce(DataFrame.unionByName, parts)


def orphan_check(m: Marketplace) -> DataFrame:
    """L5 as a one-row report."""
    return _checks(orphan_items(m.order_items, m.orders), [("orphan_order_items", F.count(F.lit(1)), "= 0", lambda v: v == 0)])


def write_metrics(table: str) -> list[F.Column]:
    """What is measured while a staged table is written: its rows, and for each L3/L4 check the rows that fail it."""
    return [F.count(F.lit(1)).alias("rows"),
            *[F.count(F.when(condition, 1)).alias(name) for name, condition in _value_checks().get(table, [])]]


def measured_report(spark: SparkSession, metrics: dict[str, dict[str, int]], min_rows: dict[str, int] | None = None) -> DataFrame:
    """L1-L4 from the metrics of the staging writes, in the shape of ``dq_report``: no table is read."""
    limits = dict(MIN_ROWS, **(min_rows or {}))
    rows = []
    for table in {**limits, **_value_checks()}:
        seen = metrics[table]
        if table in limits:
            rows.append((f"rows:{table}", seen["rows"], f">= {limits[table]}", seen["rows"] >= limits[table]))
        rows += [(name, seen[name], "= 0", seen[name] == 0) for name, _ in _value_checks().get(table, [])]
    return spark.createDataFrame(rows, "check_name string, value long, rule string, passed boolean")


def schema_exists(spark: SparkSession, database: str) -> bool:
    """Catalog lookup."""
    return spark.catalog.databaseExists(database)


def enforce_gate(report: DataFrame) -> None:
    """Stop the pipeline when any check failed."""
    failed = report.filter(~F.col("passed")).collect()   # at most one row per check
    if failed:
        names = ", ".join(f"{r.check_name}={r.value} (rule {r.rule})" for r in failed)
        raise QualityGateError(f"{len(failed)} data-quality check(s) failed: {names}")
