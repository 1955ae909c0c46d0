"""End-to-end pipeline: stage -> quality gate -> marts -> star schema -> exports.

One SparkSession, one driver program.  Staged tables are written once, as a version
of their own (parquet; optionally the order-grain tables bucketed on
``order_id`` so items, orders and payments join without a shuffle), and every
later step reads them back from storage, so a lost executor never forces
recomputation of the ingest.  The gate takes row counts and value checks from the write jobs
and reads tables for the orphan check alone; the ``staging`` database is then switched to
the new version.  Exports are written with row counts observed in the same job.
"""

from __future__ import annotations

import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradewind.operators import category, churn, customer, quality, seller, staging, star
from tradewind.session import intermediates, materialize, remove
from tradewind.sources.sinks import write_observed
from tradewind.sources.tables import Marketplace, RawMarketplace

STAGING_DB = "staging"
#: Tasks that one month of the fact export is dealt to.
MONTH_SPLIT = 8
ORDER_GRAIN = ("orders", "order_items", "order_payments")

MARTS = {
    "seller_profile": seller.seller_profile,
    "churn_risk": churn.churn_risk,
    "category_analysis": category.category_analysis,
    "customer_and_delivery": customer.customer_and_delivery,
}
STAR = {
    "fact_orders": star.fact_orders,
    "dim_seller": star.dim_seller,
    "dim_customer": star.dim_customer,
    "dim_product": star.dim_product,
    "dim_date": star.dim_date,
}


def _concurrently(steps: dict, workers: int) -> dict:
    """Run independent steps as concurrent Spark jobs from a few driver threads.

    Each step submits its own jobs; Spark shares the executor slots among them, so
    a step waiting on a stage boundary does not leave the cluster idle.  Returns
    ``{name: (result, seconds)}``; the first failure is re-raised.
    """
    def timed(fn):
        t0 = time.perf_counter()
        out = fn()
        return out, round(time.perf_counter() - t0, 3)

    if workers <= 1:
        return {name: timed(fn) for name, fn in steps.items()}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(timed, fn) for name, fn in steps.items()}
        return {name: f.result() for name, f in futures.items()}


@dataclass(frozen=True)
class StagedRun:
    """One version of the staging tables: its database and what its write jobs observed, per table."""

    database: str
    metrics: dict[str, dict[str, int]]

    @property
    def counts(self) -> dict[str, int]:
        return {name: seen["rows"] for name, seen in self.metrics.items()}


def write_staging(spark: SparkSession, raw: RawMarketplace, root: str, buckets: int | None = None,
                  bucketed: bool = False, workers: int = 4, publish: bool = True) -> StagedRun:
    """A4: materialise every cleaned table as a new version, in a database and folder of its own.

    Nothing that exists is touched while the tables are written, so readers keep the
    published version, and two runs don't meet.  If writing fails, the new version is
    dropped.  ``publish`` then points the ``staging`` database at it (see ``publish_staging``).

    With ``bucketed`` the order-grain tables share ``buckets`` buckets on
    ``order_id``: the item-order-payment joins then need no exchange.  It is off
    by default: a bucket is read by one task and cannot be split, so one order
    holding a large share of all items would make one task do that share.
    Without it the joins shuffle and AQE's skew-join splits a hot partition.
    Turn it on when the order key is known not to be hot.  Without it the orders are
    partitioned by purchase month, which date ranges prune.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    database = f"{STAGING_DB}_{uuid.uuid4().hex[:12]}"
    folder = f"{root}/{STAGING_DB}/{database}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")

    def write_one(name: str, df: DataFrame) -> dict[str, int]:
        spark.sparkContext.setJobDescription(f"staging.{name}")
        obs = Observation(f"staged_{name}")
        if bucketed and name in ORDER_GRAIN:
            # Hash-partition into exactly the bucket count first (same hash as the bucket id):
            # every task then writes one sorted file for one bucket, in parallel, instead of
            # every task writing a file for every bucket.
            df = df.repartition(buckets, "order_id")
        elif name == "orders":
            df = staging.by_purchase_month(df)
        writer = (df.observe(obs, *quality.write_metrics(name)).write.mode("overwrite").format("parquet")
                    .option("path", f"{folder}/{name}"))
        if bucketed and name in ORDER_GRAIN:
            writer = writer.bucketBy(buckets, "order_id").sortBy("order_id")
        elif name == "orders":
            writer = writer.partitionBy(staging.PURCHASE_MONTH)
        writer.saveAsTable(f"{database}.{name}")
        return {k: int(v) for k, v in obs.get.items()}

    try:
        tables = dict(staging.stage_all(raw).items())
        done = _concurrently({n: (lambda n=n, df=df: write_one(n, df)) for n, df in tables.items()}, workers)
    except BaseException:
        drop_version(spark, database)
        raise
    run = StagedRun(database, {n: seen for n, (seen, _) in done.items()})
    if publish:
        publish_staging(spark, run)
    return run


def drop_version(spark: SparkSession, database: str) -> None:
    """Drop a version's tables and files (its tables are external, so files are deleted here)."""
    rows = spark.sql(f"DESCRIBE DATABASE {database}").collect()
    where = next(r["info_value"] for r in rows if r["info_name"] == "Location")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    remove(spark, where)


def _versions(spark: SparkSession) -> tuple[str | None, str | None]:
    """The published version and the one before it, from the properties of the staging database."""
    rows = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {STAGING_DB}").collect()}
    found = dict(re.findall(r"\((version|previous),(\w+)\)", rows.get("Properties", "").replace(" ", "")))
    return found.get("version"), found.get("previous")


def publish_staging(spark: SparkSession, run: StagedRun) -> None:
    """Point the views of the ``staging`` database at a written version.

    The version that was published until now stays, for readers who are at it; the one
    before that is dropped."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {STAGING_DB}")
    current, previous = _versions(spark)
    for name in run.metrics:
        spark.sql(f"CREATE OR REPLACE VIEW {STAGING_DB}.{name} AS SELECT * FROM {run.database}.{name}")
    spark.sql(f"ALTER DATABASE {STAGING_DB} SET DBPROPERTIES ('version' = '{run.database}', 'previous' = '{current or ''}')")
    if previous and previous not in (current, run.database) and spark.catalog.databaseExists(previous):
        drop_version(spark, previous)


def read_staging(spark: SparkSession, database: str = STAGING_DB) -> Marketplace:
    """A5: staged-table scans, of the published version or of a given one."""
    return Marketplace(**{name: spark.table(f"{database}.{name}") for name in Marketplace.__dataclass_fields__})


def run_pipeline(spark: SparkSession, raw: RawMarketplace, root: str, *, min_rows: dict[str, int] | None = None,
                 export_format: str = "csv", bucketed: bool = False, workers: int = 4) -> dict[str, dict]:
    """Run every step; returns row counts and wall seconds per step.  Raises
    ``QualityGateError`` (L7) before any mart is written when a check fails; the published
    staging version is then the one before, and the rejected one is kept in the database that the error names.

    Independent writes (the staged tables; then the marts and star tables) are
    submitted as concurrent jobs from ``workers`` driver threads; per-step seconds
    then overlap, ``staging`` and ``marts_and_star`` are the phase wall times."""
    timings: dict[str, float] = {}
    counts: dict[str, int] = {}

    sc = spark.sparkContext
    t0 = time.perf_counter()
    sc.setJobDescription("staging")
    # What building ``raw`` writes belongs to the caller, who may use ``raw`` again.
    run = write_staging(spark, raw, root, bucketed=bucketed, workers=workers, publish=False)
    counts.update({f"staging.{k}": v for k, v in run.counts.items()})
    timings["staging"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    sc.setJobDescription("quality_gate")
    m = read_staging(spark, run.database)
    if not quality.schema_exists(spark, run.database):          # L6
        raise quality.QualityGateError("staging database missing")
    try:
        quality.enforce_gate(quality.measured_report(spark, run.metrics, min_rows))   # L1-L4, L7: no scan
        quality.enforce_gate(quality.orphan_check(m))                                 # L5
    except quality.QualityGateError as e:
        raise quality.QualityGateError(f"{e}; the staged tables are kept in {run.database}") from e
    publish_staging(spark, run)
    timings["quality_gate"] = time.perf_counter() - t0

    def export(name: str, build) -> int:
        spark.sparkContext.setJobDescription(name)
        df: DataFrame = build(m)
        parts = ["order_month"] if name == "fact_orders" else None
        if parts:
            # Cluster by month before the partitioned write: files ~ months x split, not tasks x
            # months.  A hash needs no sample of its input, so the fact join runs once.
            df = (df.withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
                    .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "order_month",
                                 F.pmod(F.xxhash64("order_id"), F.lit(MONTH_SPLIT))))
        return write_observed(df, f"{root}/exports/{name}", fmt=export_format, partition_by=parts)

    t0 = time.perf_counter()
    with intermediates(spark):
        # One item shuffle and product join for the two marts that need them.
        grain = materialize(seller.seller_category_day(m), "seller-category-day")
        builds = {**MARTS, **STAR, "seller_profile": lambda m: seller.seller_profile(m, grain=grain),
                  "category_analysis": lambda m: category.category_analysis(m, grain=grain)}
        done = _concurrently({n: (lambda n=n, b=b: export(n, b)) for n, b in builds.items()}, workers)
    for name, (rows, secs) in done.items():
        counts[name] = rows
        timings[name] = secs
    timings["marts_and_star"] = time.perf_counter() - t0
    sc.setJobDescription(None)
    return {"rows": counts, "seconds": {k: round(v, 3) for k, v in timings.items()}}
