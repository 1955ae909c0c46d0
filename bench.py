"""Benchmark: the full pipeline at $BENCH_SF_DIR on local[$BENCH_CPUS].

Stage (write the staging database) -> quality gate -> four marts -> star
schema, each exported as CSV with observed row counts — the same steps as the
published "full pipeline wall time".  Independent steps run as concurrent Spark
jobs ($BENCH_WORKERS driver threads, default 4).  Prints one JSON line;
``value`` is the pipeline wall time, ``queries`` the seconds of every step run
alone (a second run with one driver thread), of the phases of the first run
(``phase_*``) and of the cold start: session and first run on the smallest data.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind.plans.pipeline import run_pipeline  # noqa: E402
from tradewind.session import build_session  # noqa: E402
from tradewind.sources.testdata import load_raw_testdata  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    workers = int(os.environ.get("BENCH_WORKERS", "4"))
    bucketed = os.environ.get("BENCH_BUCKETED", "0") == "1"
    parts = int(os.environ.get("BENCH_PARTITIONS", cpus))
    began = time.perf_counter()
    spark = build_session(f"local[{cpus}]", app="tradewind-bench", shuffle_partitions=parts,
                          extra={"spark.driver.memory": "16g"})
    scratch = tempfile.mkdtemp(prefix="tradewind-bench-")
    # Warm-up on the smallest data (JIT, Python workers); not timed.
    run_pipeline(spark, load_raw_testdata(spark, "/root/testdata/sf0.001"), f"{scratch}/warm",
                 min_rows={k: 0 for k in ("sellers", "products", "orders", "order_items", "order_payments")},
                 workers=workers)
    cold = time.perf_counter() - began
    t0 = time.perf_counter()
    result = run_pipeline(spark, load_raw_testdata(spark, sf_dir), f"{scratch}/run", workers=workers,
                          bucketed=bucketed)
    wall = time.perf_counter() - t0
    alone = run_pipeline(spark, load_raw_testdata(spark, sf_dir), f"{scratch}/alone", workers=1, bucketed=bucketed)
    phases = ("staging", "quality_gate", "marts_and_star")
    queries = {k: v for k, v in alone["seconds"].items() if k not in phases}
    queries |= {f"phase_{k}": result["seconds"][k] for k in phases} | {"cold_start": round(cold, 3)}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"rows": result["rows"]}), file=sys.stderr)
    print(json.dumps({"metric": "full_pipeline_wall", "value": round(wall, 3), "unit": "sec",
                      "queries": queries, "sf": float(m.group(1)) if m else None}))
    spark.stop()


if __name__ == "__main__":
    main()
