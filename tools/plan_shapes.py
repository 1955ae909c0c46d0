"""Plan shapes at scale settings: broadcast joins disabled, so joins plan as they
would on large tables.  For every mart and star table, count shuffle exchanges
and list single-partition exchanges (global aggregates over partial results).

Usage: python tools/plan_shapes.py [sf_dir] [--bucketed]
"""

import re
import sys
import tempfile

sys.path.insert(0, ".")

from tradewind.plans.pipeline import MARTS, STAR, read_staging, write_staging  # noqa: E402
from tradewind.session import build_session  # noqa: E402
from tradewind.sources.testdata import load_raw_testdata  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    root = tempfile.mkdtemp(prefix="tradewind-shapes-")
    write_staging(spark, load_raw_testdata(spark, sf), root, bucketed="--bucketed" in sys.argv)
    m = read_staging(spark)
    for name, build in {**MARTS, **STAR}.items():
        plan = build(m)._jdf.queryExecution().executedPlan().toString()
        exchanges = re.findall(r"Exchange (\w+)", plan)
        hashed = sum(1 for e in exchanges if e == "hashpartitioning")
        ranged = sum(1 for e in exchanges if e == "rangepartitioning")
        single = sum(1 for e in exchanges if e == "SinglePartition")
        print(f"{name:24s} hash={hashed:2d} range={ranged} single={single} windows={plan.count('Window ')}")
    spark.stop()


if __name__ == "__main__":
    main()
