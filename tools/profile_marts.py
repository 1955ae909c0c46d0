"""Stage once, then time each mart/star step twice in the same (warm) session."""

import sys
import tempfile
import time

sys.path.insert(0, ".")

from tradewind.plans.pipeline import MARTS, STAR, read_staging, write_staging  # noqa: E402
from tradewind.session import build_session  # noqa: E402
from tradewind.sources.testdata import load_raw_testdata  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
names = sys.argv[2:] or list({**MARTS, **STAR})
spark = build_session("local[8]", shuffle_partitions=8)
root = tempfile.mkdtemp(prefix="tradewind-prof-")
write_staging(spark, load_raw_testdata(spark, sf), root)
m = read_staging(spark)
steps = {**MARTS, **STAR}
for rep in range(2):
    for n in names:
        t0 = time.perf_counter()
        df = steps[n](m)
        t1 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        print(f"rep{rep} {n:24s} build {t1 - t0:5.2f}s run {time.perf_counter() - t1:5.2f}s", flush=True)
