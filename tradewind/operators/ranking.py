"""Global ordering without a single-partition window — SURVEY §4 W1.

``RANK() / NTILE() / SUM() OVER (ORDER BY x)`` with no PARTITION BY makes Spark
move every row into one task.  ``global_positions`` computes the same numbers
with work spread over all partitions, on built-in expressions alone:

1. range-partition on (key, tie) and sort inside each partition (one shuffle;
   Spark samples the composite key, so a hot key value is still split);
2. ``monotonically_increasing_id`` already holds partition and row number of that
   order; both are fixed by one materialisation in the shared checkpoint folder;
3. a per-partition summary (one row per partition — bounded by the partition
   count, so it is broadcast) gives each partition its offsets;
4. RANK is the smallest position of a key: an aggregate that combines map-side and
   a join whose hot key can be split;
5. a running sum, where asked for, is a window inside each range partition plus
   the partition's offset.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import materialize

POS, RANK, RUN, COUNT, TOTAL = "_pos", "_rank", "_run", "_n", "_total"
_ROW_BITS = 33                             # monotonically_increasing_id: partition above, row below


def global_positions(df: DataFrame, key: str, tie: str, *, amount: str | None = None,
                     descending: bool = True, num_partitions: int | None = None,
                     keep_tie: bool = True, rank: bool = True) -> DataFrame:
    """Add ``_pos`` (1-based ROW_NUMBER over (key, tie)), ``_rank`` (RANK over key, if
    ``rank``), ``_n`` (row count) and, given an ``amount`` column of an exact type,
    ``_run`` (its running sum) and ``_total``.

    NULL keys come last, as one tie.  NULL amounts are skipped by both sums, which
    are 0 before the first known amount.  ``tie`` must make the order total (a struct
    orders field by field).  ``keep_tie=False`` drops the tie column after sorting.
    """
    k = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    # Without an explicit count the range exchange has spark.sql.shuffle.partitions
    # partitions and AQE may merge neighbours (still in order) when they are small.
    ranged = (df.repartitionByRange(num_partitions, k, F.col(tie).asc()) if num_partitions
              else df.repartitionByRange(k, F.col(tie).asc()))
    place = F.monotonically_increasing_id()
    ordered = (ranged.sortWithinPartitions(k, F.col(tie).asc())
                     .withColumn("_part", F.shiftright(place, _ROW_BITS))
                     .withColumn("_row", place.bitwiseAND((1 << _ROW_BITS) - 1)))
    if not keep_tie:                       # order inside each partition is already fixed
        ordered = ordered.drop(tie)
    local = materialize(ordered, "positions")

    sums = [F.coalesce(F.sum(amount), F.lit(0)).alias("_psum")] if amount else []
    summary = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"), *sums)
    # The summary has one row per partition: windows without PARTITION BY are fine here.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = [F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"),
               F.sum("_cnt").over(everything).alias(COUNT)]
    if amount:
        offsets += [F.coalesce(F.sum("_psum").over(before), F.lit(0)).alias("_before"),
                    F.sum("_psum").over(everything).alias(TOTAL)]
        run = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
        local = local.withColumn("_lrun", F.coalesce(F.sum(amount).over(run), F.lit(0)))
    placed = (local.join(F.broadcast(summary.select("_part", *offsets)), "_part")
                   .withColumn(POS, F.col("_offset") + F.col("_row") + 1))
    added = [POS, COUNT]
    if amount:
        placed = placed.withColumn(RUN, F.col("_before") + F.col("_lrun"))
        added += [RUN, TOTAL]
    if rank:
        first = placed.groupBy(F.col(key).alias("_key")).agg(F.min(POS).alias(RANK))
        placed = placed.join(first, placed[key].eqNullSafe(first["_key"]))
        added.append(RANK)
    return placed.select(*[F.col(c) for c in df.columns if keep_tie or c != tie], *added)


def ntile(pos: Column, n: Column, buckets: int) -> Column:
    """NTILE(buckets) from a 1-based global position and the row count: the first
    ``n mod buckets`` groups hold one extra row."""
    q = F.floor(n / buckets).cast("bigint")
    r = n - q * buckets
    big = r * (q + 1)
    return (F.when(pos <= big, F.floor((pos - 1) / (q + 1)) + 1)
             .otherwise(r + F.floor((pos - big - 1) / F.when(q > 0, q)) + 1)).cast("bigint")


#: Buckets that a range of values is cut into; values of a range that are fetched as they are.
BUCKETS, FEW = 1024, 2000


def percentiles_cont(df: DataFrame, value: str, fractions: dict[str, float]) -> DataFrame:
    """Exact PERCENTILE_CONT for each fraction, as a one-row DataFrame.

    Selection instead of sorting: the positions that are needed (two per fraction) are
    narrowed down by counting.  Each pass counts the values of the ranges that still hold a
    wanted position in ``BUCKETS`` parts of equal width, with the least and the largest value of
    each; a range ends when both are equal, however many rows share that value, or
    when so few values are left that they can be fetched.  A pass is one aggregate
    over the column, combined map-side; counts per bucket and at most ``FEW`` values per
    position reach the driver.  Linear interpolation between the values at the floor and
    ceiling positions, as the SQL standard defines it; NULL values are skipped.
    """
    spark = df.sparkSession
    values = materialize(df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull()), "percentile-values")
    n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    schema = ", ".join(f"{name} double" for name in fractions)
    if not n:
        return spark.createDataFrame([(None,) * len(fractions)], schema)
    places = {name: p * float(n - 1) for name, p in fractions.items()}
    wanted = sorted({int(f(rn)) for rn in places.values() for f in (math.floor, math.ceil)})
    found: dict[int, float] = {}
    ranges = [(low, high, 0, n, wanted)]            # least and largest value, rows before, rows, positions
    while ranges:
        found.update({i: lo for lo, hi, _, _, at in ranges if lo == hi for i in at})
        ranges = [r for r in ranges if r[0] < r[1]]
        few = [r for r in ranges if r[3] <= FEW]
        if few:
            inside = functools.reduce(operator.or_, [F.col("v").between(lo, hi) for lo, hi, *_ in few])
            fetched = sorted(r["v"] for r in values.filter(inside).collect())
            for lo, hi, before, _, at in few:
                own = [v for v in fetched if lo <= v <= hi]
                found.update({i: own[i - before] for i in at})
        ranges = _narrowed(values, [r for r in ranges if r[3] > FEW])
    row = []
    for rn in places.values():
        lo, hi = found[math.floor(rn)], found[math.ceil(rn)]
        row.append(lo if math.floor(rn) == math.ceil(rn) else lo + (hi - lo) * (rn - math.floor(rn)))
    return spark.createDataFrame([tuple(row)], schema)


def _narrowed(values: DataFrame, ranges: list[tuple]) -> list[tuple]:
    """The buckets of ``ranges`` that hold wanted positions, as ranges."""
    if not ranges:
        return []
    v, part = F.col("v"), None
    for j, (lo, hi, *_) in enumerate(ranges):
        bucket = F.least(F.width_bucket(v, F.lit(lo), F.lit(hi), F.lit(BUCKETS)), F.lit(BUCKETS)) + j * (BUCKETS + 1)
        inside = v.between(lo, hi)
        part = F.when(inside, bucket) if part is None else part.when(inside, bucket)
    counted = values.select(part.alias("b"), "v").filter(F.col("b").isNotNull()).groupBy("b") \
        .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    out, before = [], {j: r[2] for j, r in enumerate(ranges)}
    for r in sorted(counted, key=lambda r: r["b"]):
        j = r["b"] // (BUCKETS + 1)
        begin, before[j] = before[j], before[j] + r["n"]
        at = [i for i in ranges[j][4] if begin <= i < begin + r["n"]]
        if at:
            out.append((r["lo"], r["hi"], begin, r["n"], at))
    return out
