import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewind.operators.ranking import COUNT, POS, RANK, RUN, TOTAL, global_positions, ntile, percentiles_cont


def _data(n, seed, distinct):
    rnd = random.Random(seed)
    return [(i, rnd.randint(0, distinct) * 100, rnd.randint(1, 50)) for i in range(n)]


def test_positions_match_plain_windows_with_ties(spark):
    for n, distinct, parts in [(500, 7, 8), (300, 300, 5), (50, 1, 4), (3, 2, 8)]:
        df = spark.createDataFrame(_data(n, n, distinct), "id long, v long, amt long")
        got = global_positions(df, "v", "id", amount="amt", num_partitions=parts)
        w = Window.orderBy(F.col("v").desc(), F.col("id"))
        ref = df.select("id", F.row_number().over(w).alias("rn"),
                        F.rank().over(Window.orderBy(F.col("v").desc())).alias("rk"),
                        F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
                        F.ntile(4).over(w).alias("q"))
        a = {r.id: (r[POS], r[RANK], r[RUN], r[COUNT], r[TOTAL], r.q4)
             for r in got.withColumn("q4", ntile(F.col(POS), F.col(COUNT), 4)).collect()}
        total = sum(x[2] for x in _data(n, n, distinct))
        b = {r.id: (r.rn, r.rk, r.cum, n, total, r.q) for r in ref.collect()}
        assert a == b


def test_ntile_sizes_differ_by_at_most_one(spark):
    for n in [1, 2, 3, 4, 5, 9, 10, 11, 101]:
        df = spark.range(1, n + 1).select(F.col("id").alias("pos"), F.lit(n).cast("long").alias("n"))
        sizes = df.groupBy(ntile(F.col("pos"), F.col("n"), 4).alias("q")).count().collect()
        counts = sorted(r["count"] for r in sizes)
        assert counts[-1] - counts[0] <= 1 and sum(counts) == n


def test_percentiles_match_percentile_cont(spark):
    rnd = random.Random(3)
    rows = [(i, round(rnd.uniform(0, 1000), 2)) for i in range(257)] + [(1000 + i, 5.0) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, x double")
    got = percentiles_cont(df, "x", {"p80": 0.8, "p50": 0.5}).first()
    ref = df.select(F.percentile("x", 0.8).alias("a"), F.percentile("x", 0.5).alias("b")).first()
    assert abs(got.p80 - ref.a) < 1e-9 and abs(got.p50 - ref.b) < 1e-9


def test_positions_independent_of_aqe_and_partition_count(spark):
    df = spark.createDataFrame(_data(400, 11, 9), "id long, v long, amt long")
    w = Window.orderBy(F.col("v").desc(), F.col("id"))
    ref = {r.id: (r.rn, r.rk, r.cum) for r in df.select(
        "id", F.row_number().over(w).alias("rn"), F.rank().over(Window.orderBy(F.col("v").desc())).alias("rk"),
        F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum")).collect()}
    saved = (spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        for aqe, parts in [("false", "200"), ("true", "200"), ("false", "3")]:
            spark.conf.set("spark.sql.adaptive.enabled", aqe)
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {r.id: (r[POS], r[RANK], r[RUN]) for r in global_positions(df, "v", "id", amount="amt").collect()}
            assert got == ref, (aqe, parts)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", saved[0])
        spark.conf.set("spark.sql.shuffle.partitions", saved[1])
