"""Each row's next row in descending order of a key, without a window over the whole table.

The distinct (key, content hash) pairs are ordered by range once, from a table of
numbers alone; the first pair of each range reaches the driver (a row per range).
Rows then move once, with all they hold, to the task of their range.  A row whose
pair begins a range is sent as a guest to the range before as well, where it
follows the last row; the first row of all is the guest of the last range.

Pairs that hold more than a part in four times the ranges of all rows (fewer than
that many pairs) are reduced to one row with a number of copies before they move,
so a pair repeated by a third of all rows is no hot range.

Defined results: NULL keys come last; equal keys are ordered by content hash; of n
copies of a row, n - 1 are followed by a copy and one by the next other row; a
single row follows itself; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import materialize, shuffle_partitions

#: Ranges for each shuffle partition.
RANGES_PER_PARTITION = 4
_PAIR = ["_key", "_hash"]


def in_order(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, list[tuple[int, int]]]:
    """``key``, ``text`` (NULL: empty) and ``copies`` with the pair of each row, and the pairs that begin ranges."""
    ranges = RANGES_PER_PARTITION * shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias(text)) \
        .withColumn("_key", F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))) \
        .withColumn("_hash", F.xxhash64(text))
    pairs = materialize(rows.groupBy(*_PAIR).agg(F.count("*").alias("copies")), "order")
    begins = pairs.repartitionByRange(ranges, F.desc("_key"), F.desc("_hash")).groupBy(F.spark_partition_id().alias("r")) \
        .agg(F.max(F.struct(*_PAIR)).alias("first"), F.sum("copies").alias("n")).collect()
    total = sum(r["n"] for r in begins)
    many = pairs.where((F.col("copies") > 1) & (F.col("copies") * (4 * ranges) > total))
    if many.isEmpty():
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    else:
        few = F.broadcast(many)                       # fewer than four times the ranges
        reduced = rows.join(few, _PAIR).groupBy(*_PAIR) \
            .agg(F.first(key).alias(key), F.first(text).alias(text), F.first("copies").alias("copies"))
        single = rows.join(few.select(*_PAIR), _PAIR, "left_anti").withColumn("copies", F.lit(1).cast("long"))
        rows = single.unionByName(reduced)
    return rows, sorted(tuple(r["first"]) for r in begins)


def with_next(rows: DataFrame, begins: list[tuple[int, int]], carry: list[str]) -> DataFrame:
    """``rows`` with ``next`` (a struct of the columns ``carry`` of the next row) and ``times``, the number
    of rows that this row stands for; ``rows`` and ``begins`` as from ``in_order``, further columns allowed."""
    count = max(len(begins), 1)

    @F.pandas_udf("long")
    def place(keys: pd.Series, hashes: pd.Series) -> pd.Series:
        # Twice the number of the range that the pair falls in, and one more if it begins the range.
        found = ((p, bisect_left(begins, p)) for p in zip(keys, hashes))
        return pd.Series([2 * i + (i < len(begins) and begins[i] == p) for p, i in found], dtype="int64")

    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.pmod(F.col("_range") + 1, F.lit(count)).alias("range"), F.lit(True).alias("guest"))
    kept = [c for c in rows.columns if c not in _PAIR]
    sent = rows.withColumn("_place", place(*_PAIR)) \
        .withColumn("_range", F.shiftright("_place", 1)) \
        .withColumn("_at", F.explode(F.when(F.col("_place") % 2 == 1, F.array(own, guest)).otherwise(F.array(own))))
    order = Window.partitionBy("_at.range").orderBy("_at.guest", F.desc("_key"), F.desc("_hash"))
    ahead = sent.withColumn("_next", F.lead(F.struct(*carry)).over(order)).where(~F.col("_at.guest"))
    ways = F.array(F.struct(F.col("_next").alias("next"), F.lit(1).cast("long").alias("times")),
                   F.struct(F.struct(*carry).alias("next"), (F.col("copies") - 1).alias("times")))
    return ahead.withColumn("_way", F.explode(F.filter(ways, lambda w: w["times"] > 0))) \
        .select(*[c for c in kept if c != "copies"], F.col("_way.next").alias("next"), F.col("_way.times").alias("times"))
