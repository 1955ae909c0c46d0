"""Cells: all pairs of the rows of a group, cut into tasks of bounded size.

A group of n rows gets k = ceil(n / chunk) chunks; each row is dealt to a chunk
by hash and copied to the k cells that pair its chunk with every chunk, its own
included.  Every two rows of a group meet in exactly one cell (rows of one chunk
in the cell of the chunk with itself), and a cell holds about two chunks however
large the group is.  Where only pairs of two sides count, facing cells pair the chunks
of one side with those of the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_cells(rows: DataFrame, keys: list[str], by: str, chunk: int) -> DataFrame:
    """``rows`` of groups with two members or more, with ``cell_a``, ``cell_b`` (a <= b) and ``own`` (the row's chunk)."""
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1") \
        .select(*keys, F.ceil(F.col("_n") / F.lit(chunk)).cast("int").alias("_k"))
    dealt = rows.join(sizes, keys) \
        .withColumn("own", F.pmod(F.xxhash64(F.lit("cell"), F.col(by)), F.col("_k")).cast("int")) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return dealt.withColumn("cell_a", F.least("own", "_other")).withColumn("cell_b", F.greatest("own", "_other")) \
        .drop("_k", "_other")


def with_facing_cells(rows: DataFrame, keys: list[str], side: str, by: str, chunk: int) -> DataFrame:
    """``rows`` of groups that have both sides (``side`` is 0 or 1), with ``cell_a`` (a chunk of side 0), ``cell_b``
    (a chunk of side 1) and ``own``; every two rows of different sides meet in exactly one cell."""
    left = F.col(side) == 0
    chunks = lambda n: F.ceil(F.col(n) / F.lit(chunk)).cast("int")
    sizes = rows.groupBy(*keys).agg(F.count(F.when(left, 1)).alias("_n0"), F.count(F.when(~left, 1)).alias("_n1")) \
        .where("_n0 > 0 AND _n1 > 0").select(*keys, chunks("_n0").alias("_k0"), chunks("_n1").alias("_k1"))
    mine, theirs = F.when(left, F.col("_k0")).otherwise(F.col("_k1")), F.when(left, F.col("_k1")).otherwise(F.col("_k0"))
    dealt = rows.join(sizes, keys) \
        .withColumn("own", F.pmod(F.xxhash64(F.lit("cell"), F.col(by)), mine).cast("int")) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), theirs - 1)))
    return dealt.withColumn("cell_a", F.when(left, F.col("own")).otherwise(F.col("_other"))) \
        .withColumn("cell_b", F.when(left, F.col("_other")).otherwise(F.col("own"))).drop("_k0", "_k1", "_other")
