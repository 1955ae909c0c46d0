"""Connected components of a link table by alternating large-star and small-star steps.

Large-star hangs the larger neighbours of every node on its smallest neighbour,
small-star does so with the smaller neighbours and the node itself.  Both are an
aggregate and a join, so a node with very many links is combined map-side and
its join partition can be split.  Rounds grow with the logarithm of the longest
path; each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import materialize


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")) \
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node with a link to another node."""
    now = links.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).where("u <> v").distinct()
    now = materialize(now, "links")
    state = _state(now)
    while state[0]:
        now = materialize(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
