"""Sinks (A6) with row counts observed during the write.

``DataFrame.observe`` collects the count as a side metric of the one write job,
instead of running the query a second time to count it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_observed(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                   name: str = "rows") -> int:
    obs = Observation(name)
    if fmt == "csv":                       # timestamps as SQL prints them, with a blank and no needless fraction
        df = df.select(*[F.col(f.name).cast("string").alias(f.name)
                         if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name)
                         for f in df.schema])
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get["rows"])


def export_csv(df: DataFrame, path: str) -> int:
    """CSV with header, written in parallel part files."""
    return write_observed(df, path, fmt="csv")
