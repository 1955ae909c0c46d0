"""Shared treatment of embedding columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, key: str, vector: str, *others: str) -> DataFrame:
    """``key, vector`` (array of doubles) and ``others`` of the rows whose vector is not NULL,
    not zero and holds no NULL or non-finite component."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.select(F.col(key).cast("long").alias("key"), v.alias("vector"), *[F.col(c).alias(c) for c in others]) \
        .where(F.col("key").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; scaled by the largest component first, against overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows; each depends on its own two rows alone, so equal pairs are equal to the bit."""
    scale = lambda m: m / np.abs(m).max(axis=1, keepdims=True)
    a, b = scale(a), scale(b)
    dot = (a * b).sum(axis=1)
    return dot / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
