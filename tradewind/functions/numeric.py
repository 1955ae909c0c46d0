"""Numeric helpers that behave identically in Spark and in the SQL oracle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double(col: Column | str) -> Column:
    return _c(col).cast("double")


def round_half_up(col: Column | str, places: int) -> Column:
    """Round a double half away from zero on its binary value.

    ``sign(x) * floor(|x| * 10^n + 0.5) / 10^n`` is spelled the same way in the
    oracle, so both engines produce the same bits.  ``+ 0.0`` folds -0.0 into 0.0.
    """
    x = as_double(col)
    scale = float(10 ** places)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale) + F.lit(0.0)


def known_mean(col: Column | str, over=None) -> Column:
    """Mean of the known values of an exact column, in double: the exact sum over their count.

    NULLs count neither above nor below the line; NULL if no value is known.  ``over`` is an
    optional window."""
    total, known = F.sum(_c(col)), F.count(_c(col))
    if over is not None:
        total, known = total.over(over), known.over(over)
    return F.try_divide(total.cast("double"), known.cast("double"))


def safe_int(col: Column | str) -> Column:
    """Text to integer the lenient way: '12.7' -> 13, '1e2' -> 100, junk -> NULL."""
    return F.round(_c(col).try_cast("double")).try_cast("int")
