"""Calendar helpers with boundary-counting semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_month(col: Column | str) -> Column:
    """First day of the month of a date or timestamp, as DATE."""
    return F.trunc(F.to_date(_c(col)), "MM")


def month_index_diff(start: Column | str, end: Column | str) -> Column:
    """Month boundaries crossed from start to end (Jan 31 -> Feb 1 is 1)."""
    s, e = _c(start), _c(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))


def hour_boundary_diff(start: Column | str, end: Column | str) -> Column:
    """Hour boundaries crossed from start to end (10:59 -> 11:01 is 1), on wall-clock
    fields, so the result does not depend on the session time zone."""
    s, e = _c(start), _c(end)
    return (F.datediff(F.to_date(e), F.to_date(s)) * 24 + F.hour(e) - F.hour(s)).cast("bigint")


def sunday_zero_weekday(col: Column | str) -> Column:
    """Weekday number with Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(_c(col)) - 1


def day_name(col: Column | str) -> Column:
    return F.date_format(_c(col), "EEEE")


def month_name(col: Column | str) -> Column:
    return F.date_format(_c(col), "MMMM")
