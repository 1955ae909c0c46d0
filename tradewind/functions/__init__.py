"""Column-level helpers: every one is a native Spark expression (no Python UDF)."""

from tradewind.functions.dates import (day_name, hour_boundary_diff, month_index_diff, month_name,
                                       sunday_zero_weekday, to_month)
from tradewind.functions.numeric import as_double, known_mean, round_half_up, safe_int
from tradewind.functions.text import category_label, title_case

__all__ = [
    "as_double", "category_label", "day_name", "hour_boundary_diff", "known_mean", "month_index_diff",
    "month_name", "round_half_up", "safe_int", "sunday_zero_weekday", "title_case",
    "to_month",
]
