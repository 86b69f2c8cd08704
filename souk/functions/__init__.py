"""Scalar measures shared by all reports."""

from souk.functions.measures import (
    day_diff, exact_avg, in_year, in_years, item_value, money_ratio, month_label,
    round_half_up_ratio, to_double, trunc_avg,
)

__all__ = [
    "day_diff", "exact_avg", "in_year", "in_years", "item_value", "money_ratio",
    "month_label", "round_half_up_ratio", "to_double", "trunc_avg",
]
