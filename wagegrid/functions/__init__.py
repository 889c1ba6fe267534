"""Scalar expressions (Spark SQL text or Columns; no Python in the data path)."""

from .pay import hourly_rate_sql, prorated_salary, prorated_salary_sql, round_double
from .shift import fill_checkin_sql, fill_checkout_sql, shift_seconds_sql
from .timeofday import format_time, parse_time, parse_time_sql, seconds_of_day, time_literal

__all__ = [
    "fill_checkin_sql", "fill_checkout_sql", "format_time", "hourly_rate_sql", "parse_time",
    "parse_time_sql", "prorated_salary", "prorated_salary_sql", "round_double", "seconds_of_day",
    "shift_seconds_sql", "time_literal",
]
