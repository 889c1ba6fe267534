"""Calendar keys, proration, hourly rate and rounding (Spark SQL expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import WORKING_DAYS


def year_sql(date: str) -> str:
    return f"CAST(year({date}) AS INT)"


def month_sql(date: str) -> str:
    return f"CAST(month({date}) AS INT)"


def prorated_salary_sql(total_day: str = "total_day", salary: str = "salary") -> str:
    """More than 22 days -> salary, else round(days / 22.0, 2) * salary.

    Exact decimal arithmetic: ``days / 22.0`` is DECIMAL division, so the
    two-place rounding never sees binary noise (and can never be a tie).
    """
    return (f"CAST(CASE WHEN {total_day} > {WORKING_DAYS} THEN {salary} "
            f"ELSE round(CAST({total_day} AS DECIMAL(20,0)) / {WORKING_DAYS}.0BD, 2) * {salary} "
            f"END AS DECIMAL(24,4))")


def hourly_rate_sql(prorated: str = "prorated_salary", hours: str = "total_hours") -> str:
    """prorated / hours as DOUBLE; zero hours give NULL (skipped by AVG)."""
    return f"try_divide(CAST({prorated} AS DOUBLE), CAST({hours} AS DOUBLE))"


def round_half_up_sql(value: str, places: int = 2, precision: int = 20) -> str:
    """ROUND(x::NUMERIC, places): half away from zero, as a DECIMAL."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {places}) AS DECIMAL({precision},{places}))"


def round_double_sql(value: str, places: int = 6) -> str:
    """Unrounded rates are reported at 6 places so summation order cannot
    show; ``+ 0.0`` turns a negative zero into zero."""
    return f"(round(CAST({value} AS DOUBLE), {places}) + 0.0D)"


def prorated_salary(total_day: str = "total_day", salary: str = "salary") -> Column:
    return F.expr(prorated_salary_sql(total_day, salary))


def round_double(value: str, places: int = 6) -> Column:
    return F.expr(round_double_sql(value, places))
