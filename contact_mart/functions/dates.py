"""Calendar rules on date, timestamp and yyyymm columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def window_start(day: Column) -> Column:
    """First day of the month before ``day``."""
    return F.trunc(F.add_months(day, -1), "MM")


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def period_of(day: Column) -> Column:
    """Month as the integer yyyymm."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def month_index(period: Column) -> Column:
    """Running month number of a yyyymm integer, so that differences count calendar months."""
    return F.floor(period / 100) * 12 + period % 100


def month_gap(period: Column, other: Column) -> Column:
    return F.abs(month_index(period) - month_index(other)).cast("int")


def sunday_week(day: Column) -> Column:
    """Week number with weeks that begin on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def sunday_week_of(day: date) -> int:
    """The same rule for a plain date."""
    return (day.timetuple().tm_yday + 6 - day.isoweekday() % 7) // 7


def in_years(column: Column, years: tuple[int, ...]) -> Column:
    """Year membership as ranges on the raw column, so that the filter reaches the scan."""
    runs: list[list[int]] = []
    for year in sorted(set(years)):
        if runs and runs[-1][1] == year - 1:
            runs[-1][1] = year
        else:
            runs.append([year, year])
    test = F.lit(False)
    for first, last in runs:
        test = test | ((column >= F.lit(date(first, 1, 1))) & (column < F.lit(date(last + 1, 1, 1))))
    return test
