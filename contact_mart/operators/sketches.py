"""Distinct counts over any period from stored daily sketches.

A distinct count does not add up over days; a sketch does. One sketch per day and group is kept beside the mart,
an incremental run replaces the days of its window, and a count over any period merges the sketches of its days:
some kilobytes each, however many rows a day has. The counts are estimates; exact counts stay the default.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.operators import filters

# Logarithm of the registers of a sketch: 16384 of them, at most 16 KB.
REGISTERS = 14


def standard_error(registers: int = REGISTERS) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / 2 ** (registers / 2)


def daily_sketches(
    rows: DataFrame, groups: Sequence[str], counted: Mapping[str, str], day: str = "call_date", registers: int = REGISTERS
) -> DataFrame:
    """One row per day and group with a sketch of each column in ``counted`` (name: column). Rows are merged into
    sketches before they move. Nulls are not counted, and a day with nothing else has an empty sketch."""
    return rows.groupBy(day, *groups).agg(
        *[F.hll_sketch_agg(F.col(column), F.lit(registers)).alias(name) for name, column in counted.items()]
    )


def distinct_over(
    sketches: DataFrame, groups: Sequence[str | Column], names: Sequence[str], start: date | None = None, until: date | None = None,
    day: str = "call_date",
) -> DataFrame:
    """Estimated distinct counts per group over the days ``start <= day < until``."""
    return filters.cut(sketches, day, start, until).groupBy(*groups).agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in names]
    )
