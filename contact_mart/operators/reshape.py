"""Unions of conformed frames and wide-to-long reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame, fill: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def unpivot_measures(
    df: DataFrame, ids: list[str], measures: list[str], name: str, value: str, keep_nulls: bool = False
) -> DataFrame:
    long = df.unpivot(ids, measures, name, value)
    return long if keep_nulls else long.where(F.col(value).isNotNull())


def explode_segments(df: DataFrame, lookup: str = "skill_lookup") -> DataFrame:
    """One row per element of the nested segments; rows without any are dropped."""
    others = [c for c in df.columns if c != lookup]
    return df.select(*others, F.explode(lookup).alias("segment"))
