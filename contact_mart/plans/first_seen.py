"""Maintained table of the first day each agent number occurs in the mart.

A minimum merges but does not take back, so the state holds one minimum per agent number and month: a run that
replaces the months of its window recomputes them alone, and the first day is the least of the months that are
left. The work of a run follows its window, not the history of the mart.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contact_mart.sources.versions import VersionedTable


def first_seen_by_month(mart: DataFrame) -> DataFrame:
    """bp_num, month, first_seen: earliest day of each month an agent number occurs in the nested segments."""
    return (
        mart.select("call_date", F.explode("skill_lookup").alias("s"))
        .where(F.col("s.bp_executive_num").isNotNull() & F.col("call_date").isNotNull())
        .groupBy(F.col("s.bp_executive_num").alias("bp_num"), F.trunc("call_date", "MM").alias("month"))
        .agg(F.min("call_date").alias("first_seen"))
    )


class FirstSeen:
    """The state under ``path``; a refresh is one new version of it, so a failed one changes nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path, day="month", cluster="bp_num")

    def refresh(self, mart: DataFrame, start: date | None = None) -> None:
        """Take over the mart: all of it, or its rows from ``start``, the first day of a month, on."""
        if start is None or not self.table.exists():
            self.table.rewrite(first_seen_by_month(mart))
            return
        if start.day != 1:
            raise ValueError(f"{start} is not the first day of a month")
        self.table.replace_from(first_seen_by_month(mart.where(F.col("call_date") >= F.lit(start))), start)
        self.table.vacuum()

    def read(self) -> DataFrame:
        """bp_num, first_seen."""
        return self.table.read().groupBy("bp_num").agg(F.min("first_seen").alias("first_seen"))
