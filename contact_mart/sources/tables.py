"""Writing of the layer tables: full rebuilds and replacement of a date window, each as a new version."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from contact_mart.sources.versions import VersionedTable


def write_layer(df: DataFrame, path: str, day: str = "call_date", cluster: str = "conversation_id") -> None:
    """Replace the whole table, one folder per day."""
    VersionedTable(df.sparkSession, path, day, cluster).rewrite(df)


def append_layer(df: DataFrame, path: str, day: str = "call_date", cluster: str = "conversation_id") -> None:
    VersionedTable(df.sparkSession, path, day, cluster).append(df)


def read_layer(spark: SparkSession, path: str, day: str = "call_date") -> DataFrame:
    """The current version; it stays readable while a new one is written and after the switch."""
    return VersionedTable(spark, path, day).read()


def replace_where(
    df: DataFrame, path: str, start: date, day: str = "call_date", cluster: str = "conversation_id"
) -> None:
    """Replace the rows with ``day >= start``; days of the window without new rows are empty afterwards."""
    VersionedTable(df.sparkSession, path, day, cluster).replace_from(df, start)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    VersionedTable(spark, path).vacuum(keep)
