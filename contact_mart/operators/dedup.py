"""One row per key. Every choice has a total order, so results repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contact_mart.functions.rules import stripped


def top1(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """First row per key. The rank filter becomes a group limit before the shuffle,
    so a hot key sends one row per map task."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def up(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_first() for name in names]


def down(*names: str) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in names]


def min_per_key(df: DataFrame, key: str, value: str, name: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(F.min(value).alias(name or value))


def latest_staff(staff: DataFrame, *keys: str) -> DataFrame:
    """Last loaded snapshot per key; equal load times fall back to numbers and ids."""
    rest = [c for c in ("agent_bp_number", "agent_id", "supervisor_bp_number", "period_id") if c not in keys]
    return top1(staff, list(keys), down("load_datetime") + up(*rest))


def latest_hr_by_email(hr: DataFrame) -> DataFrame:
    named = hr.where(F.col("employee_email").isNotNull()).select(
        "bp_num", F.lower("employee_email").alias("employee_email"), "load_dt"
    )
    return top1(named, ["employee_email"], down("load_dt") + up("bp_num")).select("bp_num", "employee_email")


def latest_agent_name(names: DataFrame) -> DataFrame:
    return top1(names, ["agent_bp_number"], down("load_date") + up("agent_name")).select(
        "agent_bp_number", "agent_name"
    )


def filled(name: str) -> Column:
    """0 when the field holds something, 1 when it is NULL or 'N/A'."""
    return F.when(F.col(name).isNotNull() & (F.col(name) != "N/A"), 0).otherwise(1)


def best_queue_row(dictionary: DataFrame) -> DataFrame:
    """Most complete dictionary row per trimmed queue name."""
    keyed = dictionary.withColumn("queue_key", stripped(F.col("Nombre_de_Cola")))
    completeness = [
        filled("Gerencia"),
        filled("ID_Cola"),
        F.when(F.col("Cola_con_Demanda") == "SI", 0).otherwise(1),
        filled("SubGerente"),
        filled("Script"),
    ]
    others = [c for c in dictionary.columns if c != "ID_Cola"]
    return top1(keyed, ["queue_key"], [c.asc() for c in completeness] + up("ID_Cola", *others))


def user_of_participant(sessions: DataFrame) -> DataFrame:
    """One user per participant: the largest user id, as an aggregate with a map-side step."""
    return sessions.groupBy("participant_id").agg(F.max("user_id").alias("agent_id"))
