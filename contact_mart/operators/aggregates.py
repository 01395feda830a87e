"""Grouped aggregates shared by the layers and the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.functions import arrays, dates, rules


def agents_per_conversation(rows: DataFrame) -> DataFrame:
    """All (agent, categories) entries per conversation, generic ones last, duplicates kept.

    Equal entries are counted before they are collected, so a conversation with many
    repeats sends and holds each distinct entry once; the repeats reappear only in
    the array of the result.
    """
    entry = ["agent_id", "first_category", "second_category", "third_category"]
    counted = rows.groupBy("conversation_id", *entry).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    ranked = F.struct(arrays.is_generic(F.col("first_category")).alias("generic"), *entry, "copies")
    sorted_entries = F.array_sort(F.collect_list(ranked))

    def repeat(e: Column) -> Column:
        return F.array_repeat(F.struct(*[e[c].alias(c) for c in entry]), e["copies"])

    return counted.groupBy("conversation_id").agg(sorted_entries.alias("_entries")).select(
        "conversation_id", F.flatten(F.transform("_entries", repeat)).alias("all_agents")
    )


def agent_time_total(df: DataFrame) -> DataFrame:
    """Summed handling time per (conversation, agent) from nested segments; NULL agents dropped."""
    exploded = df.select("conversation_id", F.explode("skill_lookup").alias("s"))
    return (
        exploded.where(F.col("s.agent_id").isNotNull())
        .groupBy("conversation_id", F.col("s.agent_id").alias("agent_id"))
        .agg(F.sum("s.aht").alias("total_aht"))
    )


def top_agent_by_time(totals: DataFrame) -> DataFrame:
    """Agent with the largest total per conversation; ties go to the smaller id."""
    rank = F.struct(F.col("total_aht").isNull(), -F.col("total_aht"), F.col("agent_id"))
    return totals.groupBy("conversation_id").agg(
        F.min_by(F.struct("agent_id", "total_aht"), rank).alias("best")
    ).select("conversation_id", "best.agent_id", "best.total_aht")


def handle_time_totals(segments: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    return segments.groupBy("conversation_id").agg(
        F.sum(F.coalesce("talk_time_second", zero)).alias("total_talk_time"),
        F.sum(F.coalesce("held_time_second", zero)).alias("total_held_time"),
        F.sum(F.coalesce("after_call_work_time_second", zero)).alias("total_acw"),
    )


def max_nps_per_conversation(surveys: DataFrame) -> DataFrame:
    """Largest score per conversation. Scores are text, so '9' is larger than '10'."""
    return surveys.groupBy("conversation_id").agg(F.max("nps").alias("nps"))


def handle_time_by(df: DataFrame, grain: Column, name: str) -> DataFrame:
    """Ratio of sums; NULL where the quantity is zero."""
    return df.groupBy(grain.alias(name)).agg(
        F.try_divide(F.sum("handletime_seconds"), F.sum("handle_qty")).alias("average_handle_time")
    ).orderBy(name)


def first_seen(mart: DataFrame) -> DataFrame:
    """Earliest day an agent number occurs in the nested segments."""
    return (
        mart.select("call_date", F.explode("skill_lookup").alias("s"))
        .where(F.col("s.bp_executive_num").isNotNull())
        .groupBy(F.col("s.bp_executive_num").alias("bp_num"))
        .agg(F.min("call_date").alias("first_seen"))
    )


def kpi_by_month(mart: DataFrame) -> DataFrame:
    """Weighted voice volume and NPS per month number and origin."""
    return (
        mart.groupBy("is_human", F.month("call_date").alias("mes"))
        .agg(
            F.sum(F.when(F.col("canal") == "voz", F.col("factor")).otherwise(0.0)).alias("voz"),
            F.avg(rules.nps_by_text(F.col("nps"))).alias("nps"),
        )
        .orderBy("mes", "is_human")
    )


def weekly(df: DataFrame, column: str) -> DataFrame:
    return handle_time_by(df, dates.sunday_week(F.col(column)), "week_number")


def monthly(df: DataFrame, column: str) -> DataFrame:
    return handle_time_by(df, F.month(column), "month_number")
