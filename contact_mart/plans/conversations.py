"""Second layer: chat and whatsapp segments merged to one row per conversation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contact_mart.functions import arrays
from contact_mart.operators import filters
from contact_mart.operators.reshape import union_all
from contact_mart.params import Params
from contact_mart.sources.schemas import INTERMEDIA, conform

# Scalars that come from one and the same row: the smallest in this order of columns.
_ONE_ROW = [
    "call_date", "_skill", "_agent", "market_code", "channel_type", "cat_bot", "is_human",
    "mercado", "sag_name", "cat_pca", "second_category", "third_category",
]


def collapse_conversations(rows: DataFrame) -> DataFrame:
    """Merge all rows of a conversation.

    The categories are those of the agent who worked longest; each level that this agent
    lacks falls back to the representative row. The agent is found inside the merged
    row, so the whole collapse is one exchange on the conversation.
    """
    merged = (
        rows.withColumn("_skill", F.get("skill_name", F.lit(0)))
        .withColumn("_agent", F.get("skill_lookup", F.lit(0))["agent_id"])
        .groupBy("conversation_id")
        .agg(
            F.min(F.struct(*_ONE_ROW)).alias("one"),
            *[
                arrays.merge_arrays(F.col(c)).alias(c)
                for c in ("skill_name", "factory_name", "skill_lookup", "all_agents")
            ],
        )
    )
    winner = merged.withColumn(
        "own", arrays.categories_of(F.col("all_agents"), arrays.busiest_agent(F.col("skill_lookup")))
    )
    return winner.select(
        "conversation_id",
        "skill_name",
        "factory_name",
        "skill_lookup",
        "all_agents",
        *[f"one.{c}" for c in ("call_date", "market_code", "channel_type", "cat_bot", "is_human", "mercado", "sag_name")],
        F.coalesce("own.first_category", "one.cat_pca").alias("cat_pca"),
        F.coalesce("own.second_category", "one.second_category").alias("second_category"),
        F.coalesce("own.third_category", "one.third_category").alias("third_category"),
    )


def month_spans(calculated: DataFrame) -> DataFrame:
    """first, last: for each month in which a chat conversation starts, the last month that one of them reaches.

    One pass over the layer; what is left is a row per calendar month."""
    spans = (
        calculated.where(filters.is_chat_segment())
        .groupBy("conversation_id")
        .agg(F.trunc(F.min("call_date"), "MM").alias("first"), F.trunc(F.max("call_date"), "MM").alias("last"))
    )
    return spans.groupBy("first").agg(F.max("last").alias("last")).where(F.col("first").isNotNull())


def uncrossed_months(spans: DataFrame, starts: DataFrame) -> DataFrame:
    """start: those of the month starts (of ``starts`` or of the spans) that no span crosses.

    A sweep over the months: the running maximum of what the spans of earlier months reach. The sweep has a
    row per calendar month, however large the layer is."""
    months = spans.unionByName(starts.select(F.col("start").alias("first"), F.lit(None).cast("date").alias("last")))
    per_month = months.groupBy("first").agg(F.max("last").alias("last"))
    reached = F.max("last").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    swept = per_month.select(F.col("first").alias("start"), reached.alias("reached"))
    return swept.where(F.coalesce(F.col("reached") < F.col("start"), F.lit(True))).select("start")


def whole_conversation_start(calculated: DataFrame, start: date) -> date:
    """Latest month start at or before ``start``, itself the first of a month, that no chat conversation crosses.

    One scan of the layer and no loop: a conversation that crosses ``start`` makes the month in which it begins the
    next candidate, and all months between are crossed by it; so the answer is ``start`` or a month in which a
    conversation begins. Only a date comes to the driver."""
    if start.day != 1:
        raise ValueError(f"{start} is not the first day of a month")
    asked = calculated.sparkSession.createDataFrame([(start,)], "start date")
    found = uncrossed_months(month_spans(calculated), asked).where(F.col("start") <= F.lit(start))
    return found.agg(F.max("start")).first()[0]


def build_intermedia(calculated: DataFrame, p: Params | None = None) -> DataFrame:
    inside = p is not None and p.start is not None
    rows = calculated.where(F.col("call_date") >= F.lit(p.start)) if inside else calculated
    chats, others = filters.split(rows, filters.is_chat_segment())
    return union_all(conform(others, INTERMEDIA), conform(collapse_conversations(chats), INTERMEDIA))
