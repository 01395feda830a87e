"""Row filters. Date bounds compare the raw column, so that they reach the scan."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart import params as fixed
from contact_mart.functions import dates
from contact_mart.functions.rules import stripped
from contact_mart.params import Params


def cut(df: DataFrame, column: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Half-open range: start <= column < end."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) < F.lit(end))
    return df


def next_day(day: date) -> date:
    return day + timedelta(days=1)


def filter_segments(segments: DataFrame, p: Params) -> DataFrame:
    """Inbound contacts of the listed partners. A NULL queue fails the queue tests and is dropped."""
    queue = F.col("queue_name")
    return cut(segments, "conversation_date", p.facts_from, next_day(p.as_of)).where(
        F.col("factory_name").isin(*p.factories)
        & (F.col("originating_direction_type") == "inbound")
        & F.col("talk_time_second").isNotNull()
        & ~F.upper(queue).like(p.denied_queue_like)
        & ~stripped(queue).isin(*p.denied_queues)
    )


def filter_tickets(tickets: DataFrame, p: Params) -> DataFrame:
    """Solved tickets outside the excluded tags, subjects, groups and forms; NULLs fail."""
    group, form, tags = F.col("agent_group_name"), F.upper("contact_form_name"), F.col("tag_list")
    special = group == fixed.EXCEPTION_GROUP
    usual_form = ~special & ~form.isin(*fixed.DENIED_FORMS)
    if p.start or p.ticket_years is None:
        created = cut(tickets, "created_dt", p.facts_from)
    else:
        created = tickets.where(dates.in_years(F.col("created_dt"), p.ticket_years))
    return created.where(
        ~tags.rlike(fixed.DENIED_TAGS_REGEX)
        & ~tags.like(fixed.DENIED_TAGS_LIKE)
        & (F.upper("agent_name") != fixed.SYSTEM_AGENT)
        & ~F.upper("subject_desc").rlike(fixed.DENIED_SUBJECT_REGEX)
        & ~group.rlike(fixed.DENIED_GROUP_REGEX)
        & (F.timestamp_diff("SECOND", F.col("created_dt"), F.col("solved_dt")) > 10)
        & (usual_form | (special & (form == fixed.EXCEPTION_FORM)))
    )


def filter_bots(bots: DataFrame, p: Params) -> DataFrame:
    """Inbound bot sessions that never reached a queue, up to but without the current day."""
    return cut(bots, "conversation_start_datetime", p.facts_from, p.as_of).where(
        (F.col("originating_direction_type") == "inbound")
        & (F.col("is_voicebot") == 1)
        & (F.col("is_has_queue") == 0)
        & F.col("channel_type").isin("voice", "message")
    )


def is_chat_segment() -> Column:
    return F.col("channel_type").isin("webmessaging", "whatsapp") & (F.col("is_human") == "HUMAN")


def split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that fulfil the condition, and all others, unknown ones included."""
    holds = F.coalesce(condition, F.lit(False))
    return df.where(holds), df.where(~holds)


def channel_report_rows(mart: DataFrame, canal: str, after: date, until: date | None = None) -> DataFrame:
    """Human rows of one canal, strictly after a day."""
    rows = mart.where(
        (F.col("canal") == canal) & (F.col("is_human") == "HUMAN") & (F.col("call_date") > F.lit(after))
    )
    return rows if until is None else rows.where(F.col("call_date") <= F.lit(until))


def year_to_date(df: DataFrame, column: str, day: date) -> DataFrame:
    return cut(df, column, date(day.year, 1, 1), date(day.year + 1, 1, 1))


def recent_weeks(df: DataFrame, column: str, day: date, weeks: int = 4) -> DataFrame:
    """Sunday weeks of the year of ``day``, from ``weeks`` before its week up to it."""
    week = dates.sunday_week_of(day)
    return year_to_date(df, column, day).where(
        dates.sunday_week(F.col(column)).between(week - weeks, week)
    )


def transferred_bot_texts(
    bots: DataFrame, texts: DataFrame, channel: str, process: tuple[str, ...], first: date, last: date
) -> DataFrame:
    """Bot sessions handed to an agent, of one process and period, with their text."""
    chosen = cut(bots, "conversation_start_datetime", first, next_day(last)).where(
        (F.col("originating_direction_type") == "inbound")
        & (F.col("channel_type") == channel)
        & F.col("voicebot_category_process").isin(*process)
        & F.col("bp_agent_transferred_bot").isNotNull()
    )
    present = texts.where(F.col("text").isNotNull())
    return chosen.select("conversation_id").join(present, "conversation_id").select("conversation_id", "text")
