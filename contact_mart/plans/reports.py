"""Reports and samples on top of the mart."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contact_mart.functions import rules
from contact_mart.operators import aggregates, filters, joins, sampling
from contact_mart.operators.reshape import union_all

CONVERSATION = {"conversation_id": "conversation_id"}


def voice_kpis(mart: DataFrame, first: date, last: date) -> DataFrame:
    period = filters.cut(mart, "call_date", first, filters.next_day(last))
    return aggregates.kpi_by_month(period.where(F.col("canal") == "voz"))


def recontact_view(contacts: DataFrame) -> DataFrame:
    known = rules.traceable(F.col("customer_phone"), F.col("customer_id"), F.col("entity_id"))
    return contacts.select(
        F.col("customer_id").try_cast("bigint").alias("customer_id"),
        "entity_id",
        "customer_phone",
        "record_id",
        F.col("is_recontact_24_hrs").alias("is_recontact_24_hours"),
        F.col("creation_datetime").alias("creation_dt"),
        "channel",
        "contact_channel_name",
        "factory_name",
        F.col("service_agent_group_name").alias("sag_name"),
        F.col("employee_bp_number").alias("bp_executive_number"),
        "next_contact_channel_name",
        "next_record_id",
        F.col("next_creation_datetime").alias("next_creation_dt"),
        "is_recontact_origin",
        "is_recontact_24_hrs",
        F.when(known, 1).otherwise(0).alias("is_traceable_contact"),
        F.when(known & (F.col("is_recontact_24_hrs") == 1), 1).otherwise(0).alias("is_traceable_recontact"),
        F.lit(0).alias("is_has_queue"),
    )


def entry_dates(hr: DataFrame, first_seen: DataFrame) -> DataFrame:
    """Per person and load: first known entry date so far, first load, first day in the mart.

    The entry date looks back only, so a person whose first loads lack it gets one row
    without and one with it.
    """
    by_load = Window.partitionBy("bp_num").orderBy(F.col("load_dt").asc_nulls_first())
    so_far = by_load.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    always = by_load.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Equal rows add nothing to either value, so they are removed before the window.
    rows = hr.select("bp_num", "load_dt", "entry_company_date").distinct()
    dated = rows.select(
        "bp_num",
        F.first("entry_company_date", ignorenulls=True).over(so_far).alias("entry"),
        F.first("load_dt").over(always).alias("first_load"),
    ).distinct()
    return joins.left_lookup(dated, first_seen, {"bp_num": "bp_num"})


def agent_tenure(hr_history: DataFrame, hr_daily: DataFrame, first_seen: DataFrame) -> DataFrame:
    """Entry date per person: HR date, else first day in the mart, else first load."""
    both = union_all(entry_dates(hr_history, first_seen), entry_dates(hr_daily, first_seen))
    return both.select(
        "bp_num", F.coalesce("entry", "first_seen", "first_load").alias("entry_company_date")
    ).distinct()


def tenure_rows(mart: DataFrame, tenure: DataFrame, as_of: date, after: date) -> DataFrame:
    """Human voice rows with the tenure of the agent of their first segment."""
    first = F.get("skill_lookup", F.lit(0))
    rows = filters.channel_report_rows(mart, "voz", after).select(
        "conversation_id",
        "call_date",
        F.get("factory_name", F.lit(0)).alias("fabrica"),
        (F.col("aht") / 60).alias("aht"),
        "fcr",
        rules.nps_by_number(F.col("nps")).alias("nps_indicator"),
        first["bp_executive_num"].try_cast("bigint").alias("bp"),
    )
    people = tenure.withColumn("bp_num_key", F.col("bp_num"))
    return joins.left_lookup(rows, people, {"bp": "bp_num_key"}).withColumn(
        "days", F.date_diff(F.lit(as_of), F.col("entry_company_date"))
    )


# Bucket edges of the two report versions: (edges, floor of the first bucket, unknown below it).
TENURE_V1 = ((30, 60, 90, 120, 150, 180), 1, True)
TENURE_V2 = ((30, 60, 90, 120, 150, 180, 210), 0, False)


def tenure_report(rows: DataFrame, version: tuple[tuple[int, ...], int, bool] = TENURE_V1) -> DataFrame:
    label = rules.tenure_label(F.col("days"), *version)

    def mean(name: str) -> Column:
        return F.round(F.avg(name), 2)

    return (
        rows.groupBy("fabrica", label.alias("antig_agent_days"))
        .agg(
            mean("aht").alias("aht_min"),
            mean("fcr").alias("fcr"),
            mean("nps_indicator").alias("nps"),
            F.count_distinct("conversation_id").alias("vol"),
            F.count_distinct("bp_num").alias("q_agent"),
            mean("days").alias("antiguedad_med"),
        )
        .orderBy("fabrica", "antig_agent_days")
    )


def chat_texts(dialogues: DataFrame) -> DataFrame:
    return dialogues.select(F.col("id").alias("conversation_id"), F.col("dialog").alias("text"))


def voice_texts(summaries: DataFrame) -> DataFrame:
    parts = [F.col(c) for c in ("agent_action_description", "call_reason", "resolution_status")]
    return summaries.select("conversation_id", rules.joined_text(*parts).alias("text"))


def dialog_sample(
    bots: DataFrame,
    texts: DataFrame,
    channel: str,
    process: tuple[str, ...],
    first: date,
    last: date,
    n: int = 300,
    seed: int | None = None,
    key: list[Column] | None = None,
) -> DataFrame:
    rows = filters.transferred_bot_texts(bots, texts, channel, process, first, last)
    return sampling.sample_n(rows, n, seed, key)


def mart_columns(mart: DataFrame, *names: str) -> DataFrame:
    return mart.select("conversation_id", *[F.col(c).alias(f"mart_{c}") for c in names])


def loaded_between(summaries: DataFrame, first: date, last: date) -> DataFrame:
    """Load time between two midnights, both included."""
    moment = F.col("load_datetime")
    return summaries.where((moment >= F.lit(first)) & (moment <= F.lit(last)))


def voice_label_rows(
    summaries: DataFrame,
    categories: DataFrame,
    mart: DataFrame,
    bots: DataFrame,
    transcriptions: DataFrame,
    category: str,
    second: tuple[str, ...],
    first_day: date,
    last_day: date,
    n: int = 300,
    seed: int | None = None,
    key: list[Column] | None = None,
) -> DataFrame:
    """n summaries of one category with indicators; rows multiply over categories, bots and texts."""
    chosen = mart_columns(mart, "call_date", "aht", "fcr", "nps", "category", "second_category", "is_hvc").where(
        (F.col("mart_category") == category)
        & F.col("mart_second_category").isin(*second)
        & (F.col("mart_is_hvc") == 0)
    )
    rows = loaded_between(summaries, first_day, last_day).join(chosen, "conversation_id")
    rows = joins.left_lookup(rows, categories.select("conversation_id"), CONVERSATION)
    rows = joins.left_lookup(rows, bots.select("conversation_id", "voicebot_category_process"), CONVERSATION)
    rows = joins.left_lookup(rows, transcriptions.select("conversation_id"), CONVERSATION)
    rows = rows.select(
        "conversation_id",
        F.col("mart_call_date").alias("call_date"),
        F.weekofyear("mart_call_date").alias("semana"),
        F.col("mart_aht").alias("aht"),
        F.col("mart_fcr").alias("fcr"),
        F.col("mart_nps").alias("nps"),
        "voicebot_category_process",
        rules.joined_text(
            F.col("agent_action_description"), F.col("call_reason"), F.col("resolution_status")
        ).alias("text"),
    )
    return sampling.sample_n(rows, n, seed, key)


def category_label_rows(
    summaries: DataFrame,
    categories: DataFrame,
    mart: DataFrame,
    category: str,
    first_day: date,
    last_day: date,
    n: int = 300,
    seed: int | None = None,
    key: list[Column] | None = None,
) -> DataFrame:
    """n summaries whose first analysed category is ``category``, with rounded indicators."""
    levels = ["first_category", "second_category", "third_category"]
    chosen = categories.where(F.col("first_category") == category).select("conversation_id", *levels)
    rows = loaded_between(summaries, first_day, last_day).join(chosen, "conversation_id")
    rows = joins.left_lookup(rows, mart_columns(mart, "call_date", "aht", "fcr", "nps"), CONVERSATION)
    blank = F.lit(" ")
    text = rules.joined_text(
        F.col("agent_action_description"), blank, F.col("call_reason"), F.col("resolution_status"), blank,
        F.col("first_comment_category"), blank, F.col("second_category_comment"), blank,
        F.col("third_category_comment"),
    )
    rows = rows.select(
        "conversation_id",
        F.col("mart_call_date").alias("call_date"),
        F.weekofyear("mart_call_date").alias("semana"),
        F.round("mart_aht", 0).alias("aht"),
        F.round("mart_fcr", 0).alias("fcr"),
        rules.nps_by_number(F.col("mart_nps")).alias("nps_indicator"),
        F.col("mart_nps").alias("nps"),
        *levels,
        text.alias("text"),
    )
    return sampling.sample_n(rows, n, seed, key)


def handle_time_by_month(performance: DataFrame, day: date) -> DataFrame:
    return aggregates.monthly(filters.year_to_date(performance, "effective_start_date_utc", day), "effective_start_date_utc")


def handle_time_by_week(performance: DataFrame, day: date) -> DataFrame:
    return aggregates.weekly(filters.recent_weeks(performance, "effective_start_date_utc", day), "effective_start_date_utc")
