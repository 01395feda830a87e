"""First layer: one row per handled segment, bot session or ticket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.functions import arrays, dates, rules
from contact_mart.operators import aggregates, filters, joins
from contact_mart.operators.dedup import best_queue_row, latest_hr_by_email, min_per_key, top1, up, user_of_participant
from contact_mart.operators.keysets import KeySet
from contact_mart.operators.reshape import union_all
from contact_mart.params import Params
from contact_mart.session import Workspace
from contact_mart.sources.catalog import Sources
from contact_mart.sources.schemas import CALCULATED, SEGMENT, conform

LEVELS = ["first_category", "second_category", "third_category"]


def market_by_conversation(bots: DataFrame, p: Params) -> DataFrame:
    """One market per conversation; here the current day is included."""
    recent = filters.cut(bots, "conversation_start_datetime", p.loads_from, filters.next_day(p.as_of))
    return min_per_key(recent, "conversation_id", "market_code")


def segments_with_market(src: Sources, p: Params) -> DataFrame:
    """Distinct filtered segments with the market of their conversation.

    Duplicates are removed on the narrow rows, before the lookups: they give at most one
    row per segment, so the result is the same and the exchange is smaller.
    """
    segments = (
        filters.filter_segments(src["segments"], p)
        .select(
            "conversation_id",
            F.col("conversation_date").alias("call_date"),
            F.col("queue_name").alias("skill_name"),
            "factory_name",
            rules.handling_time(
                F.col("talk_time_second"), F.col("held_time_second"), F.col("after_call_work_time_second")
            ).alias("aht"),
            "message_type",
            F.col("agent_bp_number").alias("bp_executive_num"),
            "agent_id",
            "sag_name",
        )
        .distinct()
    )
    markets = market_by_conversation(src["bot_sessions"], p)
    return joins.left_lookup(segments, markets, {"conversation_id": "conversation_id"})


def queue_attributes(src: Sources, ws: Workspace | None = None) -> DataFrame:
    """Attributes per trimmed queue name. With a workspace they are written, so that the planner knows how few they are."""
    queues = (
        best_queue_row(src["queue_dictionary"])
        .drop("Nombre_de_Cola")
        .withColumnRenamed("Fabrica", "Fabrica_dic")
    )
    return queues if ws is None else ws.stage(queues, "queues")


def with_queues(segments: DataFrame, queues: DataFrame) -> DataFrame:
    return joins.left_lookup_trimmed(segments, "skill_name", queues, "queue_key")


def segments_enriched(src: Sources, p: Params, ws: Workspace | None = None) -> DataFrame:
    """Distinct filtered segments with queue attributes and market."""
    described = with_queues(segments_with_market(src, p), queue_attributes(src, ws))
    return described.select(*[c for c in described.columns if c != "market_code"], "market_code")


def category_rows(src: Sources, p: Params, ws: Workspace | None = None) -> DataFrame:
    """Voice and text categories with the agent behind the participant.

    An incremental run looks at the sessions of the window's participants only."""
    raw = union_all(src["voice_categories"], src["text_categories"])
    loaded = filters.cut(raw, "load_datetime", p.loads_from, p.as_of)
    sessions = src["participant_sessions"]
    if ws is not None and p.start is not None:
        sessions = KeySet(loaded.select("participant_id"), ws, "window-participants").prune(sessions, "participant_id")
    users = user_of_participant(sessions)
    named = joins.left_lookup(loaded, users, {"participant_id": "participant_id"})
    return named.select("conversation_id", "agent_id", *LEVELS)


def best_category_per_agent(rows: DataFrame) -> DataFrame:
    """A specific category beats a generic one; then the order of the texts."""
    keys = ["conversation_id", F.coalesce("agent_id", F.lit("NULL_AGENT"))]
    return top1(rows, keys, [arrays.is_generic(F.col("first_category")).asc(), *up(*LEVELS, "agent_id")])


def pack_segment(df: DataFrame) -> DataFrame:
    """Wrap the segment's scalars into one-element arrays of the layer."""
    names = [item.split(":")[0] for item in SEGMENT[len("struct<") : -1].split(",")]
    return df.withColumn("skill_lookup", F.array(F.struct(*names)).cast(f"array<{SEGMENT}>"))


def segments_categorised(segments: DataFrame, best: DataFrame, queues: DataFrame | None = None) -> DataFrame:
    """Segments with categories, packed. ``queues``: attributes that the segments lack yet; the widest part comes
    last, so that it need not move to the conversation."""
    matched = joins.exact_or_fallback(segments, best, "conversation_id", "agent_id", LEVELS)
    if queues is not None:
        matched = with_queues(matched, queues)
    return pack_segment(matched).select(
        "conversation_id",
        "call_date",
        F.array("skill_name").alias("skill_name"),
        F.array("factory_name").alias("factory_name"),
        "market_code",
        "message_type",
        "skill_lookup",
        "sag_name",
        *LEVELS,
    )


def staff_of_tickets(tickets: DataFrame, staff: DataFrame) -> DataFrame:
    """Agent of each ticket from the staff snapshot of the nearest month, by e-mail."""
    dated = tickets.select(
        "ticket_id", F.lower("agent_email").alias("email"), dates.period_of(F.col("created_dt")).alias("month")
    )
    snapshots = staff.withColumn("email", F.lower("agent_email"))
    nearest = joins.nearest_snapshot(
        dated, snapshots, "email", "period_id", "load_datetime", ["agent_bp_number", "agent_id"]
    )
    found = joins.join_nearest(dated, nearest, "email", "inner")
    order = [
        F.col("gap").asc_nulls_first(),
        F.col("before").asc(),
        F.col("loaded").desc_nulls_last(),
        *up("agent_bp_number", "agent_id"),
    ]
    return top1(found, ["ticket_id"], order).select("ticket_id", "agent_bp_number", "agent_id")


def tickets_resolved(
    src: Sources, p: Params, overrides: DataFrame | None = None, ws: Workspace | None = None
) -> DataFrame:
    """Filtered tickets with the agent number: override list, nearest staff month, HR by e-mail.

    ``overrides`` has the columns ``agent_email`` and ``agent_bp_number``, one row per address.
    """
    kept = filters.filter_tickets(src["tickets"], p)
    # Ranked over all rows of a ticket, as one ticket id may have rows outside the filter; an incremental run
    # ranks the tickets of the window.
    ranked = src["tickets"]
    if ws is not None and p.start is not None:
        ranked = KeySet(kept.select("ticket_id"), ws, "window-tickets").prune(ranked, "ticket_id")
    staff = staff_of_tickets(ranked, src["staff_snapshots"])
    named = joins.left_lookup(
        kept, staff.withColumnRenamed("agent_bp_number", "staff_bp"), {"ticket_id": "ticket_id"}
    )
    hr = latest_hr_by_email(src["hr_history"]).withColumnRenamed("bp_num", "hr_bp")
    named = joins.left_lookup(
        named.withColumn("_email", F.lower("agent_email")), hr, {"_email": "employee_email"}
    )
    numbers = [F.col("staff_bp"), F.col("hr_bp")]
    if overrides is not None:
        fixed = overrides.select("agent_email", F.col("agent_bp_number").alias("fixed_bp"))
        named = joins.left_lookup(named, fixed, {"agent_email": "agent_email"})
        numbers.insert(0, F.col("fixed_bp"))
    return named.select(
        "ticket_id",
        "created_dt",
        "agent_group_name",
        "factory_name",
        rules.zone_of_language(F.col("language_name")).alias("language_name"),
        "claim_ai_typification",
        "claim_ai_subtypification",
        F.coalesce(*numbers).alias("agent_bp_number"),
        "agent_id",
        "agent_email",
    )


def collapse_tickets(tickets: DataFrame) -> DataFrame:
    """One row per ticket, agent number and e-mail."""
    created = F.col("created_dt")
    grouped = tickets.groupBy("ticket_id", "agent_bp_number", "agent_email").agg(
        F.to_date(F.min(created)).alias("call_date"),
        arrays.collect_distinct(F.col("agent_group_name")).alias("skill_name"),
        arrays.collect_distinct(F.coalesce("factory_name", F.lit("NO_FACTORY"))).alias("factory_name"),
        arrays.latest(F.col("language_name"), created).alias("market_code"),
        arrays.latest(F.col("claim_ai_typification"), created).alias("cat_bot"),
        arrays.latest(F.col("claim_ai_subtypification"), created).alias("cat_pca"),
        F.min("agent_id").alias("_agent"),
    )
    own = {"bp_executive_num": "agent_bp_number", "agent_id": "_agent"}
    fields = []
    for item in SEGMENT[len("struct<") : -1].split(","):
        name, kind = item.split(":")
        value = F.col(own[name]) if name in own else F.lit("cases" if name == "Canal_de_Atencion" else None)
        fields.append(value.cast(kind).alias(name))
    return grouped.select(
        F.col("ticket_id").alias("conversation_id"),
        "call_date",
        "skill_name",
        "factory_name",
        "market_code",
        F.lit("cases").alias("channel_type"),
        "cat_bot",
        F.lit("HUMAN").alias("is_human"),
        F.array(F.struct(*fields)).alias("skill_lookup"),
        "cat_pca",
        "agent_email",
    )


def bot_rows(src: Sources, p: Params) -> DataFrame:
    return filters.filter_bots(src["bot_sessions"], p).select(
        F.col("conversation_id").alias("interaction_id"),
        F.to_date("conversation_start_datetime").alias("bot_date"),
        F.col("market_code").alias("bot_market"),
        F.col("channel_type").alias("bot_channel"),
        F.col("category_voicebot_typification").alias("cat_bot"),
    )


def _with_bots(both: DataFrame) -> DataFrame:
    """Rows of the first layer from segments and the voice bot of their conversation."""
    return both.select(
        "conversation_id",
        F.coalesce("call_date", "bot_date").alias("call_date"),
        "skill_name",
        "factory_name",
        F.coalesce("market_code", "bot_market").alias("market_code"),
        F.coalesce("message_type", "bot_channel").alias("channel_type"),
        "cat_bot",
        rules.origin(F.col("conversation_id"), F.col("interaction_id")).alias("is_human"),
        "skill_lookup",
        "sag_name",
        F.col("first_category").alias("cat_pca"),
        "second_category",
        "third_category",
        *[c for c in both.columns if c == "all_agents"],
    )


def _bots_alone(bots: DataFrame, channel: Column) -> DataFrame:
    return bots.select(
        F.col("interaction_id").alias("conversation_id"),
        F.col("bot_date").alias("call_date"),
        F.col("bot_market").alias("market_code"),
        channel.alias("channel_type"),
        "cat_bot",
        F.lit("NOT_HUMAN").alias("is_human"),
    )


def merge_channels(segments: DataFrame, voice_bots: DataFrame) -> DataFrame:
    """Human segments and voice bots of the same conversation, both sides kept."""
    met, unmet = joins.outer_sides(segments, voice_bots, "conversation_id", "interaction_id")
    return union_all(_with_bots(met), _bots_alone(unmet, F.col("bot_channel")), fill=True)


def message_bots(bots: DataFrame) -> DataFrame:
    return _bots_alone(bots.where(F.col("bot_channel") == "message"), F.lit("bot_wsp"))


def calls_and_bots(segments: DataFrame, bots: DataFrame, agents: DataFrame | None = None) -> DataFrame:
    """Segments with the voice bots of their conversation, and the bots without segments.

    ``agents``: lists per conversation, attached to every row. The segments meet them and the bots
    under their own conversation, so that the wide rows need no exchange of their own.
    """
    voice = bots.where(F.col("bot_channel") == "voice")
    if agents is not None:
        segments = joins.left_lookup(segments, agents, {"conversation_id": "conversation_id"})
    met, unmet = joins.outer_sides(segments, voice, "conversation_id", "interaction_id")
    alone = union_all(_bots_alone(unmet, F.col("bot_channel")), message_bots(bots))
    if agents is not None:
        alone = joins.left_lookup(alone, agents, {"conversation_id": "conversation_id"})
    return union_all(_with_bots(met), alone, fill=True)


def resolve_market(rows: DataFrame, queue_country: DataFrame) -> DataFrame:
    """Market and zone, with the country of the row's first queue where no market is known."""
    countries = queue_country.select("sagg", F.col("country").alias("_country"))
    joined = joins.left_lookup(rows.withColumn("_queue", F.get("skill_name", F.lit(0))), countries, {"_queue": "sagg"})
    code, country = F.col("market_code"), F.col("_country")
    return (
        joined.withColumn("mercado", rules.market_zone(code, country))
        .withColumn("market_code", rules.market(code, country))
        .withColumn("channel_type", F.coalesce("channel_type", F.lit("voice")))
        .drop("_queue", "_country")
    )


def build_calculated(
    src: Sources, p: Params, overrides: DataFrame | None = None, ws: Workspace | None = None
) -> DataFrame:
    """The layer. With a workspace the category rows, which the best category and the agent lists both read, are
    computed once, and an incremental run prunes sources without a window column by the window's keys. What is
    small is written, so that the planner knows its size."""
    categories, countries = category_rows(src, p, ws), src["queue_country"]
    if ws is not None:
        categories, countries = ws.stage(categories, "categories"), ws.stage(countries, "queue-country")
    # One exchange serves the best categories and the lists, and both meet the segments where it leaves them.
    categories = categories.repartition("conversation_id")
    best = best_category_per_agent(categories)
    segments = segments_categorised(segments_with_market(src, p), best, queue_attributes(src, ws))
    calls = calls_and_bots(segments, bot_rows(src, p), aggregates.agents_per_conversation(categories))
    tickets = collapse_tickets(tickets_resolved(src, p, overrides, ws))
    rows = union_all(calls, tickets, fill=True)
    return conform(resolve_market(rows, countries), CALCULATED)
