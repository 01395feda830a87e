"""Filters and projections."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from contact_mart.checks.q_scans import _plain, _plain_sql
from contact_mart.checks.registry import Context, flat, register, segments_text
from contact_mart.checks.steps import AS_OF, MIN, SEGMENT_FIELDS
from contact_mart.checks.steps import segments_text as segments_sql
from contact_mart.functions import arrays, dates, rules
from contact_mart.operators import filters
from contact_mart.operators.joins import outer_parts
from contact_mart.plans import earlier, reports, results, segments

# ---- filters -------------------------------------------------------------------------

register(
    "segment_filter",
    lambda c: filters.filter_segments(c.src["segments"], c.p),
    f"SELECT {_plain_sql('segments')} FROM seg_kept",
)
register(
    "ticket_filter",
    lambda c: _plain(filters.filter_tickets(c.src["tickets"], c.p)),
    f"SELECT {_plain_sql('tickets')} FROM ticket_kept",
)
register(
    "bot_filter",
    lambda c: filters.filter_bots(c.src["bot_sessions"], c.p).select(
        "conversation_id",
        F.to_date("conversation_start_datetime").alias("call_date"),
        "market_code",
        "channel_type",
        F.col("category_voicebot_typification").alias("cat_bot"),
    ),
    "SELECT conversation_id, call_date, market_code, channel_type, cat_bot FROM bot_kept",
)
register(
    "half_open_load_filter",
    lambda c: _plain(filters.cut(c.src["text_categories"], "load_datetime", c.p.loads_from, c.p.as_of)),
    f"SELECT {_plain_sql('text_categories')} FROM in_text_categories WHERE load_datetime >= {MIN} AND load_datetime < {AS_OF}",
)


def complement(c: Context):
    """Both halves of a predicate over a column with NULLs, counted."""
    rows = c.src["segments"].select("conversation_id", F.col("message_type").alias("channel"))
    inside, outside = filters.split(rows, F.col("channel").isin("whatsapp", "webmessaging"))
    halves = [df.groupBy("channel").agg(F.count("*").alias("n")).withColumn("half", F.lit(h)) for h, df in
              (("in", inside), ("out", outside))]
    return halves[0].unionByName(halves[1])


register(
    "null_safe_complement",
    complement,
    """SELECT message_type AS channel, count(*) AS n,
       CASE WHEN coalesce(message_type IN ('whatsapp', 'webmessaging'), false) THEN 'in' ELSE 'out' END AS half
       FROM in_segments GROUP BY ALL""",
)
register(
    "purpose_filter",
    lambda c: _plain(c.src["participant_sessions"].where(F.col("purpose") == "agent")),
    f"SELECT {_plain_sql('participant_sessions')} FROM in_participant_sessions WHERE purpose = 'agent'",
)
register(
    "not_null_source_filters",
    lambda c: _plain(results.resolution_rows(c.src, c.p)),
    f"SELECT {_plain_sql('voice_resolution')} FROM res_all",
)


def _small_mart(c: Context):
    """Segments with canal and origin, as a light stand-in for the mart's columns."""
    return c.src["segments"].select(
        "conversation_id",
        F.col("conversation_date").alias("call_date"),
        F.lit("HUMAN").alias("is_human"),
        rules.canal_of(F.col("message_type"), F.lit("HUMAN")).alias("canal"),
        "agent_id",
    )


register(
    "channel_report_filter",
    lambda c: filters.channel_report_rows(_small_mart(c), "voz", c.p.cutover, date(2000, 12, 31)),
    """SELECT conversation_id, conversation_date AS call_date, 'HUMAN' AS is_human, 'voz' AS canal, agent_id FROM in_segments
       WHERE coalesce(message_type, 'voice') = 'voice' AND conversation_date > DATE '1999-01-01' AND conversation_date <= DATE '2000-12-31'""",
)
register(
    "current_year_weeks",
    lambda c: filters.recent_weeks(c.src["queue_performance"], "effective_start_date_utc", c.p.as_of),
    """SELECT effective_start_date_utc, handletime_seconds, handle_qty FROM in_queue_performance
       WHERE year(effective_start_date_utc) = 2001
         AND (dayofyear(effective_start_date_utc) + 6 - dayofweek(effective_start_date_utc)) // 7
             BETWEEN (dayofyear(DATE '2001-06-15') + 6 - dayofweek(DATE '2001-06-15')) // 7 - 4
                 AND (dayofyear(DATE '2001-06-15') + 6 - dayofweek(DATE '2001-06-15')) // 7""",
)
PROCESS = ("SEAT_ASSIGNMENT_PROBLEM", "CHECK_IN_ERROR")
FIRST, LAST = date(1995, 3, 1), date(1999, 12, 31)
register(
    "existence_filters",
    lambda c: filters.transferred_bot_texts(
        c.src["bot_sessions"], reports.chat_texts(c.src["dialogues"]), "message", PROCESS, FIRST, LAST
    ),
    """SELECT b.conversation_id, d.dialog AS text FROM in_bot_sessions b LEFT JOIN in_dialogues d ON d.id = b.conversation_id
       WHERE CAST(conversation_start_datetime AS DATE) BETWEEN DATE '1995-03-01' AND DATE '1999-12-31'
         AND originating_direction_type = 'inbound' AND channel_type = 'message'
         AND voicebot_category_process IN ('SEAT_ASSIGNMENT_PROBLEM', 'CHECK_IN_ERROR')
         AND d.dialog IS NOT NULL AND bp_agent_transferred_bot IS NOT NULL""",
)

# ---- projections ---------------------------------------------------------------------

register(
    "aht_sum",
    lambda c: c.src["segments"].select(
        "conversation_id",
        "agent_id",
        rules.handling_time(
            F.col("talk_time_second"), F.col("held_time_second"), F.col("after_call_work_time_second")
        ).alias("aht"),
    ),
    """SELECT conversation_id, agent_id, talk_time_second + coalesce(held_time_second, 0) + coalesce(after_call_work_time_second, 0) AS aht
       FROM in_segments""",
)
register(
    "singleton_wrap",
    lambda c: c.src["segments"].select(
        "conversation_id",
        F.size(arrays.singleton(F.col("queue_name"))).alias("always_one"),
        F.size(arrays.singleton(F.col("agent_id"), empty_on_null=True)).alias("none_or_one"),
        F.get(arrays.singleton(F.col("agent_id"), empty_on_null=True), F.lit(0)).alias("element"),
    ),
    """SELECT conversation_id, 1 AS always_one, CASE WHEN agent_id IS NULL THEN 0 ELSE 1 END AS none_or_one, agent_id AS element
       FROM in_segments""",
)
register(
    "struct_pack",
    lambda c: segments.pack_segment(c.segments).select(
        "conversation_id", segments_text("skill_lookup").alias("skill_lookup")
    ),
    f"""SELECT conversation_id, {segments_sql('skill_lookup')} AS skill_lookup
        FROM (SELECT conversation_id, [struct_pack({', '.join(f'{f} := {f}' for f in SEGMENT_FIELDS)})] AS skill_lookup FROM seg_rich)""",
)
register(
    "except_columns",
    lambda c: c.src["queue_dictionary"].drop("Script", "ID_Script"),
    "SELECT * EXCLUDE (Script, ID_Script) FROM in_queue_dictionary",
)
register(
    "select_distinct_rows",
    lambda c: flat(
        c.segments.select("call_date", F.array("factory_name").alias("factory_name"), "message_type").distinct()
    ),
    "SELECT DISTINCT call_date, factory_name, message_type FROM seg_one",
)
register(
    "case_normalise",
    lambda c: c.src["staff_snapshots"]
    .select("agent_id", F.lower("agent_email").alias("text"))
    .unionByName(c.src["queue_country"].select(F.trim("sagg").alias("agent_id"), F.upper("country").alias("text"))),
    """SELECT agent_id, lower(agent_email) AS text FROM in_staff_snapshots
       UNION ALL SELECT trim(sagg), upper(country) FROM in_queue_country""",
)
register(
    "label_language_zone",
    lambda c: c.src["tickets"].select(
        "ticket_id", rules.zone_of_language(F.col("language_name")).alias("zone")
    ).unionByName(
        c.src["demand_daily"].select(F.col("channel").alias("ticket_id"), rules.zone_of_country(F.col("country")).alias("zone"))
    ),
    """SELECT ticket_id, CASE WHEN language_name LIKE 'PT%' THEN 'BR' ELSE 'SSC' END AS zone FROM in_tickets
       UNION ALL SELECT channel, CASE WHEN upper(country) = 'BR' THEN 'BR' ELSE 'SSC' END FROM in_demand_daily""",
)


def market_rows(c: Context):
    rows = c.src["bot_sessions"].select(
        "conversation_id",
        "market_code",
        "channel_type",
        F.array(F.concat(F.lit("Q_"), F.length("conversation_id"))).alias("skill_name"),
    )
    return segments.resolve_market(rows, c.src["queue_country"]).drop("skill_name")


register(
    "resolve_market",
    market_rows,
    """SELECT conversation_id, coalesce(market_code, upper(country), 'SSC') AS market_code, coalesce(channel_type, 'voice') AS channel_type,
              CASE WHEN market_code = 'BR' THEN 'BR' WHEN market_code IS NULL AND country IS NOT NULL THEN upper(country) ELSE 'SSC' END AS mercado
       FROM in_bot_sessions LEFT JOIN in_queue_country ON sagg = 'Q_' || length(conversation_id)""",
)


def canals(c: Context):
    key = F.col("o_orderkey")
    channel = F.when(key % 9 == 0, "CC").when(key % 9 == 1, "cases").when(key % 9 == 2, "CASES").when(
        key % 9 == 3, "bot_wsp").when(key % 9 == 4, "voice").when(key % 9 == 5, "open").when(
        key % 9 == 6, "webmessaging").when(key % 9 == 7, "email")
    human = F.when(key % 4 == 0, "HUMAN").when(key % 4 == 1, "NOT_HUMAN").when(key % 4 == 2, "BOTH")
    return c.table("orders").select(
        key,
        rules.canal_of(channel, human).alias("canal"),
        earlier.canal_of(channel, human).alias("earlier_canal"),
    )


register(
    "channel_to_canal",
    canals,
    """SELECT o_orderkey,
        CASE o_orderkey % 9 WHEN 0 THEN CASE WHEN o_orderkey % 4 < 3 THEN 'voz' END WHEN 1 THEN 'cases' WHEN 2 THEN 'cases' WHEN 3 THEN 'wsp'
             WHEN 4 THEN 'voz' WHEN 5 THEN 'wsp' WHEN 6 THEN 'chat' WHEN 8 THEN 'voz' END AS canal,
        CASE o_orderkey % 9 WHEN 0 THEN CASE WHEN o_orderkey % 4 < 3 THEN 'voz' END WHEN 2 THEN 'cases' WHEN 3 THEN 'wsp'
             WHEN 4 THEN 'voz' WHEN 5 THEN 'wsp' WHEN 6 THEN 'chat' WHEN 8 THEN 'voz' END AS earlier_canal
       FROM orders""",
)


def _sides(c: Context):
    """Segments and bots of a conversation, one row per side and id."""
    human = c.src["segments"].select(F.col("conversation_id").alias("human_id"), "conversation_date", "message_type").distinct()
    bots = c.src["bot_sessions"].select(
        F.col("conversation_id").alias("bot_id"),
        F.to_date("conversation_start_datetime").alias("bot_date"),
        "market_code",
        "channel_type",
    )
    return human, bots


_SIDES_SQL = """
(SELECT DISTINCT conversation_id AS human_id, conversation_date, message_type FROM in_segments) h
FULL JOIN (SELECT conversation_id AS bot_id, CAST(conversation_start_datetime AS DATE) AS bot_date, market_code, channel_type FROM in_bot_sessions) b
ON h.human_id = b.bot_id"""


def origins(c: Context):
    human, bots = _sides(c)
    return outer_parts(human, bots, "human_id", "bot_id").select(
        "human_id", "bot_id", rules.origin(F.col("human_id"), F.col("bot_id")).alias("is_human")
    )


register(
    "classify_origin",
    origins,
    f"""SELECT human_id, bot_id, CASE WHEN human_id IS NULL THEN 'NOT_HUMAN' WHEN bot_id IS NULL THEN 'HUMAN' ELSE 'BOTH' END AS is_human
        FROM {_SIDES_SQL}""",
)


def coalesced(c: Context):
    human, bots = _sides(c)
    return outer_parts(human, bots, "human_id", "bot_id").select(
        F.coalesce("human_id", "bot_id").alias("conversation_id"),
        F.coalesce("conversation_date", "bot_date").alias("call_date"),
        F.col("market_code").cast("string").alias("market_code"),
        F.coalesce("message_type", "channel_type").alias("channel_type"),
    )


register(
    "coalesced_channel_columns",
    coalesced,
    f"""SELECT coalesce(human_id, bot_id) AS conversation_id, coalesce(conversation_date, bot_date) AS call_date, market_code,
               coalesce(message_type, channel_type) AS channel_type FROM {_SIDES_SQL}""",
)
register(
    "entry_date_coalesce",
    lambda c: c.src["hr_history"].select(
        "bp_num",
        "load_dt",
        F.coalesce("entry_company_date", F.when(F.col("bp_num") % 2 == 0, F.lit(c.p.min_date)), "load_dt").alias("entry"),
        (F.col("bp_num") / 60).alias("minutes"),
    ),
    """SELECT bp_num, load_dt, coalesce(entry_company_date, CASE WHEN bp_num % 2 = 0 THEN DATE '1995-02-01' END, load_dt) AS entry,
              bp_num / 60 AS minutes FROM in_hr_history""",
)
register(
    "text_concat",
    lambda c: reports.voice_texts(c.src["summaries"]),
    "SELECT conversation_id, agent_action_description || call_reason || resolution_status AS text FROM in_summaries",
)
register(
    "traceability_flags",
    lambda c: reports.recontact_view(c.src["recontact"]).select(
        "record_id", "customer_id", "is_traceable_contact", "is_traceable_recontact", "is_has_queue"
    ),
    """SELECT record_id, TRY_CAST(customer_id AS BIGINT) AS customer_id,
              CASE WHEN coalesce(customer_phone, customer_id, entity_id) IS NULL THEN 0 ELSE 1 END AS is_traceable_contact,
              CASE WHEN coalesce(customer_phone, customer_id, entity_id) IS NOT NULL AND is_recontact_24_hrs = 1 THEN 1 ELSE 0 END AS is_traceable_recontact,
              0 AS is_has_queue FROM in_recontact""",
)
register(
    "scalar_functions",
    lambda c: c.table("orders").select(
        "o_orderkey",
        F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("none")).alias("priority"),
        F.try_divide(F.col("o_custkey"), F.col("o_orderkey") % 3).alias("quotient"),
        F.abs(F.round(F.col("o_totalprice") - 150000, 2)).alias("distance"),
        F.upper(F.trim(F.concat(F.lit(" x"), "o_orderstatus"))).alias("status"),
        dates.month_text(F.col("o_orderdate")).alias("month"),
        dates.period_of(F.col("o_orderdate")).alias("period"),
        F.to_date(dates.period_of(F.col("o_orderdate")).cast("string"), "yyyyMM").alias("period_start"),
        F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("year_start"),
        F.trunc("o_orderdate", "MM").alias("month_start"),
        dates.month_gap(dates.period_of(F.col("o_orderdate")), F.lit(199812)).alias("months_away"),
        F.date_diff(F.lit(c.p.as_of), F.to_date("o_orderdate")).alias("days_away"),
        dates.sunday_week(F.col("o_orderdate")).alias("sunday_week"),
        F.weekofyear("o_orderdate").alias("iso_week"),
        F.get(F.array("o_orderstatus"), (F.col("o_orderkey") % 2).cast("int")).alias("element"),
        F.col("o_orderpriority").try_cast("int").alias("number"),
    ),
    """SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS priority,
              o_custkey / nullif(o_orderkey % 3, 0) AS quotient, abs(round(o_totalprice - 150000, 2)) AS distance,
              upper(trim(' x' || o_orderstatus)) AS status, strftime(o_orderdate, '%Y-%m') AS month,
              CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS period, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start,
              make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS year_start, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
              CAST(abs(date_diff('month', o_orderdate, DATE '1998-12-01')) AS INTEGER) AS months_away,
              CAST(date_diff('day', o_orderdate, TIMESTAMP '2001-06-15') AS INTEGER) AS days_away,
              CAST((dayofyear(o_orderdate) + 6 - dayofweek(o_orderdate)) // 7 AS INTEGER) AS sunday_week,
              CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS element,
              TRY_CAST(o_orderpriority AS INTEGER) AS number FROM orders""",
)
