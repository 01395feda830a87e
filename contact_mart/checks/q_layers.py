"""Business operators, layers and reports."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from contact_mart.checks.q_joins import ORDER_SHARE_SQL, WEIGHTED_ORDERS_SQL, _main, weighted_orders
from contact_mart.checks.q_rows import FIRST, LAST, PROCESS
from contact_mart.checks.registry import ORACLES, Context, agents_text, flat, register, rounded
from contact_mart.checks.steps import agents_text as agents_sql
from contact_mart.checks.steps import bare
from contact_mart.checks.steps import names_text as names_sql
from contact_mart.checks.steps import segments_text as segments_sql
from contact_mart.functions import rules
from contact_mart.operators import aggregates, lookups, scaling
from contact_mart.plans import conversations, reports, results, segments

def event_spans(c: Context):
    """Events in groups of four as conversations, three events to a month over a hundred years."""
    months = F.floor(F.col("event_id") / 3) % 1200
    return conversations.month_spans(
        c.table("events").select(
            F.floor(F.col("event_id") / 4).cast("string").alias("conversation_id"),
            F.add_months(F.lit(date(1990, 1, 1)), months.cast("int")).alias("call_date"),
            F.lit("whatsapp").alias("channel_type"),
            F.lit("HUMAN").alias("is_human"),
        )
    )


register(
    "uncrossed_month_starts",
    lambda c: conversations.uncrossed_months(
        event_spans(c), c.table("orders").select(F.trunc("o_orderdate", "MM").alias("start")).distinct()
    ),
    """WITH s AS (SELECT min(d) AS a, max(d) AS b FROM (SELECT event_id // 4 AS k, CAST(DATE '1990-01-01' + to_months(CAST((event_id // 3) % 1200 AS INTEGER)) AS DATE) AS d FROM events) GROUP BY k),
            t AS (SELECT a, max(b) AS b FROM s GROUP BY a),
            m AS (SELECT a AS start FROM t UNION SELECT CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders)
       SELECT start FROM m WHERE NOT EXISTS (SELECT 1 FROM t WHERE a < start AND b >= start)""",
)

# ---- first layer ---------------------------------------------------------------------

register("segments_enriched", lambda c: c.segments, "SELECT * FROM seg_rich")


def candidates(c: Context):
    best = c.best_categories
    return best.join(aggregates.agents_per_conversation(c.categories), "conversation_id").select(
        "conversation_id", "agent_id", *segments.LEVELS, agents_text("all_agents").alias("all_agents")
    )


register(
    "category_candidates",
    candidates,
    f"""SELECT b.conversation_id, agent_id, first_category, second_category, third_category, {agents_sql('all_agents')} AS all_agents
        FROM cat_best b JOIN cat_list l ON l.conversation_id = b.conversation_id""",
)
register(
    "segments_categorised",
    lambda c: flat(segments.segments_categorised(c.segments, c.best_categories)),
    f"""SELECT conversation_id, call_date, {names_sql('skill_name')} AS skill_name, {names_sql('factory_name')} AS factory_name, market_code,
               message_type, {segments_sql('skill_lookup')} AS skill_lookup, sag_name, first_category, second_category, third_category FROM seg_cat""",
)


def resolved(c: Context):
    return segments.tickets_resolved(c.src, c.p).withColumn("created_dt", F.date_format("created_dt", "yyyy-MM-dd HH:mm:ss"))


register(
    "tickets_resolved",
    resolved,
    """SELECT ticket_id, strftime(created_dt, '%Y-%m-%d %H:%M:%S') AS created_dt, agent_group_name, factory_name, language_name,
              claim_ai_typification, claim_ai_subtypification, agent_bp_number, agent_id, agent_email FROM ticket_rich""",
)
register(
    "calls_and_bots",
    lambda c: segments.calls_and_bots(
        segments.segments_categorised(c.segments, c.best_categories), c.bots
    ).drop("skill_name", "factory_name", "skill_lookup"),
    """SELECT conversation_id, call_date, market_code, channel_type, cat_bot, is_human, sag_name, cat_pca, second_category, third_category FROM calls""",
)

_NESTED = f"""{names_sql('skill_name')} AS skill_name, {names_sql('factory_name')} AS factory_name,
    {segments_sql('skill_lookup')} AS skill_lookup, {agents_sql('all_agents')} AS all_agents"""
register(
    "calculated_layer",
    lambda c: flat(c.calculated),
    f"""SELECT conversation_id, call_date, market_code, channel_type, cat_bot, is_human, cat_pca, second_category, third_category, agent_email,
               sag_name, mercado, {_NESTED} FROM cal""",
)
register(
    "intermedia_layer",
    lambda c: flat(c.intermedia_once),
    f"""SELECT conversation_id, call_date, market_code, channel_type, cat_bot, is_human, cat_pca, second_category, third_category,
               sag_name, mercado, {_NESTED} FROM inter""",
)

# ---- third layer ---------------------------------------------------------------------

register(
    "demand_long",
    lambda c: scaling.demand(c.src["demand_wide"], c.src["demand_daily"], c.p),
    "SELECT mes, canal, zona, is_human, valor FROM dem",
)
_MAIN = ("conversation_id", "agent_id", "agent_bp", "agent_aht", "call_date", "market_code", "channel_type", "cat_bot", "is_human",
         "cat_pca", "second_category", "third_category", "sag_name", "canal", "zona")
register("main_table", lambda c: _main(c).select(*_MAIN), f"SELECT {', '.join(_MAIN)} FROM mt")


def cascaded(c: Context):
    rows = results.cascade(
        _main(c).drop("skill_name", "factory_name", "skill_lookup", "all_agents"),
        results.chat_tips(c.src),
        results.ticket_levels(c.src, c.p),
    )
    return rows.select("conversation_id", "call_date", "canal", "agent_id", "category", "second_category", "third_category", "kept_bot_category")


register(
    "category_cascade",
    cascaded,
    "SELECT conversation_id, call_date, canal, agent_id, category, second_category, third_category, kept_bot_category FROM casc",
)


def homologated(c: Context):
    rows = c.categories.select("conversation_id", F.col("first_category").alias("raw"))
    return lookups.homologate(rows, "raw", "category")


register(
    "category_homologation",
    homologated,
    """SELECT conversation_id, first_category AS raw, CASE first_category WHEN 'MASCOTAS' THEN 'SERVICIOS_ESPECIALES' WHEN 'SIN_CONTEXTO' THEN 'OTROS'
              WHEN 'UPG' THEN 'CANJE' WHEN 'ENDOSO' THEN 'CAMBIO_VOLUNTARIO' WHEN 'FFP' THEN 'OTROS_FFP' WHEN 'VENTAS' THEN 'VENTAS'
              WHEN 'CHECK_IN' THEN 'CHECK_IN' ELSE 'NOT_CATEGORIZED' END AS category FROM cat_all""",
)
register(
    "country_homologation",
    lambda c: lookups.with_country(c.src["bot_sessions"].select("conversation_id", "market_code")),
    """SELECT conversation_id, market_code, CASE market_code WHEN 'PT' THEN 'BR' WHEN 'CHILE' THEN 'CL' WHEN 'UK' THEN 'GB' WHEN 'BR' THEN 'BR'
              WHEN 'CL' THEN 'CL' WHEN 'AR' THEN 'AR' WHEN 'PE' THEN 'PE' WHEN 'CO' THEN 'CO' ELSE 'OT' END AS country_code FROM in_bot_sessions""",
)
register(
    "effective_aht",
    lambda c: c.table("orders").select(
        "o_orderkey",
        rules.effective_time(
            F.when(F.col("o_orderstatus") == "P", "voz").when(F.col("o_orderstatus") == "F", "chat"),
            F.col("o_totalprice"),
            (F.col("o_orderkey") % 4).cast("double"),
        ).alias("aht"),
    ),
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE o_totalprice / nullif(CAST(o_orderkey % 4 AS DOUBLE), 0) END AS aht FROM orders""",
)


def fcr_rows(c: Context):
    """Resolution texts of whatsapp and chat per conversation, every third as a ticket."""
    talk = c.src["whatsapp_resolution"].select("conversation_id", F.col("is_first_call_resolution").alias("talk"), "participant_id")
    chat = results.chat_outcomes(c.src).withColumnRenamed("conversation_id", "_k")
    canal = F.when(F.length("conversation_id") % 3 == 0, "cases").otherwise("wsp")
    return talk.join(chat, F.col("conversation_id") == F.col("_k"), "left").select(
        "conversation_id", "participant_id", rules.fcr_flag(canal, F.col("talk"), F.col("talk"), F.col("fcr_ai")).alias("fcr")
    )


register(
    "fcr_flag",
    fcr_rows,
    f"""SELECT r.conversation_id, participant_id, CAST(CASE WHEN {bare('is_first_call_resolution')} = 'true' THEN 1 WHEN {bare('is_first_call_resolution')} = 'false' THEN 0
              WHEN length(r.conversation_id) % 3 = 0 THEN NULL WHEN {bare('fcr_ai')} = 'resuelve' THEN 1
              WHEN fcr_ai IS NULL OR fcr_ai = 'other' THEN NULL ELSE 0 END AS INTEGER) AS fcr
       FROM in_whatsapp_resolution r LEFT JOIN (SELECT DISTINCT conversationid, fcr_ai FROM in_chat_indicators) i ON i.conversationid = r.conversation_id""",
)
register(
    "quality_score",
    lambda c: c.src["compliance"].select(
        "conversation_id", "participant_id", rules.quality_score([F.col(w) for w in rules.COMPLIANCE_WEIGHTS]).alias("nota_calidad")
    ),
    f"""SELECT conversation_id, participant_id, {' + '.join(f'coalesce({w}, 0)' for w in rules.COMPLIANCE_WEIGHTS)} AS nota_calidad FROM in_compliance""",
)


def summary(c: Context):
    return results.agents_summary(
        results.session_agents(c.src["participant_sessions"], c.src["staff_snapshots"], c.src["agent_names"])
    )


register(
    "agents_summary",
    summary,
    """SELECT conversation_id, all_agent_bp_numbers, all_supervisor_bp_numbers, last_agent_bp_number, last_agent_name, last_supervisor_bp_number
       FROM agents_agg""",
)
_RICH = ("conversation_id", "agent_id", "call_date", "canal", "is_human", "category", "country_code", "aht", "nps", "fcr", "reason_resolution_fcr",
         "nota_calidad", "last_agent_bp_number", "last_agent_name", "last_supervisor_bp_number", "all_agent_bp_numbers", "all_supervisor_bp_numbers",
         "is_hvc", "is_recontact")


def enriched(c: Context):
    return rounded(results.given_back(results.final_rows(c.intermedia, c.src, c.p, c.ws)).select(*_RICH), "aht")


register(
    "kpi_enrichment",
    enriched,
    f"SELECT {', '.join(_RICH).replace('aht,', 'round(aht, 6) AS aht,')} FROM rich",
)
_PLUS_SQL = f"""SELECT r.* EXCLUDE (kept_bot_category), round(CASE WHEN factor = 0 THEN 0.0
    WHEN is_human = 'HUMAN' AND (r.canal <> 'cases' OR r.call_date >= DATE '1999-01-01') AND category <> 'NOT_CATEGORIZED' AND fac_cat > 0
        THEN factor / (fac_cat / factor_sum)
    WHEN category = 'NOT_CATEGORIZED' THEN CASE WHEN r.canal = 'cases' AND r.call_date < DATE '1999-01-01' THEN factor ELSE 0 END
    WHEN is_human = 'NOT_HUMAN' THEN 1 ELSE factor END, 6) AS factor_plus
    FROM {WEIGHTED_ORDERS_SQL} r LEFT JOIN {ORDER_SHARE_SQL} s ON s.call_date = r.call_date AND s.canal = r.canal AND s.market_code = r.market_code"""


def plus(c: Context):
    rows = weighted_orders(c)
    return rounded(scaling.factor_plus(rows, scaling.category_share(rows, c.p), c.p), "factor_plus").drop("kept_bot_category")


register("factor_plus", plus, _PLUS_SQL)


def kept(c: Context):
    p = replace(c.p, kept_bot=True)
    rows = weighted_orders(c)
    return rounded(scaling.factor_plus(rows, scaling.category_share(rows, p), p), "factor_plus")


register(
    "kept_bot_flag",
    kept,
    _PLUS_SQL.replace(" EXCLUDE (kept_bot_category)", "")
    .replace("WHEN factor = 0 THEN 0.0", "WHEN factor = 0 OR (kept_bot_category AND is_human = 'HUMAN') THEN 0.0")
    .replace("FILTER (category <> 'NOT_CATEGORIZED')", "FILTER (category <> 'NOT_CATEGORIZED' AND NOT kept_bot_category)"),
)


def nulled(c: Context):
    rows = _main(c).select(
        "conversation_id", "call_date", "canal", "is_human", "agent_id",
        F.coalesce("cat_pca", F.lit(rules.NOT_CATEGORIZED)).alias("category"),
        F.when(F.col("agent_bp") % 3 > 0, (F.col("agent_bp") % 2).cast("int")).alias("fcr"),
        F.col("agent_aht").alias("nota_calidad"),
    )
    return results.null_out_kpis(rows, c.p)


register(
    "null_kpi_rule",
    nulled,
    """SELECT conversation_id, call_date, canal, is_human, agent_id, category, CASE WHEN lost THEN NULL ELSE fcr END AS fcr,
              CASE WHEN lost AND fcr IS NOT NULL THEN NULL ELSE agent_aht END AS nota_calidad
       FROM (SELECT *, coalesce(cat_pca, 'NOT_CATEGORIZED') AS category, CAST(CASE WHEN agent_bp % 3 > 0 THEN agent_bp % 2 END AS INTEGER) AS fcr,
                    coalesce(is_human = 'HUMAN' AND canal = 'voz' AND cat_pca IS NULL AND call_date > DATE '1999-01-01', false) AS lost FROM mt)""",
)
_THIRD = ("conversation_id", "agent_id", "agent_bp", "agent_aht", "call_date", "skill_name", "factory_name", "market_code", "channel_type", "is_human",
          "skill_lookup", "all_agents", "sag_name", "canal", "zona", "factor", "second_category", "third_category", "category", "country_code", "aht",
          "nps", "factor_pca", "reason_resolution_fcr", "last_agent_bp_number", "last_agent_name", "last_supervisor_bp_number", "all_agent_bp_numbers",
          "all_supervisor_bp_numbers", "is_hvc", "is_recontact", "factor_plus", "fcr", "nota_calidad")
_FRACTIONS = ("factor", "aht", "factor_pca", "factor_plus")
_THIRD_SQL = {
    "skill_name": names_sql("skill_name"), "factory_name": names_sql("factory_name"), "skill_lookup": segments_sql("skill_lookup"),
    "all_agents": agents_sql("all_agents"), **{c: f"round({c}, 6)" for c in _FRACTIONS},
}
register(
    "third_layer",
    lambda c: rounded(flat(c.third), *_FRACTIONS),
    f"SELECT {', '.join(f'{_THIRD_SQL[c]} AS {c}' if c in _THIRD_SQL else c for c in _THIRD)} FROM mart",
)


def third_kept_bot(c: Context):
    third = results.build_third(c.intermedia, c.src, replace(c.p, kept_bot=True), c.ws)
    return rounded(flat(third), *_FRACTIONS)


register("third_layer_kept_bot", third_kept_bot, None)
ORACLES["third_layer_kept_bot"] = (
    ORACLES["third_layer"]
    .replace("FILTER (category <> 'NOT_CATEGORIZED')", "FILTER (category <> 'NOT_CATEGORIZED' AND NOT kept_bot_category)")
    .replace("CASE WHEN coalesce(factor, 0) = 0 THEN 0.0", "CASE WHEN coalesce(factor, 0) = 0 OR (kept_bot_category AND is_human = 'HUMAN') THEN 0.0")
    .replace("DISTINCT * EXCLUDE (lost, kept_bot_category)", "DISTINCT * EXCLUDE (lost)")
)
# The last FROM is that of the result.
ORACLES["third_layer_kept_bot"] = ", kept_bot_category FROM mart".join(ORACLES["third_layer_kept_bot"].rsplit(" FROM mart", 1))

# ---- reports -------------------------------------------------------------------------

register(
    "kpi_by_month",
    lambda c: rounded(reports.voice_kpis(c.third, date(1999, 1, 1), date(2001, 12, 31)), "voz", "nps"),
    """SELECT is_human, CAST(month(call_date) AS INTEGER) AS mes, round(sum(factor), 6) AS voz,
              round(avg(CASE WHEN nps IN ('9', '10') THEN 100 WHEN nps IN ('0', '1', '2', '3', '4', '5', '6') THEN -100 WHEN nps IS NOT NULL THEN 0 END), 6) AS nps
       FROM mart WHERE canal = 'voz' AND call_date BETWEEN DATE '1999-01-01' AND DATE '2001-12-31' GROUP BY ALL""",
)


def recontact(c: Context):
    stamps = ("creation_dt", "next_creation_dt")
    return reports.recontact_view(c.src["recontact"]).withColumns(
        {x: F.date_format(x, "yyyy-MM-dd HH:mm:ss") for x in stamps}
    )


register(
    "recontact_view",
    recontact,
    """SELECT TRY_CAST(customer_id AS BIGINT) AS customer_id, entity_id, customer_phone, record_id, is_recontact_24_hrs AS is_recontact_24_hours,
              strftime(creation_datetime, '%Y-%m-%d %H:%M:%S') AS creation_dt, channel, contact_channel_name, factory_name,
              service_agent_group_name AS sag_name, employee_bp_number AS bp_executive_number, next_contact_channel_name, next_record_id,
              strftime(next_creation_datetime, '%Y-%m-%d %H:%M:%S') AS next_creation_dt, is_recontact_origin, is_recontact_24_hrs,
              CASE WHEN coalesce(customer_phone, customer_id, entity_id) IS NULL THEN 0 ELSE 1 END AS is_traceable_contact,
              CASE WHEN coalesce(customer_phone, customer_id, entity_id) IS NOT NULL AND is_recontact_24_hrs = 1 THEN 1 ELSE 0 END AS is_traceable_recontact,
              0 AS is_has_queue FROM in_recontact""",
)


def tenure(c: Context, mart):
    seen = c.ws.stage(aggregates.first_seen(mart), "first-seen")
    return reports.agent_tenure(c.src["hr_history"], c.src["hr_daily"], seen)


def _entries(table: str) -> str:
    return f"""SELECT h.bp_num, first_value(entry_company_date IGNORE NULLS) OVER (PARTITION BY h.bp_num ORDER BY load_dt) AS entry,
        min(load_dt) OVER (PARTITION BY h.bp_num) AS first_load, first_seen FROM {table} h LEFT JOIN
        (SELECT s.bp_executive_num AS bp_num, min(call_date) AS first_seen FROM (SELECT call_date, unnest(skill_lookup) AS s FROM inter)
         WHERE s.bp_executive_num IS NOT NULL GROUP BY ALL) f ON f.bp_num = h.bp_num"""


_TENURE = f"""(SELECT DISTINCT bp_num, coalesce(entry, first_seen, first_load) AS entry_company_date
    FROM ({_entries('in_hr_history')} UNION ALL {_entries('in_hr_daily')}))"""
register("agent_tenure", lambda c: tenure(c, c.intermedia_once), f"FROM {_TENURE}")


def tenure_table(c: Context, version):
    rows = reports.tenure_rows(c.third, tenure(c, c.intermedia), c.p.as_of, c.p.cutover)
    return reports.tenure_report(rows, version)


def _tenure_sql(label: str) -> str:
    return f"""SELECT fabrica, {label} AS antig_agent_days, round(avg(aht), 2) AS aht_min, round(avg(fcr), 2) AS fcr, round(avg(points), 2) AS nps,
        count(DISTINCT conversation_id) AS vol, count(DISTINCT bp_num) AS q_agent, round(avg(a), 2) AS antiguedad_med
        FROM (SELECT conversation_id, factory_name[1] AS fabrica, aht / 60 AS aht, fcr, t.bp_num, CAST(date_diff('day', entry_company_date, DATE '2001-06-15') AS INTEGER) AS a,
                     CASE WHEN TRY_CAST(nps AS INTEGER) >= 9 THEN 100 WHEN TRY_CAST(nps AS INTEGER) >= 7 THEN 0 WHEN TRY_CAST(nps AS INTEGER) >= 0 THEN -100 END AS points
              FROM mart m LEFT JOIN {_TENURE} t ON t.bp_num = m.skill_lookup[1].bp_executive_num
              WHERE canal = 'voz' AND is_human = 'HUMAN' AND call_date > DATE '1999-01-01') GROUP BY ALL"""


_V1 = "CASE WHEN a IS NULL OR a <= 1 THEN 'S/I' WHEN a <= 30 THEN 'a 0-30' WHEN a <= 60 THEN 'b 30-60' WHEN a <= 90 THEN 'c 60-90' WHEN a <= 120 THEN 'd 90-120' WHEN a <= 150 THEN 'e 120-150' WHEN a <= 180 THEN 'f 150-180' ELSE 'g >180' END"
_V2 = "CASE WHEN a IS NULL THEN 'S/I' WHEN a <= 30 AND a > 0 THEN 'a 0-30' WHEN a <= 60 THEN 'b 30-60' WHEN a <= 90 THEN 'c 60-90' WHEN a <= 120 THEN 'd 90-120' WHEN a <= 150 THEN 'e 120-150' WHEN a <= 180 THEN 'f 150-180' WHEN a <= 210 THEN 'g 180-210' ELSE 'h >210' END"
register("tenure_report", lambda c: tenure_table(c, reports.TENURE_V1), _tenure_sql(_V1))
register("tenure_report_v2", lambda c: tenure_table(c, reports.TENURE_V2), _tenure_sql(_V2))

# The order of a sample must be the same in both engines: length, then id, then text.
def _by_length() -> list:
    return [F.length("text").asc(), F.col("conversation_id").asc(), F.col("text").asc()]


def dialogs(c: Context):
    return reports.dialog_sample(
        c.src["bot_sessions"], reports.chat_texts(c.src["dialogues"]), "message", PROCESS, FIRST, LAST, 40, key=_by_length()
    )


register(
    "dialog_sample",
    dialogs,
    """SELECT b.conversation_id, d.dialog AS text FROM in_bot_sessions b JOIN in_dialogues d ON d.id = b.conversation_id
       WHERE conversation_start_datetime >= DATE '1995-03-01' AND conversation_start_datetime < DATE '2000-01-01' AND originating_direction_type = 'inbound'
         AND channel_type = 'message' AND voicebot_category_process IN ('SEAT_ASSIGNMENT_PROBLEM', 'CHECK_IN_ERROR')
         AND d.dialog IS NOT NULL AND bp_agent_transferred_bot IS NOT NULL
       ORDER BY length(d.dialog), b.conversation_id, d.dialog LIMIT 40""",
)
register(
    "dialog_sample_voice",
    lambda c: reports.dialog_sample(
        c.src["bot_sessions"], reports.voice_texts(c.src["summaries"]), "voice", PROCESS, FIRST, LAST, 20, key=_by_length()
    ),
    """SELECT b.conversation_id, text FROM in_bot_sessions b
       JOIN (SELECT conversation_id, agent_action_description || call_reason || resolution_status AS text FROM in_summaries) d ON d.conversation_id = b.conversation_id
       WHERE conversation_start_datetime >= DATE '1995-03-01' AND conversation_start_datetime < DATE '2000-01-01' AND originating_direction_type = 'inbound'
         AND channel_type = 'voice' AND voicebot_category_process IN ('SEAT_ASSIGNMENT_PROBLEM', 'CHECK_IN_ERROR')
         AND text IS NOT NULL AND bp_agent_transferred_bot IS NOT NULL
       ORDER BY length(text), b.conversation_id, text LIMIT 20""",
)


# An order over all columns: rows that tie in it are alike, so it does not matter which of them a sample takes.
def _by_all(*columns: str) -> list:
    return [(F.round(x, 6) if x == "aht" else F.col(x)).asc_nulls_first() for x in columns]


def _sample_sql(select: str, n: int) -> str:
    return f"SELECT * FROM ({select}) ORDER BY ALL ASC NULLS FIRST LIMIT {n}"


def labelled(c: Context):
    key = _by_all("conversation_id", "call_date", "semana", "aht", "fcr", "nps_indicator", "nps", *segments.LEVELS, "text")
    rows = reports.category_label_rows(
        c.src["summaries"], c.src["voice_categories"], c.third, "VENTAS", date(1995, 2, 1), date(2000, 6, 30), 60, key=key
    )
    return rounded(rows, "aht")


register(
    "labelled_sample",
    labelled,
    _sample_sql("""SELECT s.conversation_id, m.call_date, CAST(weekofyear(m.call_date) AS INTEGER) AS semana, round(m.aht, 0) AS aht, m.fcr,
              CASE WHEN TRY_CAST(nps AS INTEGER) >= 9 THEN 100 WHEN TRY_CAST(nps AS INTEGER) >= 7 THEN 0 WHEN TRY_CAST(nps AS INTEGER) >= 0 THEN -100 END AS nps_indicator,
              m.nps, c.first_category, c.second_category, c.third_category,
              agent_action_description || ' ' || call_reason || resolution_status || ' ' || first_comment_category || ' ' || second_category_comment || ' ' || third_category_comment AS text
       FROM in_summaries s JOIN in_voice_categories c ON c.conversation_id = s.conversation_id LEFT JOIN mart m ON m.conversation_id = s.conversation_id
       WHERE s.load_datetime BETWEEN TIMESTAMP '1995-02-01' AND TIMESTAMP '2000-06-30' AND c.first_category = 'VENTAS'""", 60),
)


def voice_labels(c: Context):
    key = _by_all("conversation_id", "call_date", "semana", "aht", "fcr", "nps", "voicebot_category_process", "text")
    rows = reports.voice_label_rows(
        c.src["summaries"], c.src["voice_categories"], c.third, c.src["bot_sessions"], c.src["bot_transcriptions"],
        "SERVICIOS_ESPECIALES", ("FRANQUICIA_EQUIPAJE", "INFO_VUELO"), date(1995, 2, 1), date(2000, 6, 30), 20, key=key,
    )
    return rounded(rows, "aht")


register(
    "labelled_sample_voice",
    voice_labels,
    _sample_sql("""SELECT s.conversation_id, m.call_date, CAST(weekofyear(m.call_date) AS INTEGER) AS semana, round(m.aht, 6) AS aht, m.fcr, m.nps,
              r.voicebot_category_process, agent_action_description || call_reason || resolution_status AS text
       FROM in_summaries s LEFT JOIN in_voice_categories c ON c.conversation_id = s.conversation_id LEFT JOIN mart m ON m.conversation_id = s.conversation_id
       LEFT JOIN in_bot_sessions r ON r.conversation_id = s.conversation_id LEFT JOIN in_bot_transcriptions b ON b.conversation_id = s.conversation_id
       WHERE s.load_datetime BETWEEN TIMESTAMP '1995-02-01' AND TIMESTAMP '2000-06-30' AND m.category = 'SERVICIOS_ESPECIALES'
         AND m.second_category IN ('FRANQUICIA_EQUIPAJE', 'INFO_VUELO') AND m.is_hvc = 0""", 20),
)
register(
    "aht_reports",
    lambda c: rounded(
        reports.handle_time_by_month(c.src["queue_performance"], c.p.as_of)
        .select(F.lit("month").alias("grain"), F.col("month_number").alias("number"), "average_handle_time")
        .unionByName(
            reports.handle_time_by_week(c.src["queue_performance"], c.p.as_of).select(
                F.lit("week").alias("grain"), F.col("week_number").alias("number"), "average_handle_time"
            )
        ),
        "average_handle_time",
    ),
    """SELECT 'month' AS grain, CAST(month(d) AS INTEGER) AS number, round(sum(t) / nullif(sum(q), 0), 6) AS average_handle_time FROM
       (SELECT effective_start_date_utc AS d, handletime_seconds AS t, handle_qty AS q FROM in_queue_performance WHERE year(effective_start_date_utc) = 2001) GROUP BY ALL
       UNION ALL
       SELECT 'week', CAST((dayofyear(d) + 6 - dayofweek(d)) // 7 AS INTEGER) AS number, round(sum(t) / nullif(sum(q), 0), 6) FROM
       (SELECT effective_start_date_utc AS d, handletime_seconds AS t, handle_qty AS q FROM in_queue_performance WHERE year(effective_start_date_utc) = 2001)
       WHERE (dayofyear(d) + 6 - dayofweek(d)) // 7 BETWEEN (166 + 6 - 5) // 7 - 4 AND (166 + 6 - 5) // 7 GROUP BY number""",
)
