"""Join forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from contact_mart.checks.registry import Context, register, rounded
from contact_mart.checks.steps import CUT_MONTH, bare, gap, ym
from contact_mart.functions import dates
from contact_mart.operators import aggregates, joins, scaling
from contact_mart.operators.dedup import best_queue_row
from contact_mart.operators.reconcile import reconcile
from contact_mart.operators.reshape import explode_segments
from contact_mart.plans import reports, results, segments

CONVERSATION = {"conversation_id": "conversation_id"}

register(
    "left_join_trimmed_key",
    lambda c: joins.left_lookup_trimmed(
        c.src["segments"].select("conversation_id", "queue_name"),
        "queue_name",
        best_queue_row(c.src["queue_dictionary"]).select("queue_key", "ID_Cola", "Gerencia"),
        "queue_key",
    ),
    f"""SELECT conversation_id, queue_name, ID_Cola, Gerencia FROM in_segments LEFT JOIN queue_one ON queue_key = {bare('queue_name')}""",
)
register(
    "left_join_plain",
    lambda c: joins.left_lookup(
        c.src["segments"].select("conversation_id", "agent_id"), results.retention(c.src, c.p), CONVERSATION
    ),
    """SELECT s.conversation_id, agent_id, is_hvc, is_recontact FROM in_segments s
       LEFT JOIN (FROM in_retention_flags WHERE conversation_start_dt >= DATE '1995-02-01') r ON r.conversation_id = s.conversation_id""",
)
register(
    "exact_then_fallback",
    lambda c: joins.exact_or_fallback(
        c.segments.select("conversation_id", "agent_id", "skill_name", "aht"),
        c.best_categories,
        "conversation_id",
        "agent_id",
        segments.LEVELS,
    ),
    """SELECT s.conversation_id, s.agent_id, skill_name, aht, coalesce(e.first_category, o.first_category) AS first_category,
              coalesce(e.second_category, o.second_category) AS second_category, coalesce(e.third_category, o.third_category) AS third_category
       FROM seg_one s LEFT JOIN cat_best e ON e.conversation_id = s.conversation_id AND e.agent_id = s.agent_id
       LEFT JOIN cat_best o ON o.conversation_id = s.conversation_id AND o.agent_id IS NULL""",
)
register(
    "full_outer_channels",
    lambda c: segments.merge_channels(
        segments.segments_categorised(c.segments, c.best_categories),
        c.bots.where(F.col("bot_channel") == "voice"),
    )
    .groupBy("is_human", "channel_type", "call_date", "market_code")
    .agg(F.count("*").alias("n"), F.count("cat_pca").alias("categorised"), F.count("skill_lookup").alias("human_side")),
    """SELECT is_human, channel_type, call_date, market_code, count(*) AS n, count(cat_pca) AS categorised, count(skill_lookup) AS human_side
       FROM calls WHERE coalesce(channel_type, '') <> 'bot_wsp' GROUP BY ALL""",
)
register(
    "asof_nearest_month_ticket",
    lambda c: joins.left_lookup(
        c.src["tickets"].select("ticket_id", "claim_ai_typification"),
        segments.staff_of_tickets(c.src["tickets"], c.src["staff_snapshots"]),
        {"ticket_id": "ticket_id"},
    ),
    """SELECT t.ticket_id, claim_ai_typification, s.agent_bp_number, s.agent_id FROM in_tickets t LEFT JOIN ticket_staff s ON s.ticket_id = t.ticket_id""",
)
register(
    "asof_nearest_month_session",
    lambda c: results.session_agents(c.src["participant_sessions"], c.src["staff_snapshots"], c.src["agent_names"])
    .withColumn("load_datetime", F.date_format("load_datetime", "yyyy-MM-dd HH:mm:ss")),
    """SELECT conversation_id, agent_id, agent_bp_number, agent_name, supervisor_bp_number,
              strftime(load_datetime, '%Y-%m-%d %H:%M:%S') AS load_datetime FROM session_one""",
)
register(
    "period_exact_join",
    lambda c: results.supervisors(
        c.src["segments"].select(
            "conversation_id", F.col("agent_bp_number").alias("agent_bp"), "agent_id", F.col("conversation_date").alias("call_date")
        ),
        c.src["staff_snapshots"],
    ),
    f"""SELECT conversation_id, s.agent_bp_number AS agent_bp, s.agent_id, conversation_date AS call_date,
               coalesce(x.supervisor_bp_number, y.supervisor_bp_number) AS last_supervisor_bp_number
        FROM in_segments s LEFT JOIN boss_by_bp x ON x.agent_bp_number = s.agent_bp_number AND x.period_id = {ym('conversation_date')}
        LEFT JOIN boss_by_id y ON y.agent_id = s.agent_id AND y.period_id = {ym('conversation_date')}""",
)


def _voice_rows(c: Context):
    """One row per conversation and agent with canal and origin."""
    return c.src["segments"].select(
        "conversation_id",
        "agent_id",
        F.col("agent_bp_number").alias("agent_bp"),
        F.when(F.col("message_type").isNull(), "voz").otherwise("wsp").alias("canal"),
        F.when(F.col("sag_name") == "SAG_1", "NOT_HUMAN").otherwise("HUMAN").alias("is_human"),
    )


_VOICE_SQL = """(SELECT conversation_id, agent_id, agent_bp_number AS agent_bp, CASE WHEN message_type IS NULL THEN 'voz' ELSE 'wsp' END AS canal,
    CASE WHEN sag_name = 'SAG_1' THEN 'NOT_HUMAN' ELSE 'HUMAN' END AS is_human FROM in_segments)"""

register(
    "conditional_equi_join",
    lambda c: results.join_surveys(_voice_rows(c), c.src["surveys"]),
    f"""SELECT b.*, v.nps FROM {_VOICE_SQL} b LEFT JOIN in_surveys v ON v.conversation_id = b.conversation_id
        AND CASE WHEN canal = 'voz' AND is_human <> 'NOT_HUMAN' THEN TRY_CAST(v.advisor_bp_number AS BIGINT) = agent_bp ELSE true END""",
)
register(
    "null_wildcard_join",
    lambda c: joins.wildcard_join(
        _voice_rows(c),
        results.resolution_per_agent(
            results.resolution_rows(c.src, c.p),
            results.agent_bridge(results.process_log(c.src, c.p), c.src["staff_snapshots"]),
        ),
        "conversation_id",
        "agent_id",
        ["is_first_call_resolution", "reason_resolution_fcr"],
    ),
    f"""SELECT b.*, is_first_call_resolution, reason_resolution_fcr FROM {_VOICE_SQL} b
        LEFT JOIN res_one r ON r.conversation_id = b.conversation_id AND (r.agent_id = b.agent_id OR r.agent_id IS NULL)""",
)
register(
    "join_distinct_subquery",
    lambda c: joins.left_lookup(
        joins.left_lookup(c.table("orders").select(F.concat(F.lit("c"), "o_orderkey").alias("conversation_id")), results.chat_tips(c.src), CONVERSATION),
        results.chat_outcomes(c.src),
        CONVERSATION,
    ),
    f"""SELECT 'c' || o_orderkey AS conversation_id, t.tip, f.fcr_ai FROM orders
       LEFT JOIN (SELECT DISTINCT conversationid, {bare('tip')} AS tip FROM in_chat_indicators) t ON t.conversationid = 'c' || o_orderkey
       LEFT JOIN (SELECT DISTINCT conversationid, fcr_ai FROM in_chat_indicators) f ON f.conversationid = 'c' || o_orderkey""",
)
register(
    "inner_bridge_join",
    lambda c: results.agent_bridge(results.process_log(c.src, c.p), c.src["staff_snapshots"]),
    "SELECT conversation_id, participant_id, agent_id FROM bridge",
)


def _main(c: Context):
    """For one reader, as the layer below."""
    return results.main_table(c.intermedia_once)


def _demand(c: Context):
    return scaling.demand(c.src["demand_wide"], c.src["demand_daily"], c.p)


def factor_rows(c: Context):
    main = c.ws.stage(_main(c).select("conversation_id", "agent_id", "call_date", "canal", "zona", "is_human"), "main")
    counts = c.ws.stage(scaling.observed_counts(main), "counts")
    factors = c.ws.stage(scaling.scaling_factors(counts, _demand(c), c.p), "factors")
    return rounded(scaling.apply_factor(main, factors), "factor")


register(
    "factor_join",
    factor_rows,
    "SELECT conversation_id, agent_id, call_date, canal, zona, is_human, round(factor, 6) AS factor FROM weighted",
)


def queue_first(c: Context):
    rows = c.src["segments"].select("conversation_id", F.array("queue_name").alias("skill_name"))
    side = c.src["queue_country"]
    keyed = rows.withColumn("first_queue", F.get("skill_name", F.lit(0))).drop("skill_name")
    return joins.left_lookup(keyed.withColumn("_q", F.col("first_queue")), side, {"_q": "sagg"}).drop("_q")


register(
    "array_element_key_join",
    queue_first,
    "SELECT conversation_id, queue_name AS first_queue, country FROM in_segments LEFT JOIN in_queue_country ON sagg = queue_name",
)
register(
    "unnest_cross_join",
    lambda c: explode_segments(c.intermedia_once.select("conversation_id", "is_human", "skill_lookup")).select(
        "conversation_id", "is_human", "segment.agent_id", "segment.skill_name", "segment.aht"
    ),
    """SELECT conversation_id, is_human, s.agent_id, s.skill_name, s.aht
       FROM (SELECT conversation_id, is_human, unnest(skill_lookup) AS s FROM inter)""",
)
register(
    "scalar_subquery_compare",
    lambda c: reconcile(
        c.table("lineitem").select(F.col("l_linenumber").alias("lines")),
        c.table("lineitem").select((F.col("l_linenumber") + F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("lines")),
        ["lines"],
    ).select("metric", "status"),
    """SELECT 'row_count' AS metric, 'OK' AS status UNION ALL
       SELECT 'sum_lines', CASE WHEN abs(sum(l_linenumber) - (SELECT sum(l_linenumber + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) FROM lineitem)) < 0.01
              THEN 'OK' ELSE 'DIFF' END FROM lineitem""",
)
register(
    "join_zone_month_demand",
    lambda c: rounded(
        scaling.scaling_factors(c.ws.stage(scaling.observed_counts(_main(c)), "counts"), _demand(c), c.p, parts=True), "factor"
    ),
    f"""SELECT c.*, d.valor AS wanted, CASE WHEN c.mes < {CUT_MONTH} THEN a.whole ELSE c.valor END AS total, round(f.factor, 6) AS factor
        FROM cnt c
        LEFT JOIN (SELECT mes, canal, is_human, CAST(sum(valor) AS BIGINT) AS whole FROM cnt GROUP BY ALL) a
          ON a.mes = c.mes AND a.canal = c.canal AND a.is_human = c.is_human
        LEFT JOIN dem d ON d.mes = c.mes AND d.canal = c.canal AND d.is_human = c.is_human
          AND CASE WHEN c.mes < {CUT_MONTH} THEN d.zona IS NULL ELSE d.zona = c.zona END
        LEFT JOIN fac f ON f.mes = c.mes AND f.canal IS NOT DISTINCT FROM c.canal AND f.zona IS NOT DISTINCT FROM c.zona
          AND f.is_human IS NOT DISTINCT FROM c.is_human""",
)


def element_cast(c: Context):
    rows = segments.pack_segment(c.segments).select("conversation_id", "skill_lookup").withColumn(
        "bp", F.get("skill_lookup", F.lit(0))["bp_executive_num"].try_cast("bigint")
    ).drop("skill_lookup")
    side = c.src["hr_daily"].select("bp_num", "entry_company_date")
    return joins.left_lookup(rows, side, {"bp": "bp_num"})


register(
    "cast_element_key_join",
    element_cast,
    "SELECT conversation_id, bp_executive_num AS bp, entry_company_date FROM seg_one LEFT JOIN in_hr_daily ON bp_num = bp_executive_num",
)
register(
    "first_seen_join",
    lambda c: joins.left_lookup(
        c.src["hr_history"].select("bp_num", "load_dt"), aggregates.first_seen(c.intermedia_once), {"bp_num": "bp_num"}
    ),
    """SELECT h.bp_num, load_dt, first_seen FROM in_hr_history h LEFT JOIN
       (SELECT s.bp_executive_num AS bp_num, min(call_date) AS first_seen FROM (SELECT call_date, unnest(skill_lookup) AS s FROM inter)
        WHERE s.bp_executive_num IS NOT NULL GROUP BY ALL) f ON f.bp_num = h.bp_num""",
)


def weighted_orders(c: Context):
    """Orders as weighted rows: status as canal, priority as market, and some without category."""
    key = F.col("o_orderkey")
    return c.table("orders").select(
        F.concat(F.lit("c"), key).alias("conversation_id"),
        F.to_date("o_orderdate").alias("call_date"),
        F.when(F.col("o_orderstatus") == "P", "voz").when(F.col("o_orderstatus") == "F", "wsp").otherwise("cases").alias("canal"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("market_code"),
        F.when(key % 9 == 0, "NOT_HUMAN").when(key % 9 == 1, "BOTH").otherwise("HUMAN").alias("is_human"),
        F.when(key % 4 == 0, "NOT_CATEGORIZED").otherwise("VENTAS").alias("category"),
        (F.when(key % 13 == 0, 0.0).otherwise(F.col("o_totalprice")) / 1024).alias("factor"),
        (key % 6 == 0).alias("kept_bot_category"),
    )


WEIGHTED_ORDERS_SQL = """(SELECT 'c' || o_orderkey AS conversation_id, CAST(o_orderdate AS DATE) AS call_date,
    CASE o_orderstatus WHEN 'P' THEN 'voz' WHEN 'F' THEN 'wsp' ELSE 'cases' END AS canal, nullif(o_orderpriority, '5-LOW') AS market_code,
    CASE o_orderkey % 9 WHEN 0 THEN 'NOT_HUMAN' WHEN 1 THEN 'BOTH' ELSE 'HUMAN' END AS is_human,
    CASE WHEN o_orderkey % 4 = 0 THEN 'NOT_CATEGORIZED' ELSE 'VENTAS' END AS category,
    CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE o_totalprice END / 1024 AS factor, o_orderkey % 6 = 0 AS kept_bot_category FROM orders)"""
ORDER_SHARE_SQL = f"""(SELECT call_date, canal, market_code, coalesce(sum(factor) FILTER (category <> 'NOT_CATEGORIZED'), 0) AS fac_cat,
    sum(factor) AS factor_sum FROM {WEIGHTED_ORDERS_SQL}
    WHERE is_human = 'HUMAN' AND (canal <> 'cases' OR call_date >= DATE '1999-01-01') GROUP BY ALL)"""


def shares(c: Context):
    rows = weighted_orders(c)
    keys = {k: k for k in ("call_date", "canal", "market_code")}
    joined = joins.left_lookup(rows.select("conversation_id", *keys), scaling.category_share(rows, c.p), keys)
    return rounded(joined, "fac_cat", "factor_sum", digits=6)


register(
    "share_join",
    shares,
    f"""SELECT r.conversation_id, r.call_date, r.canal, r.market_code, round(fac_cat, 6) AS fac_cat, round(factor_sum, 6) AS factor_sum
        FROM {WEIGHTED_ORDERS_SQL} r LEFT JOIN {ORDER_SHARE_SQL} s ON s.call_date = r.call_date AND s.canal = r.canal AND s.market_code = r.market_code""",
)
register(
    "sample_joins",
    lambda c: joins.left_lookup(
        joins.left_lookup(
            c.src["summaries"].select("conversation_id", "call_reason"),
            c.src["bot_sessions"].select("conversation_id", "voicebot_category_process"),
            CONVERSATION,
        ),
        c.src["bot_transcriptions"].select("conversation_id", F.lit(1).alias("transcribed")),
        CONVERSATION,
    ),
    """SELECT s.conversation_id, call_reason, voicebot_category_process, CASE WHEN t.conversation_id IS NOT NULL THEN 1 END AS transcribed
       FROM in_summaries s LEFT JOIN in_bot_sessions b ON b.conversation_id = s.conversation_id
       LEFT JOIN in_bot_transcriptions t ON t.conversation_id = s.conversation_id""",
)


def ranked_pairs(c: Context):
    """The nearest snapshot of every e-mail and month, with the rank keys."""
    moments = c.src["tickets"].select(
        F.lower("agent_email").alias("email"), dates.period_of(F.col("created_dt")).alias("month")
    )
    staff = c.src["staff_snapshots"].withColumn("email", F.lower("agent_email"))
    return joins.nearest_snapshot(
        moments, staff, "email", "period_id", "load_datetime", ["agent_bp_number", "agent_id"]
    ).drop("loaded")


register(
    "nearest_period_rank",
    ranked_pairs,
    f"""SELECT email, month, CAST(gap AS INTEGER) AS gap, before, agent_bp_number, agent_id FROM (
        SELECT t.email, t.month, {gap('s.period_id', 't.day')} AS gap, CASE WHEN s.period_id >= t.month THEN 0 ELSE 1 END AS before,
               s.agent_bp_number, s.agent_id, s.load_datetime
        FROM (SELECT DISTINCT lower(agent_email) AS email, {ym('created_dt')} AS month, date_trunc('month', created_dt) AS day FROM in_tickets) t
        JOIN in_staff_snapshots s ON lower(s.agent_email) = t.email)
        QUALIFY row_number() OVER (PARTITION BY email, month ORDER BY gap NULLS FIRST, before, load_datetime DESC NULLS LAST,
            agent_bp_number NULLS FIRST, agent_id NULLS FIRST) = 1""",
)
