"""Aggregations, one-row-per-key choices, windows, sorts and unions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from contact_mart.checks.q_joins import ORDER_SHARE_SQL, WEIGHTED_ORDERS_SQL, _main, weighted_orders
from contact_mart.checks.registry import Context, agents_text, flat, names_text, register, rounded, segments_text
from contact_mart.checks.steps import agents_text as agents_sql
from contact_mart.checks.steps import names_text as names_sql
from contact_mart.checks.steps import segments_text as segments_sql
from contact_mart.functions import arrays, dates, rules
from contact_mart.operators import aggregates, dedup, filters, scaling, sketches
from contact_mart.operators.reconcile import reconcile
from contact_mart.operators.reshape import union_all, union_distinct, unpivot_measures
from contact_mart.operators.sampling import sample_n
from contact_mart.plans import earlier, reports, results, segments
from contact_mart.plans.conversations import build_intermedia, collapse_conversations
from contact_mart.plans.first_seen import FirstSeen

# ---- aggregations --------------------------------------------------------------------

register(
    "any_market_per_conv",
    lambda c: segments.market_by_conversation(c.src["bot_sessions"], c.p),
    "SELECT conversation_id, market_code FROM market_one",
)


def in_order(c: Context):
    """Elements in array order, so that the order itself is compared."""
    text = F.transform(
        "all_agents",
        lambda e: F.concat_ws("/", *[F.coalesce(e[f], F.lit("~")) for f in ("agent_id", *segments.LEVELS)]),
    )
    return aggregates.agents_per_conversation(c.categories).select(
        "conversation_id", F.array_join(text, "|").alias("all_agents")
    )


register(
    "ordered_struct_agg",
    in_order,
    """SELECT conversation_id, array_to_string(list_transform(all_agents, lambda e: coalesce(e.agent_id, '~') || '/' || coalesce(e.first_category, '~')
              || '/' || coalesce(e.second_category, '~') || '/' || coalesce(e.third_category, '~')), '|') AS all_agents FROM cat_list""",
)


def _agent_arrays(c: Context):
    """One array per segment; NULL for segments without agent."""
    return c.src["segments"].select(
        "sag_name",
        "conversation_date",
        F.when(F.col("agent_id").isNotNull(), F.array("agent_id", "factory_name")).alias("items"),
    )


_ARRAYS_SQL = """(SELECT sag_name, conversation_date, CASE WHEN agent_id IS NOT NULL THEN [agent_id, factory_name] END AS items FROM in_segments)"""

register(
    "array_concat_agg",
    lambda c: _agent_arrays(c)
    .groupBy("sag_name", "conversation_date")
    .agg(arrays.concat_arrays(F.col("items")).alias("items"))
    .select("sag_name", "conversation_date", names_text("items").alias("items")),
    f"""SELECT sag_name, conversation_date, {names_sql('items')} AS items
        FROM (SELECT sag_name, conversation_date, flatten(list(items) FILTER (items IS NOT NULL)) AS items FROM {_ARRAYS_SQL} GROUP BY ALL)""",
)
register(
    "array_distinct_elems",
    lambda c: _agent_arrays(c)
    .groupBy("sag_name", "conversation_date")
    .agg(arrays.merge_arrays(F.col("items")).alias("items"))
    .select("sag_name", "conversation_date", F.array_join("items", "|").alias("items")),
    """SELECT sag_name, conversation_date, string_agg(DISTINCT x, '|' ORDER BY x) AS items
       FROM (SELECT sag_name, conversation_date, unnest([agent_id, CASE WHEN agent_id IS NOT NULL THEN factory_name END]) AS x FROM in_segments)
       GROUP BY ALL""",
)
register(
    "distinct_array_agg",
    lambda c: c.src["tickets"]
    .groupBy("ticket_id")
    .agg(
        arrays.collect_distinct(F.col("agent_group_name")).alias("groups"),
        arrays.collect_distinct(F.coalesce("factory_name", F.lit("NO_FACTORY"))).alias("factories"),
        arrays.collect_distinct(F.col("factory_name")).alias("known"),
    )
    .select("ticket_id", *[F.array_join(x, "|").alias(x) for x in ("groups", "factories", "known")]),
    """SELECT ticket_id, string_agg(DISTINCT agent_group_name, '|' ORDER BY agent_group_name) AS groups,
              string_agg(DISTINCT coalesce(factory_name, 'NO_FACTORY'), '|' ORDER BY coalesce(factory_name, 'NO_FACTORY')) AS factories,
              string_agg(DISTINCT factory_name, '|' ORDER BY factory_name) AS known
       FROM in_tickets GROUP BY ALL""",
)
register(
    "latest_non_null",
    lambda c: c.src["bot_sessions"]
    .groupBy("customer_id")
    .agg(
        arrays.latest(F.col("market_code"), F.col("conversation_start_datetime")).alias("market"),
        arrays.latest(F.col("market_code"), F.col("conversation_start_datetime"), ignore_nulls=False).alias("last_market"),
    ),
    """SELECT customer_id, (list(market_code ORDER BY conversation_start_datetime DESC, market_code DESC) FILTER (market_code IS NOT NULL))[1] AS market,
              list(market_code ORDER BY conversation_start_datetime DESC NULLS LAST, market_code DESC NULLS LAST)[1] AS last_market
       FROM in_bot_sessions GROUP BY ALL""",
)
register(
    "distinct_string_agg",
    lambda c: c.src["segments"]
    .groupBy("conversation_id")
    .agg(arrays.csv_distinct(F.col("agent_bp_number")).alias("numbers"), arrays.csv_distinct(F.col("agent_id")).alias("ids")),
    """SELECT conversation_id, string_agg(DISTINCT CAST(agent_bp_number AS VARCHAR), ',' ORDER BY CAST(agent_bp_number AS VARCHAR)) AS numbers,
              string_agg(DISTINCT agent_id, ',' ORDER BY agent_id) AS ids FROM in_segments GROUP BY ALL""",
)


def _demand(c: Context):
    return scaling.demand(c.src["demand_wide"], c.src["demand_daily"], c.p)


register(
    "scaling_factors",
    lambda c: rounded(scaling.scaling_factors(c.ws.stage(scaling.observed_counts(_main(c)), "counts"), _demand(c), c.p), "factor"),
    "SELECT mes, canal, zona, is_human, round(factor, 6) AS factor FROM fac",
)
register(
    "zone_scaling_factors",
    lambda c: rounded(scaling.zone_factors(scaling.observed_counts(_main(c)), _demand(c)), "factor"),
    """SELECT c.mes, c.canal, c.zona, c.is_human, round(coalesce(d.valor / nullif(c.valor, 0), 0), 6) AS factor FROM cnt c
       LEFT JOIN dem d ON d.mes = c.mes AND d.canal = c.canal AND d.zona = c.zona AND d.is_human = c.is_human""",
)
register("observed_counts", lambda c: scaling.observed_counts(_main(c)), "SELECT mes, canal, zona, is_human, valor FROM cnt")
register(
    "demand_monthly",
    lambda c: scaling.current_demand(c.src["demand_daily"], c.p),
    "SELECT mes, canal, zona, is_human, valor FROM dem_new",
)


def _packed(c: Context):
    return segments.pack_segment(c.segments).select("conversation_id", "skill_lookup")


register(
    "agent_time_total",
    lambda c: aggregates.agent_time_total(_packed(c)),
    "SELECT conversation_id, agent_id, sum(aht) AS total_aht FROM seg_one WHERE agent_id IS NOT NULL GROUP BY ALL",
)
register(
    "ticket_collapse",
    lambda c: flat(segments.collapse_tickets(segments.tickets_resolved(c.src, c.p))),
    f"""SELECT conversation_id, call_date, {names_sql('skill_name')} AS skill_name, {names_sql('factory_name')} AS factory_name, market_code,
               channel_type, cat_bot, is_human, {segments_sql('skill_lookup')} AS skill_lookup, cat_pca, agent_email FROM ticket_one""",
)
register(
    "conditional_sums",
    lambda c: rounded(scaling.category_share(weighted_orders(c), c.p), "fac_cat", "factor_sum", digits=6),
    f"SELECT call_date, canal, market_code, round(fac_cat, 6) AS fac_cat, round(factor_sum, 6) AS factor_sum FROM {ORDER_SHARE_SQL}",
)


def reconciled(c: Context):
    """The candidate has one more unit on every tenth order and a flag on every third."""
    key = F.col("o_orderkey")
    original = c.table("orders").select(key.alias("weight"), F.col("o_custkey").alias("customer"))
    test = c.table("orders").select(
        (key + F.when(key % 10 == 0, 1).otherwise(0)).alias("weight"),
        F.col("o_custkey").alias("customer"),
        (key % 3 == 0).alias("kept_bot_category"),
    )
    line = reconcile(original, test, ["weight", "customer"], "kept_bot_category")
    whole = [F.regexp_replace(F.col(x), r"\.0$", "").alias(x) for x in ("original", "test")]
    exact = [F.when(F.col(x).contains("E"), F.col(x).cast("double").cast("bigint").cast("string")).otherwise(w).alias(x)
             for x, w in zip(("original", "test"), whole)]
    return line.select("metric", *exact, "status")


register(
    "reconcile",
    reconciled,
    """SELECT 'row_count' AS metric, CAST(count(*) AS VARCHAR) AS original, CAST(count(*) AS VARCHAR) AS test, 'OK' AS status FROM orders
       UNION ALL SELECT 'sum_weight', CAST(sum(o_orderkey) AS VARCHAR), CAST(sum(o_orderkey) + count(*) FILTER (o_orderkey % 10 = 0) AS VARCHAR), 'DIFF' FROM orders
       UNION ALL SELECT 'sum_customer', CAST(sum(o_custkey) AS VARCHAR), CAST(sum(o_custkey) AS VARCHAR), 'OK' FROM orders
       UNION ALL SELECT 'kept_bot_category_count', 'N/A', CAST(count(*) FILTER (o_orderkey % 3 = 0) AS VARCHAR), 'OK' FROM orders""",
)
register(
    "distinct_counts",
    lambda c: c.src["segments"].groupBy("factory_name", "message_type").agg(
        F.count_distinct("conversation_id").alias("vol"), F.count_distinct("agent_bp_number").alias("q_agent")
    ),
    """SELECT factory_name, message_type, count(DISTINCT conversation_id) AS vol, count(DISTINCT agent_bp_number) AS q_agent
       FROM in_segments GROUP BY ALL""",
)
register(
    "ratio_of_sums",
    lambda c: rounded(
        aggregates.handle_time_by(c.src["queue_performance"], F.year("effective_start_date_utc"), "year_number"),
        "average_handle_time",
    ),
    """SELECT CAST(year(effective_start_date_utc) AS INTEGER) AS year_number,
              round(sum(handletime_seconds) / nullif(sum(handle_qty), 0), 6) AS average_handle_time FROM in_queue_performance GROUP BY ALL""",
)
register(
    "nps_score",
    lambda c: c.src["surveys"].groupBy("last_sag_contact_description").agg(
        F.round(F.avg(rules.nps_by_text(F.col("nps"))), 6).alias("by_text"),
        F.round(F.avg(rules.nps_by_number(F.col("nps"))), 6).alias("by_number"),
        F.count(rules.nps_by_text(F.col("nps"))).alias("n_text"),
        F.count(rules.nps_by_number(F.col("nps"))).alias("n_number"),
    ),
    """SELECT last_sag_contact_description, round(avg(a), 6) AS by_text, round(avg(b), 6) AS by_number, count(a) AS n_text, count(b) AS n_number
       FROM (SELECT last_sag_contact_description, CASE WHEN nps IN ('9', '10') THEN 100 WHEN nps IN ('0', '1', '2', '3', '4', '5', '6') THEN -100
                    WHEN nps IS NOT NULL THEN 0 END AS a,
                    CASE WHEN n BETWEEN 9 AND 10 THEN 100 WHEN n BETWEEN 7 AND 8 THEN 0 WHEN n BETWEEN 0 AND 6 THEN -100 END AS b
             FROM (SELECT *, TRY_CAST(nps AS INTEGER) AS n FROM in_surveys)) GROUP BY ALL""",
)
register(
    "tenure_buckets",
    lambda c: c.src["hr_history"].select(
        "bp_num",
        "load_dt",
        F.date_diff("entry_company_date", "load_dt").alias("days"),
        rules.tenure_label(F.date_diff("entry_company_date", "load_dt"), *reports.TENURE_V1).alias("v1"),
        rules.tenure_label(F.date_diff("entry_company_date", "load_dt"), *reports.TENURE_V2).alias("v2"),
    ),
    """SELECT bp_num, load_dt, a AS days,
        CASE WHEN a IS NULL OR a <= 1 THEN 'S/I' WHEN a <= 30 THEN 'a 0-30' WHEN a <= 60 THEN 'b 30-60' WHEN a <= 90 THEN 'c 60-90'
             WHEN a <= 120 THEN 'd 90-120' WHEN a <= 150 THEN 'e 120-150' WHEN a <= 180 THEN 'f 150-180' ELSE 'g >180' END AS v1,
        CASE WHEN a IS NULL THEN 'S/I' WHEN a <= 30 AND a > 0 THEN 'a 0-30' WHEN a <= 60 THEN 'b 30-60' WHEN a <= 90 THEN 'c 60-90'
             WHEN a <= 120 THEN 'd 90-120' WHEN a <= 150 THEN 'e 120-150' WHEN a <= 180 THEN 'f 150-180' WHEN a <= 210 THEN 'g 180-210' ELSE 'h >210' END AS v2
       FROM (SELECT bp_num, load_dt, CAST(date_diff('day', load_dt, entry_company_date) AS INTEGER) AS a FROM in_hr_history)""",
)
register(
    "handle_time_totals",
    lambda c: aggregates.handle_time_totals(c.src["segments"]),
    """SELECT conversation_id, sum(coalesce(talk_time_second, 0)) AS total_talk_time, sum(coalesce(held_time_second, 0)) AS total_held_time,
              sum(coalesce(after_call_work_time_second, 0)) AS total_acw FROM in_segments GROUP BY ALL""",
)
register(
    "max_per_key",
    lambda c: aggregates.max_nps_per_conversation(c.src["surveys"]),
    "SELECT conversation_id, max(nps) AS nps FROM in_surveys GROUP BY ALL",
)
_PLAIN = f"""(SELECT r.*, CASE WHEN factor = 0 THEN 0.0 WHEN category = 'NOT_CATEGORIZED' OR is_human = 'NOT_HUMAN' THEN 1.0
    WHEN EXISTS (SELECT 1 FROM {WEIGHTED_ORDERS_SQL} o WHERE o.is_human = 'HUMAN' AND o.canal <> 'cases' AND o.call_date = r.call_date
        AND o.canal = r.canal AND (coalesce(o.market_code, '') = 'BR') = (coalesce(r.market_code, '') = 'BR')) THEN factor ELSE 0 END AS factor_plus
    FROM {WEIGHTED_ORDERS_SQL} r)"""
_CORRECTION = f"""(SELECT call_date, canal, sum(factor) / nullif(sum(factor_plus) FILTER (category <> 'NOT_CATEGORIZED'), 0) AS correction
    FROM {_PLAIN} WHERE canal <> 'cases' AND is_human = 'HUMAN' GROUP BY ALL)"""
register(
    "correction_factor",
    lambda c: rounded(scaling.correction_factors(scaling.plain_factor_plus(weighted_orders(c))), "correction"),
    f"SELECT call_date, canal, round(correction, 6) AS correction FROM {_CORRECTION}",
)
register(
    "legacy_factor_plus",
    lambda c: rounded(earlier.corrected_rows(weighted_orders(c)), "factor_plus"),
    f"""SELECT p.* EXCLUDE (factor_plus), round(CASE WHEN p.canal <> 'cases' AND is_human = 'HUMAN' AND category <> 'NOT_CATEGORIZED'
               AND correction IS NOT NULL THEN factor_plus * correction ELSE factor_plus END, 6) AS factor_plus
        FROM {_PLAIN} p LEFT JOIN {_CORRECTION} k ON k.call_date = p.call_date AND k.canal = p.canal""",
)
register(
    "group_by_all",
    lambda c: c.src["bot_sessions"]
    .groupBy(dates.month_text(F.col("conversation_start_datetime")).alias("mes"), "channel_type", "market_code")
    .agg(F.count("conversation_id").alias("n")),
    """SELECT strftime(conversation_start_datetime, '%Y-%m') AS mes, channel_type, market_code, count(conversation_id) AS n
       FROM in_bot_sessions GROUP BY ALL""",
)
register(
    "min_date_per_agent",
    lambda c: aggregates.first_seen(segments.pack_segment(c.segments).select("call_date", "skill_lookup")),
    """SELECT bp_executive_num AS bp_num, min(call_date) AS first_seen FROM seg_one WHERE bp_executive_num IS NOT NULL GROUP BY ALL""",
)


def refreshed_first_seen(c: Context):
    """State built up to a day, then taken over from three windows, the last of which replaces months again."""
    mart = segments.pack_segment(c.segments).select("call_date", "skill_lookup")
    state = FirstSeen(c.spark, c.ws.path("first-seen"))
    windows = [date(1998, 1, 1), date(1999, 7, 1), date(1999, 1, 1)]
    state.refresh(mart.where(F.col("call_date") < F.lit(windows[0])))
    state.refresh(mart.where(F.col("call_date") < F.lit(date(2000, 1, 1))), windows[0])
    for start in windows[1:]:
        state.refresh(mart, start)
    return state.read()


register(
    "first_seen_state",
    refreshed_first_seen,
    """SELECT bp_executive_num AS bp_num, min(call_date) AS first_seen FROM seg_one WHERE bp_executive_num IS NOT NULL GROUP BY ALL""",
)


def sketched(c: Context):
    """Distinct conversations and agents per partner and year, exact, and whether the merged daily sketches are within four
    standard errors of them."""
    rows = c.segments.select("call_date", "conversation_id", "agent_id", "factory_name")
    counted = {"conversations": "conversation_id", "agents": "agent_id"}
    days = c.ws.stage(sketches.daily_sketches(rows, ["factory_name"], counted), "sketches")
    year = F.year("call_date").alias("year")
    near = sketches.distinct_over(days, ["factory_name", year], list(counted))
    exact = rows.groupBy("factory_name", year).agg(*[F.count_distinct(v).alias(f"exact_{k}") for k, v in counted.items()])
    both = exact.join(near.withColumnsRenamed({"factory_name": "_f", "year": "_y"}), F.col("factory_name").eqNullSafe(F.col("_f")) & (F.col("year") == F.col("_y")))
    close = lambda k: F.abs(F.col(k) - F.col(f"exact_{k}")) <= 1 + 4 * sketches.standard_error() * F.col(f"exact_{k}")
    return both.select(
        "factory_name", "year", *[F.col(f"exact_{k}").alias(k) for k in counted], *[close(k).alias(f"{k}_close") for k in counted]
    )


register(
    "distinct_sketches",
    sketched,
    """SELECT factory_name, CAST(year(call_date) AS INTEGER) AS year, count(DISTINCT conversation_id) AS conversations, count(DISTINCT agent_id) AS agents,
              true AS conversations_close, true AS agents_close FROM seg_rich GROUP BY ALL""",
)


def constants(c: Context):
    grouped = results.social_rows(scaling.current_demand(c.src["demand_daily"], c.p), c.p)
    return flat(grouped)


register(
    "constant_array_agg",
    constants,
    """SELECT 'rrss' AS conversation_id, CAST(mes || '-01' AS DATE) AS call_date, 'NO_FACTORY' AS factory_name, canal AS channel_type,
              'HUMAN' AS is_human, canal, zona, valor AS factor FROM dem_new WHERE canal = 'rrss'""",
)

# ---- one row per key -----------------------------------------------------------------

_STAFF = ("agent_id", "agent_email", "agent_bp_number", "supervisor_bp_number", "period_id")
register(
    "latest_staff_by_agent",
    lambda c: dedup.latest_staff(c.src["staff_snapshots"], "agent_id").select(*_STAFF),
    f"SELECT {', '.join(_STAFF)} FROM staff_by_agent",
)
register(
    "latest_staff_by_email",
    lambda c: dedup.latest_hr_by_email(c.src["hr_history"]),
    "SELECT bp_num, employee_email FROM hr_one",
)
register(
    "best_dictionary_row",
    lambda c: dedup.best_queue_row(c.src["queue_dictionary"]).withColumnRenamed("Fabrica", "Fabrica_dic").drop("Nombre_de_Cola"),
    "SELECT * FROM queue_one",
)
register(
    "bridge_one_user",
    lambda c: dedup.user_of_participant(c.src["participant_sessions"]),
    "SELECT participant_id, agent_id FROM user_one",
)
register(
    "best_category_per_agent",
    lambda c: segments.best_category_per_agent(c.categories),
    "SELECT conversation_id, agent_id, first_category, second_category, third_category FROM cat_best",
)
register(
    "top_agent_by_time",
    lambda c: aggregates.top_agent_by_time(aggregates.agent_time_total(_packed(c))),
    """SELECT conversation_id, agent_id, total_aht FROM (SELECT conversation_id, agent_id, sum(aht) AS total_aht FROM seg_one WHERE agent_id IS NOT NULL GROUP BY ALL)
       QUALIFY row_number() OVER (PARTITION BY conversation_id ORDER BY total_aht DESC NULLS LAST, agent_id) = 1""",
)
register(
    "latest_agent_name",
    lambda c: dedup.latest_agent_name(c.src["agent_names"]),
    "SELECT agent_bp_number, agent_name FROM name_one",
)
register(
    "latest_staff_by_period",
    lambda c: dedup.latest_staff(
        c.src["staff_snapshots"].where(F.col("agent_bp_number").isNotNull()), "agent_bp_number", "period_id"
    ).select("agent_bp_number", "period_id", "supervisor_bp_number"),
    "SELECT agent_bp_number, period_id, supervisor_bp_number FROM boss_by_bp",
)


def _bridge(c: Context):
    return results.agent_bridge(results.process_log(c.src, c.p), c.src["staff_snapshots"])


register(
    "one_resolution_per_agent",
    lambda c: results.resolution_per_agent(results.resolution_rows(c.src, c.p), _bridge(c)),
    "SELECT conversation_id, agent_id, is_first_call_resolution, reason_resolution_fcr FROM res_one",
)
register(
    "one_compliance_per_agent",
    lambda c: results.compliance_per_agent(c.src["compliance"], _bridge(c)),
    "SELECT conversation_id, agent_id, nota_calidad FROM qual_one",
)
register(
    "latest_staff_by_bp",
    lambda c: dedup.latest_staff(c.src["staff_snapshots"].where(F.col("agent_bp_number").isNotNull()), "agent_bp_number").select(*_STAFF),
    f"SELECT {', '.join(_STAFF)} FROM staff_by_bp",
)
register(
    "latest_supervisor_lookup",
    lambda c: results.latest_supervisors(
        c.src["segments"].select("conversation_id", F.col("agent_bp_number").alias("agent_bp"), "agent_id"), c.src["staff_snapshots"]
    ),
    """SELECT conversation_id, s.agent_bp_number AS agent_bp, s.agent_id, coalesce(a.supervisor_bp_number, b.supervisor_bp_number) AS last_supervisor_bp_number
       FROM in_segments s LEFT JOIN staff_by_agent a ON a.agent_id = s.agent_id LEFT JOIN staff_by_bp b ON b.agent_bp_number = s.agent_bp_number""",
)

# ---- first values over a frame -------------------------------------------------------

register(
    "first_value_running",
    lambda c: reports.entry_dates(c.src["hr_history"], c.src["hr_daily"].select("bp_num", F.lit(None).cast("date").alias("first_seen")))
    .select("bp_num", "entry")
    .distinct(),
    """SELECT DISTINCT bp_num, first_value(entry_company_date IGNORE NULLS) OVER (PARTITION BY bp_num ORDER BY load_dt
           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS entry FROM in_hr_history""",
)
register(
    "first_value_full_frame",
    lambda c: reports.entry_dates(c.src["hr_history"], c.src["hr_daily"].select("bp_num", F.lit(None).cast("date").alias("first_seen")))
    .select("bp_num", "first_load")
    .distinct(),
    "SELECT bp_num, min(load_dt) AS first_load FROM in_hr_history GROUP BY ALL",
)
register(
    "first_value_over_conv",
    lambda c: earlier.first_resolution(c.src["voice_resolution"]),
    """SELECT conversation_id, first_value(is_first_call_resolution) OVER (PARTITION BY conversation_id
           ORDER BY participant_id NULLS FIRST, is_first_call_resolution NULLS FIRST) AS is_first_call_resolution FROM in_voice_resolution""",
)
register(
    "compliance_per_conversation",
    lambda c: earlier.compliance_per_conversation(c.src["compliance"]),
    """SELECT conversation_id, m1_welcome_weight + m2_inquiry_weight + m3_empathy_weight + m4_expectation_adjustment_weight + m5_management_weight
              + m6_information_provision_weight + m7_service_confirmation_weight + m8_farewell_weight AS nota_calidad
       FROM in_compliance QUALIFY row_number() OVER (PARTITION BY conversation_id ORDER BY participant_id DESC NULLS LAST, m1_welcome_weight NULLS FIRST,
           m2_inquiry_weight NULLS FIRST, m3_empathy_weight NULLS FIRST, m4_expectation_adjustment_weight NULLS FIRST, m5_management_weight NULLS FIRST,
           m6_information_provision_weight NULLS FIRST, m7_service_confirmation_weight NULLS FIRST, m8_farewell_weight NULLS FIRST) = 1""",
)

# ---- sort, top-k, sample -------------------------------------------------------------

register(
    "random_sample_n",
    lambda c: sample_n(
        c.table("documents").select("doc_id", "text"),
        300,
        key=[((F.col("doc_id") * 7919 + 13) % 10007).asc(), F.col("doc_id").asc()],
    ),
    "SELECT doc_id, text FROM documents ORDER BY (doc_id * 7919 + 13) % 10007, doc_id LIMIT 300",
)
register(
    "top1_in_array",
    lambda c: c.intermedia_once.select("conversation_id", arrays.longest_segment(F.col("skill_lookup")).alias("t")).select(
        "conversation_id", "t.agent_id", F.col("t.bp_executive_num").alias("agent_bp"), F.col("t.aht").alias("agent_aht")
    ),
    "SELECT conversation_id, agent_id, agent_bp, agent_aht FROM mt",
)


def first_match(c: Context):
    """Categories of the busiest agent, looked up in the merged list of the conversation."""
    chats = c.calculated.where(filters.is_chat_segment()).groupBy("conversation_id").agg(
        *[arrays.merge_arrays(F.col(x)).alias(x) for x in ("skill_lookup", "all_agents")]
    )
    agent = arrays.busiest_agent(F.col("skill_lookup"))
    own = arrays.categories_of(F.col("all_agents"), F.col("agent_id"))
    return (
        chats.withColumn("agent_id", agent)
        .withColumn("own", own)
        .where(F.col("own").isNotNull())
        .select("conversation_id", *[f"own.{level}" for level in segments.LEVELS])
    )


register(
    "first_matching_element",
    first_match,
    "SELECT conversation_id, first_category, second_category, third_category FROM chat_winner_cat",
)
register(
    "order_by_output",
    lambda c: c.src["segments"].groupBy("factory_name").agg(F.sum("talk_time_second").alias("talk")).orderBy(F.desc("talk"), "factory_name"),
    "SELECT factory_name, sum(talk_time_second) AS talk FROM in_segments GROUP BY ALL ORDER BY talk DESC, factory_name",
)

# ---- unions --------------------------------------------------------------------------

register(
    "union_all_categories",
    lambda c: c.categories,
    "SELECT conversation_id, agent_id, first_category, second_category, third_category FROM cat_all",
)
register(
    "union_distinct_logs",
    lambda c: results.process_log(c.src, c.p),
    "SELECT conversation_id, participant_id, agent_bp_number FROM log_one",
)
register(
    "union_all_channels",
    lambda c: flat(
        segments.calls_and_bots(
            segments.segments_categorised(c.segments, c.best_categories), c.bots
        )
    ),
    f"""SELECT conversation_id, call_date, {names_sql('skill_name')} AS skill_name, {names_sql('factory_name')} AS factory_name, market_code, channel_type,
               cat_bot, is_human, {segments_sql('skill_lookup')} AS skill_lookup, sag_name, cat_pca, second_category, third_category FROM calls""",
)
register(
    "union_social_rows",
    lambda c: flat(results.social_rows(_demand(c), c.p)),
    f"""SELECT conversation_id, call_date, {names_sql('factory_name')} AS factory_name, channel_type, is_human, canal, zona, factor FROM social""",
)
register(
    "union_split_collapse",
    lambda c: build_intermedia(c.calculated).groupBy("channel_type", "is_human", "mercado").agg(
        F.count("*").alias("n"), F.count_distinct("conversation_id").alias("conversations")
    ),
    "SELECT channel_type, is_human, mercado, count(*) AS n, count(DISTINCT conversation_id) AS conversations FROM inter GROUP BY ALL",
)
register("union_periods", _demand, "SELECT mes, canal, zona, is_human, valor FROM dem")
register(
    "union_fcr",
    lambda c: union_all(c.src["voice_resolution"], c.src["whatsapp_resolution"]).drop("load_datetime"),
    """SELECT conversation_id, participant_id, is_first_call_resolution, reason_resolution_fcr
       FROM (FROM in_voice_resolution UNION ALL FROM in_whatsapp_resolution)""",
)
register(
    "unpivot_demand",
    lambda c: unpivot_measures(
        c.src["demand_wide"].groupBy("mes").agg(*[F.sum(m).alias(k) for k, m in scaling.WIDE_MEASURES.items()]),
        ["mes"],
        list(scaling.WIDE_MEASURES),
        "canal",
        "valor",
    ),
    """SELECT mes, canal, valor FROM (SELECT mes, sum(demanda_voz_agente) AS voz, sum(wa) AS wsp, sum(livechat) AS chat, sum(casos_validado_com_gabi) AS cases,
              sum(redes_sociales) AS rrss FROM in_demand_wide GROUP BY mes)
       UNPIVOT (valor FOR canal IN (voz, wsp, chat, cases, rrss))""",
)
register(
    "union_hr_history",
    lambda c: union_all(c.src["hr_history"], c.src["hr_daily"]),
    "FROM in_hr_history UNION ALL FROM in_hr_daily",
)
register(
    "union_distinct_people",
    lambda c: union_distinct(c.src["hr_history"].select("bp_num"), c.src["hr_daily"].select("bp_num")),
    "SELECT bp_num FROM in_hr_history UNION SELECT bp_num FROM in_hr_daily",
)


def collapsed(c: Context):
    return flat(collapse_conversations(c.calculated.where(filters.is_chat_segment())))


register(
    "conversation_collapse",
    collapsed,
    f"""SELECT conversation_id, {names_sql('skill_name')} AS skill_name, {names_sql('factory_name')} AS factory_name,
               {segments_sql('skill_lookup')} AS skill_lookup, {agents_sql('all_agents')} AS all_agents, call_date, market_code, channel_type, cat_bot,
               is_human, mercado, sag_name, cat_pca, second_category, third_category FROM chat_merged""",
)
register(
    "agents_per_conversation",
    lambda c: aggregates.agents_per_conversation(c.categories).select(
        "conversation_id", F.size("all_agents").alias("n"), agents_text("all_agents").alias("all_agents")
    ),
    f"SELECT conversation_id, CAST(len(all_agents) AS INTEGER) AS n, {agents_sql('all_agents')} AS all_agents FROM cat_list",
)
register(
    "segments_per_conversation",
    lambda c: _packed(c)
    .groupBy("conversation_id")
    .agg(arrays.merge_arrays(F.col("skill_lookup")).alias("skill_lookup"))
    .select("conversation_id", segments_text("skill_lookup").alias("skill_lookup")),
    f"""SELECT conversation_id, {segments_sql('skill_lookup')} AS skill_lookup
        FROM (SELECT conversation_id, list_distinct(flatten(list(skill_lookup))) AS skill_lookup FROM seg_cat GROUP BY ALL)""",
)
