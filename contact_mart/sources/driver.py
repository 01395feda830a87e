"""The driver's tables dressed as the mart's inputs.

Each input is one SELECT over whole driver tables. The texts use only what Spark and
DuckDB share (integer arithmetic, concatenation, CASE), so that both engines derive
the same rows: Spark for the queries, DuckDB for the checks.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from contact_mart.params import SYSTEM_AGENT, Params
from contact_mart.sources.catalog import Sources

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

PARAMS = Params(
    as_of=date(2001, 6, 15),
    min_date=date(1995, 2, 1),
    cutover=date(1999, 1, 1),
    factories=tuple(f"F{n}" for n in range(8)),
    denied_queues=("Q_7", "Q_13"),
)


def _pick(key: str, *values: str | None) -> str:
    """CASE over ``key % n``."""
    arms = " ".join(
        f"WHEN {n} THEN {'NULL' if v is None else chr(39) + v + chr(39)}" for n, v in enumerate(values)
    )
    return f"(CASE {key} % {len(values)} {arms} END)"


def _category(key: str) -> str:
    return _pick(
        key, "VENTAS", "OTROS", "MASCOTAS", "SIN_CONTEXTO", "UPG", "ENDOSO", "FFP", "zzz", None, "CHECK_IN"
    )


_CHANNEL = (
    "(CASE o_orderpriority WHEN '2-HIGH' THEN 'voice' WHEN '3-MEDIUM' THEN 'whatsapp' "
    "WHEN '4-NOT SPECIFIED' THEN 'webmessaging' WHEN '5-LOW' THEN 'open' END)"
)
_SPOKEN = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
_LINES = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey"
_SUPPLIERS = "(SELECT count(*) FROM {supplier})"
_PERIOD = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT)"
_DAY = "(DATE '1995-01-01' + CAST({key} % 2400 AS INT))"
_PARTICIPANT = "'p' || l_orderkey || '_' || l_suppkey"


def _day(key: str) -> str:
    return _DAY.replace("{key}", key)


def _lines_categories(spoken: bool) -> str:
    return f"""
SELECT 'c' || l_orderkey AS conversation_id,
       CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE {_PARTICIPANT} END AS participant_id,
       {_category('l_partkey')} AS first_category,
       {_pick('l_partkey', None, 'S1', 'FRANQUICIA_EQUIPAJE', 'S3', 'S4', 'INFO_VUELO')} AS second_category,
       'T' || (l_partkey % 4) AS third_category,
       o_orderdate + INTERVAL '1' DAY AS load_datetime
FROM {_LINES} WHERE {'' if spoken else 'NOT '}{_SPOKEN}"""


def _log(condition: str) -> str:
    return f"""
SELECT 'c' || l_orderkey AS conversation_id, {_PARTICIPANT} AS participant_id,
       CASE WHEN l_partkey % 43 = 0 THEN 'none' ELSE CAST(1000 + l_suppkey AS STRING) END AS agent_bp_number,
       o_orderdate + INTERVAL '1' HOUR * l_linenumber AS load_datetime
FROM {_LINES} WHERE {condition}"""


def _resolution(spoken: bool) -> str:
    return f"""
SELECT 'c' || l_orderkey AS conversation_id,
       CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE {_PARTICIPANT} END AS participant_id,
       {_pick('l_partkey', 'true', ' false ', None, 'unknown', '\ttrue', 'false\n')} AS is_first_call_resolution,
       'reason ' || (l_partkey % 6) AS reason_resolution_fcr,
       o_orderdate + INTERVAL '1' HOUR * l_linenumber AS load_datetime
FROM {_LINES} WHERE {'' if spoken else 'NOT '}{_SPOKEN}"""


_WEIGHTS = ", ".join(
    f"CASE WHEN (l_partkey + {n}) % 9 = 0 THEN NULL ELSE CAST((l_partkey + {n}) % 5 AS DOUBLE) END AS {name}"
    for n, name in enumerate(
        (
            "m1_welcome_weight", "m2_inquiry_weight", "m3_empathy_weight", "m4_expectation_adjustment_weight",
            "m5_management_weight", "m6_information_provision_weight", "m7_service_confirmation_weight",
            "m8_farewell_weight",
        )
    )
)

_MONTH_LABEL = (
    "(CASE month(o_orderdate) WHEN 1 THEN 'Ene' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr' "
    "WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep' "
    "WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' ELSE 'Dec' END || lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0'))"
)

INPUTS = {
    "segments": f"""
SELECT 'c' || l_orderkey AS conversation_id, CAST(o_orderdate AS DATE) AS conversation_date,
       CASE WHEN l_partkey % 97 = 0 THEN NULL
            WHEN l_partkey % 41 = 0 THEN 'Q_Cargo_' || (l_partkey % 40)
            WHEN l_partkey % 15 = 0 THEN 'Q_' || (l_partkey % 40) || '\u00a0\n'
            WHEN l_partkey % 5 = 0 THEN 'Q_' || (l_partkey % 40) || ' '
            ELSE 'Q_' || (l_partkey % 40) END AS queue_name,
       'F' || (l_suppkey % 10) AS factory_name,
       CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE l_quantity * 10 END AS talk_time_second,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber * 5 AS DOUBLE) END AS held_time_second,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(2 AS DOUBLE) END AS after_call_work_time_second,
       {_CHANNEL} AS message_type,
       1000 + l_suppkey AS agent_bp_number,
       CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE 'a' || l_suppkey END AS agent_id,
       'SAG_' || (l_suppkey % 5) AS sag_name,
       CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'outbound' ELSE 'inbound' END AS originating_direction_type
FROM {_LINES}""",
    "queue_dictionary": """
SELECT CASE WHEN p_partkey % 7 = 0 THEN '\t ' ELSE '' END || 'Q_' || (p_partkey % 40) AS Nombre_de_Cola,
       'canal ' || (p_partkey % 3) AS Canal_de_Atencion, p_type AS Departamento_SAG, p_brand AS Division,
       'fab ' || (p_partkey % 6) AS Fabrica,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE 'ID' || p_partkey END AS ID_Cola,
       CASE WHEN p_partkey % 2 = 0 THEN 'SI' ELSE 'NO' END AS Cola_con_Demanda,
       p_brand AS Jefatura,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END AS SubGerente,
       CASE WHEN p_size % 3 = 0 THEN 'N/A' ELSE p_brand END AS Gerencia,
       CASE WHEN p_size % 6 = 0 THEN NULL ELSE 'script ' || (p_partkey % 9) END AS Script,
       'S' || p_partkey AS ID_Script
FROM {part}""",
    "bot_sessions": f"""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'c' ELSE 'x' END || o_orderkey AS conversation_id,
       'e' || o_orderkey AS entity_id, CAST(o_custkey AS STRING) AS customer_id,
       o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24) AS conversation_start_datetime,
       {_pick('o_orderkey', 'BR', 'CL', 'AR', 'PE', 'PT', None)} AS market_code,
       {_pick('o_orderkey', 'voice', 'message')} AS channel_type,
       CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 1 END AS is_voicebot,
       CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS is_has_queue,
       'intent' AS intent_type,
       {_category('o_orderkey')} AS category_voicebot_typification,
       {_pick('o_orderkey', 'SEAT_ASSIGNMENT_PROBLEM', 'CHECK_IN_ERROR', 'CHECK_IN_REQUEST')} AS voicebot_category_process,
       CASE WHEN o_orderkey % 23 = 0 THEN 'outbound' ELSE 'inbound' END AS originating_direction_type,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(1000 + o_custkey % 100 AS STRING) END AS bp_agent_transferred_bot
FROM {{orders}}
UNION ALL
SELECT CASE WHEN event_id % 50 = 0 THEN 'c' ELSE 'b' END || event_id,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'e' || user_id END, CAST(user_id AS STRING),
       CAST({_day('event_id')} AS TIMESTAMP),
       {_pick('event_id', 'BR', 'UK', 'CO', 'CHILE', None, 'SSC')},
       {_pick('event_id', 'voice', 'message', 'email')},
       CASE WHEN event_id % 11 = 0 THEN 0 ELSE 1 END,
       CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END,
       event_type,
       {_category('event_id')},
       {_pick('event_id', 'SEAT_ASSIGNMENT_PROBLEM', 'CHECK_IN_ERROR')},
       'inbound',
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(user_id AS STRING) END
FROM {{events}}""",
    "participant_sessions": f"""
SELECT 'c' || l_orderkey AS conversation_id, {_PARTICIPANT} AS participant_id, 'a' || l_suppkey AS user_id,
       CASE WHEN l_linenumber = 6 THEN 'customer' ELSE 'agent' END AS purpose,
       o_orderdate + INTERVAL '1' HOUR * l_linenumber AS load_datetime
FROM {_LINES}
UNION ALL
SELECT 'c' || l_orderkey, 'a' || l_suppkey, 'a' || l_suppkey,
       CASE WHEN l_linenumber = 6 THEN 'customer' ELSE 'agent' END,
       o_orderdate + INTERVAL '1' HOUR * l_linenumber
FROM {_LINES}""",
    "voice_categories": _lines_categories(True),
    "text_categories": _lines_categories(False),
    "tickets": f"""
SELECT 't' || doc_id AS ticket_id,
       CASE WHEN doc_id % 10 = 0 THEN 'HVC KON BR' WHEN doc_id % 10 = 1 THEN 'Soporte X' ELSE 'G' || (doc_id % 4) END AS agent_group_name,
       CASE WHEN doc_id % 6 = 0 THEN NULL ELSE 'F' || (doc_id % 8) END AS factory_name,
       CASE WHEN lang = 'es' THEN 'PT-BR' ELSE upper(lang) END AS language_name,
       CASE WHEN doc_id % 4 = 0 THEN 'Special Services' ELSE 'web' END AS contact_form_name,
       CASE WHEN doc_id % 37 = 0 THEN '{SYSTEM_AGENT.title()}' ELSE 'Agent ' || (doc_id % 50) END AS agent_name,
       CASE WHEN doc_id % 31 = 0 THEN 'a test gope b' ELSE source END AS subject_desc,
       CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN 'x project_child y'
            WHEN doc_id % 29 = 0 THEN 'multiquebrado' ELSE 'a' END AS tag_list,
       {_category('doc_id')} AS claim_ai_typification,
       {_category('(doc_id + 3)')} AS claim_ai_subtypification,
       'U' || (doc_id % 120) || '@x.test' AS agent_email,
       CAST({_day('doc_id')} AS TIMESTAMP) AS created_dt,
       CAST({_day('doc_id')} AS TIMESTAMP) + INTERVAL '1' SECOND * (doc_id % 30) AS solved_dt
FROM {{documents}}
UNION ALL
SELECT 't' || doc_id, 'G' || quality, NULL, CASE WHEN toxic = 1 THEN 'PT' ELSE 'EN' END, 'web', 'Agent', 'subject', 'a',
       {_category('(doc_id + quality)')}, CASE WHEN toxic = 1 THEN NULL ELSE 'RECLAMOS' END,
       'U' || (doc_id % 120) || '@x.test',
       CAST({_day('doc_id')} AS TIMESTAMP) + INTERVAL '1' DAY * 20,
       CAST({_day('doc_id')} AS TIMESTAMP) + INTERVAL '1' DAY * 21
FROM {{labels}}""",
    "staff_snapshots": f"""
SELECT CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE 'a' || k END AS agent_id,
       'u' || k || '@X.test' AS agent_email,
       CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE 1000 + k END AS agent_bp_number,
       9000 + (k + o_orderkey) % 7 AS supervisor_bp_number,
       period_id, load_datetime
FROM (SELECT o_orderkey, o_custkey % {_SUPPLIERS} AS k, {_PERIOD} AS period_id, o_orderdate AS load_datetime FROM {{orders}}) snapshots""",
    "hr_history": f"""
SELECT 1000 + k AS bp_num, CASE WHEN k % 15 = 3 THEN NULL ELSE 'U' || k || '@x.TEST' END AS employee_email,
       DATE '1996-01-01' + CAST(c_custkey % 997 AS INT) AS load_dt,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE DATE '1995-06-01' + CAST(k % 2000 AS INT) END AS entry_company_date
FROM (SELECT c_custkey, c_custkey % (SELECT count(*) FROM {{supplier}}) AS k FROM {{customer}}) people""",
    "hr_daily": """
SELECT 1000 + s_suppkey AS bp_num, 'U' || s_suppkey || '@x.test' AS employee_email,
       DATE '2000-06-01' + CAST(s_suppkey % 300 AS INT) AS load_dt,
       CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE DATE '2001-01-01' + CAST(s_suppkey % 150 AS INT) END AS entry_company_date
FROM {supplier}""",
    "queue_country": f"""
SELECT DISTINCT 'Q_' || (p_partkey % 40) AS sagg,
       CASE WHEN p_partkey % 40 = 1 AND p_size > 25 THEN 'pe' ELSE {_pick('(p_partkey % 40)', 'br', 'cl', 'ar')} END AS country
FROM {{part}}""",
    "demand_wide": f"""
SELECT {_MONTH_LABEL} AS mes, count(*) * CAST(1.5 AS DOUBLE) AS demanda_voz_agente, count(*) * CAST(1.25 AS DOUBLE) AS wa,
       CASE WHEN {_MONTH_LABEL} = 'Mar96' THEN NULL ELSE count(*) * CAST(2 AS DOUBLE) END AS livechat,
       count(*) * CAST(0.5 AS DOUBLE) AS casos_validado_com_gabi,
       count(*) * CAST(0.25 AS DOUBLE) AS redes_sociales
FROM {{orders}}
GROUP BY {_MONTH_LABEL}, o_orderpriority""",
    "demand_daily": f"""
SELECT CAST(o_orderdate AS DATE) AS date,
       {_pick('o_custkey', 'Calls', 'WhatsApp Agent', 'Chat Web', 'Cases', 'Social Media', 'Voice Bot', 'WhatsApp Bot', 'Email')} AS channel,
       {_pick('o_orderkey', 'br', 'BR', 'CL')} AS country,
       CAST(1 + o_orderkey % 5 AS DOUBLE) AS N_R
FROM {{orders}}""",
    "chat_indicators": f"""
SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'c' ELSE 'y' END || o_orderkey AS conversationid,
       {_pick('o_orderkey', ' VENTAS ', 'LOGIN', 'zzz ', None, '\u00a0LOGIN\n')} AS tip,
       {_pick('o_orderkey', 'resuelve \n', 'deriva', 'crea caso', 'agente deja de contestar', 'short', ' no se puede hacer', 'posterga', 'falla sistema', 'recontacto', 'no se puede determinar', 'other', None)} AS fcr_ai
FROM {{orders}}
UNION ALL
SELECT 'c' || event_id, {_pick('event_id', 'LOGIN', 'CANJE')}, {_pick('event_id', 'resuelve', 'deriva', None)}
FROM {{events}}""",
    "ticket_categories": f"""
SELECT CASE WHEN doc_id % 4 = 0 THEN 'z' ELSE 't' END || doc_id AS conversation_id,
       {_category('(doc_id + 5)')} AS first_category, 'TS' || (doc_id % 3) AS second_category,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'TT' || (doc_id % 2) END AS third_category,
       CAST({_day('doc_id')} AS TIMESTAMP) AS load_datetime
FROM {{documents}}
UNION ALL
SELECT 't' || doc_id, CASE WHEN quality = 1 THEN 'LOGIN' ELSE NULL END, 'LS', NULL,
       CAST({_day('doc_id')} AS TIMESTAMP)
FROM {{labels}}""",
    "surveys": f"""
SELECT 'c' || l_orderkey AS conversation_id,
       CASE WHEN l_orderkey % 19 = 0 THEN 'n/a' ELSE CAST(1000 + min(l_suppkey) AS STRING) END AS advisor_bp_number,
       'contact ' || (l_orderkey % 5) AS last_sag_contact_description,
       {_pick('l_orderkey', '0', '1', '2', '3', '4', '5', '6', '7', '8', '9', '10', 'x', None)} AS nps
FROM {{lineitem}} GROUP BY l_orderkey
UNION ALL
SELECT CASE WHEN event_id % 4 = 0 THEN 'c' ELSE 'b' END || event_id, CAST(1000 + user_id AS STRING), 'second',
       {_pick('event_id', '10', '9', '7', '2', '8', '10', '5')}
FROM {{events}}
UNION ALL
SELECT 't' || doc_id, NULL, 'ticket', {_pick('doc_id', '9', '3', '8', '10', None)}
FROM {{documents}}""",
    "retention_flags": """
SELECT 'c' || o_orderkey AS conversation_id, CAST(o_orderkey % 4 AS INT) AS is_hvc, CAST(o_orderkey % 2 AS INT) AS is_recontact,
       o_orderdate AS conversation_start_dt
FROM {orders}""",
    "audio_process": _log(_SPOKEN),
    "text_process": _log("o_orderpriority = '5-LOW'"),
    "whatsapp_process": _log("o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"),
    "agent_names": """
SELECT 1000 + k AS agent_bp_number, c_name AS agent_name, DATE '1996-01-01' + CAST(c_custkey % 500 AS INT) AS load_date,
       'a' || k AS agent_id, 9000 + k % 5 AS supervisor_bp_number
FROM (SELECT c_custkey, c_name, c_custkey % (SELECT count(*) FROM {supplier}) AS k FROM {customer}) people""",
    "voice_resolution": _resolution(True),
    "whatsapp_resolution": _resolution(False),
    "ticket_resolution": f"""
SELECT 't' || doc_id AS conversation_id, CAST(NULL AS STRING) AS participant_id,
       {_pick('doc_id', 'true', 'false', ' true \n', None)} AS is_first_call_resolution,
       CASE WHEN doc_id % 6 = 0 THEN NULL ELSE 'ticket reason ' || (doc_id % 6) END AS reason_resolution_fcr,
       CAST({_day('doc_id')} AS TIMESTAMP) AS load_datetime
FROM {{documents}}
UNION ALL
SELECT 't' || doc_id, NULL, CASE WHEN quality = 1 THEN 'true' ELSE 'false' END, 'labelled',
       CAST({_day('doc_id')} AS TIMESTAMP)
FROM {{labels}}""",
    "compliance": f"""
SELECT 'c' || l_orderkey AS conversation_id,
       CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE {_PARTICIPANT} END AS participant_id, {_WEIGHTS}
FROM {{lineitem}}""",
    "recontact": """
SELECT CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 6 = 1 THEN 'guest' ELSE CAST(user_id AS STRING) END AS customer_id,
       CASE WHEN event_id % 4 <> 0 THEN NULL ELSE 'e' || user_id END AS entity_id,
       CASE WHEN event_id % 5 <> 0 THEN NULL ELSE 'phone ' || user_id END AS customer_phone,
       'r' || event_id AS record_id,
       CASE WHEN next_ts < ts + INTERVAL '1' DAY THEN 1 ELSE 0 END AS is_recontact_24_hrs,
       ts AS creation_datetime, event_type AS channel, event_type AS contact_channel_name,
       'F' || (user_id % 8) AS factory_name, 'G' || (user_id % 3) AS service_agent_group_name,
       CAST(1000 + user_id AS STRING) AS employee_bp_number, next_type AS next_contact_channel_name,
       'r' || next_id AS next_record_id, next_ts AS next_creation_datetime, CAST(event_id % 2 AS INT) AS is_recontact_origin
FROM (SELECT event_id, user_id, ts, event_type,
             lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts,
             lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_id,
             lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type
      FROM {events}) followed""",
    "queue_performance": """
SELECT CAST(l_shipdate AS DATE) AS effective_start_date_utc, l_extendedprice AS handletime_seconds,
       CAST(l_quantity AS BIGINT) AS handle_qty
FROM {lineitem}""",
    "dialogues": """
SELECT 'b' || conv_id AS id, text AS dialog FROM {conversations}
UNION ALL
SELECT 'x' || doc_id, CASE WHEN doc_id % 8 = 0 THEN NULL ELSE text END FROM {documents}""",
    "summaries": f"""
SELECT 'c' || doc_id AS conversation_id, text AS agent_action_description,
       CASE WHEN doc_id % 9 = 0 THEN NULL ELSE source END AS call_reason, lang AS resolution_status,
       CAST({_day('doc_id')} AS TIMESTAMP) AS load_datetime,
       'first ' || (doc_id % 4) AS first_comment_category,
       CASE WHEN doc_id % 10 = 0 THEN NULL ELSE 'second' END AS second_category_comment, 'third' AS third_category_comment
FROM {{documents}}""",
    "bot_transcriptions": "SELECT 'c' || (event_id % 2000) AS conversation_id FROM {events}",
}


def spark_text(name: str) -> str:
    return re.sub(r"AS TIMESTAMP\)", "AS TIMESTAMP_NTZ)", INPUTS[name])


def duckdb_text(name: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", INPUTS[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def driver_sources(spark: SparkSession, sf_dir: str) -> Sources:
    def load(name: str) -> DataFrame:
        text = spark_text(name)
        used = sorted(set(re.findall(r"\{(\w+)\}", text)))
        return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})

    return Sources(load)
