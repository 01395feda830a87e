"""DuckDB steps: every layer written once more as plain SQL, for comparison only.

``compose`` turns a final SELECT into one statement with all steps it needs.
"""

from __future__ import annotations

import re

from contact_mart.operators.lookups import CATEGORIES, COUNTRIES, DEMAND_CHANNELS, first_owner
from contact_mart.params import DENIED_FORMS, MONTH_LABELS, SYSTEM_AGENT
from contact_mart.sources.driver import INPUTS, PARAMS, duckdb_text


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def rows_of(pairs) -> str:
    return ", ".join(f"({quoted(row)})" for row in pairs)


AS_OF = f"DATE '{PARAMS.as_of}'"
MIN = f"DATE '{PARAMS.min_date}'"
CUT = f"DATE '{PARAMS.cutover}'"
CUT_MONTH = f"'{PARAMS.cutover_month}'"


def ym(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m') AS INTEGER)"


def bare(column: str) -> str:
    """The text without Unicode white space at its ends."""
    space = r"[\s\p{Z}\x0B\x{85}]+"
    return f"regexp_replace({column}, '^{space}|{space}$', '', 'g')"


def gap(period: str, day: str) -> str:
    return f"abs(({period} // 100 - year({day})) * 12 + {period} % 100 - month({day}))"


def generic(column: str) -> str:
    return f"CASE WHEN {column} IN ('OTROS', 'SIN_CONTEXTO') THEN 1 ELSE 0 END"


def names_text(column: str) -> str:
    return f"CASE WHEN {column} IS NOT NULL THEN coalesce(array_to_string(list_sort(list_transform({column}, lambda e: coalesce(e, '~'))), '|'), '') END"


def agents_text(column: str) -> str:
    one = " || '/' || ".join(
        f"coalesce(e.{f}, '~')" for f in ("agent_id", "first_category", "second_category", "third_category")
    )
    return f"CASE WHEN {column} IS NOT NULL THEN coalesce(array_to_string(list_sort(list_transform({column}, lambda e: {one})), '|'), '') END"


SEGMENT_FIELDS = (
    "skill_name", "bp_executive_num", "agent_id", "aht", "Canal_de_Atencion", "Departamento_SAG", "Division",
    "Fabrica_dic", "ID_Cola", "Cola_con_Demanda", "Jefatura", "SubGerente", "Gerencia", "Script", "ID_Script",
)


def segments_text(column: str) -> str:
    parts = []
    for f in SEGMENT_FIELDS:
        value = f"CAST(CAST(e.{f} AS BIGINT) AS VARCHAR)" if f in ("aht", "bp_executive_num") else f"e.{f}"
        parts.append(f"coalesce({value}, '~')")
    one = " || '/' || ".join(parts)
    return f"CASE WHEN {column} IS NOT NULL THEN coalesce(array_to_string(list_sort(list_transform({column}, lambda e: {one})), '|'), '') END"


_LEVELS = "first_category, second_category, third_category"
_LEVEL_ORDER = "first_category NULLS FIRST, second_category NULLS FIRST, third_category NULLS FIRST"
_HOLDS = "{0} IS NOT NULL AND {0} <> 'N/A'"


def _filled(column: str) -> str:
    return f"CASE WHEN {_HOLDS.format(column)} THEN 0 ELSE 1 END"


_DICTIONARY = (
    "ID_Cola", "Nombre_de_Cola", "Canal_de_Atencion", "Departamento_SAG", "Division", "Fabrica",
    "Cola_con_Demanda", "Jefatura", "SubGerente", "Gerencia", "Script", "ID_Script",
)

STEPS: dict[str, str] = {f"in_{name}": duckdb_text(name) for name in INPUTS}

STEPS |= {
    "seg_kept": f"""
        SELECT * FROM in_segments
        WHERE conversation_date BETWEEN {MIN} AND {AS_OF} AND factory_name IN ({quoted(PARAMS.factories)})
          AND originating_direction_type = 'inbound' AND talk_time_second IS NOT NULL
          AND NOT contains(upper(queue_name), 'CARGO') AND {bare('queue_name')} NOT IN ({quoted(PARAMS.denied_queues)})""",
    "seg_one": """
        SELECT DISTINCT conversation_id, conversation_date AS call_date, queue_name AS skill_name, factory_name,
               talk_time_second + coalesce(held_time_second, 0) + coalesce(after_call_work_time_second, 0) AS aht,
               message_type, agent_bp_number AS bp_executive_num, agent_id, sag_name
        FROM seg_kept""",
    "queue_one": f"""
        SELECT {bare('Nombre_de_Cola')} AS queue_key, * EXCLUDE (Nombre_de_Cola, Fabrica), Fabrica AS Fabrica_dic
        FROM in_queue_dictionary
        QUALIFY row_number() OVER (PARTITION BY {bare('Nombre_de_Cola')} ORDER BY {_filled('Gerencia')}, {_filled('ID_Cola')},
            CASE WHEN Cola_con_Demanda = 'SI' THEN 0 ELSE 1 END, {_filled('SubGerente')}, {_filled('Script')},
            {', '.join(c + ' NULLS FIRST' for c in _DICTIONARY)}) = 1""",
    "market_one": f"""
        SELECT conversation_id, min(market_code) AS market_code FROM in_bot_sessions
        WHERE conversation_start_datetime >= {MIN} AND conversation_start_datetime < {AS_OF} + 1 GROUP BY ALL""",
    "seg_rich": f"""
        SELECT s.*, q.* EXCLUDE (queue_key), m.market_code FROM seg_one s
        LEFT JOIN queue_one q ON q.queue_key = {bare('s.skill_name')} LEFT JOIN market_one m USING (conversation_id)""",
    "user_one": "SELECT participant_id, max(user_id) AS agent_id FROM in_participant_sessions GROUP BY ALL",
    "cat_all": f"""
        SELECT c.conversation_id, u.agent_id, {_LEVELS}
        FROM (FROM in_voice_categories UNION ALL FROM in_text_categories) c LEFT JOIN user_one u USING (participant_id)
        WHERE load_datetime >= {MIN} AND load_datetime < {AS_OF}""",
    "cat_best": f"""
        SELECT * FROM cat_all QUALIFY row_number() OVER (PARTITION BY conversation_id, agent_id
            ORDER BY {generic('first_category')}, {_LEVEL_ORDER}) = 1""",
    "cat_list": f"""
        SELECT conversation_id, list({{'agent_id': agent_id, 'first_category': first_category,
               'second_category': second_category, 'third_category': third_category}}
               ORDER BY {generic('first_category')}, agent_id NULLS FIRST, {_LEVEL_ORDER}) AS all_agents
        FROM cat_all GROUP BY ALL""",
    "seg_cat": f"""
        SELECT s.conversation_id, call_date, [skill_name] AS skill_name, [factory_name] AS factory_name, market_code,
               message_type, sag_name,
               [struct_pack({', '.join(f'{f} := s.{f}' for f in SEGMENT_FIELDS)})] AS skill_lookup,
               coalesce(e.first_category, o.first_category) AS first_category,
               coalesce(e.second_category, o.second_category) AS second_category,
               coalesce(e.third_category, o.third_category) AS third_category
        FROM seg_rich s
        LEFT JOIN cat_best e ON e.conversation_id = s.conversation_id AND e.agent_id = s.agent_id
        LEFT JOIN (FROM cat_best WHERE agent_id IS NULL) o ON o.conversation_id = s.conversation_id""",
    "ticket_kept": f"""
        SELECT * FROM in_tickets
        WHERE created_dt >= {MIN}
          AND NOT regexp_matches(tag_list, 'monoquebrado|multiquebrado') AND NOT contains(tag_list, 'project_child')
          AND upper(agent_name) <> '{SYSTEM_AGENT}' AND NOT contains(upper(subject_desc), 'TEST GOPE')
          AND NOT regexp_matches(agent_group_name, '(?i)SOPORTE|SUPORTE')
          AND date_diff('second', created_dt, solved_dt) > 10
          AND CASE WHEN agent_group_name = 'HVC KON BR' THEN upper(contact_form_name) = 'SPECIAL SERVICES'
                   ELSE upper(contact_form_name) NOT IN ({quoted(DENIED_FORMS)}) END""",
    "ticket_staff": f"""
        SELECT t.ticket_id, s.agent_bp_number, s.agent_id
        FROM in_tickets t JOIN in_staff_snapshots s ON lower(t.agent_email) = lower(s.agent_email)
        QUALIFY row_number() OVER (PARTITION BY t.ticket_id ORDER BY {gap('s.period_id', 't.created_dt')} NULLS FIRST,
            CASE WHEN s.period_id >= {ym('t.created_dt')} THEN 0 ELSE 1 END, s.load_datetime DESC NULLS LAST,
            s.agent_bp_number NULLS FIRST, s.agent_id NULLS FIRST) = 1""",
    "hr_one": """
        SELECT bp_num, lower(employee_email) AS employee_email FROM in_hr_history WHERE employee_email IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY lower(employee_email) ORDER BY load_dt DESC NULLS LAST, bp_num) = 1""",
    "ticket_rich": """
        SELECT t.ticket_id, created_dt, agent_group_name, factory_name,
               CASE WHEN starts_with(language_name, 'PT') THEN 'BR' ELSE 'SSC' END AS language_name,
               claim_ai_typification, claim_ai_subtypification,
               coalesce(s.agent_bp_number, h.bp_num) AS agent_bp_number, s.agent_id, t.agent_email
        FROM ticket_kept t LEFT JOIN ticket_staff s USING (ticket_id)
        LEFT JOIN hr_one h ON h.employee_email = lower(t.agent_email)""",
    "ticket_one": f"""
        SELECT ticket_id AS conversation_id, CAST(min(created_dt) AS DATE) AS call_date,
               list(DISTINCT agent_group_name) AS skill_name, list(DISTINCT coalesce(factory_name, 'NO_FACTORY')) AS factory_name,
               max_by(language_name, (created_dt, language_name)) AS market_code, 'cases' AS channel_type,
               max_by(claim_ai_typification, (created_dt, claim_ai_typification)) FILTER (claim_ai_typification IS NOT NULL) AS cat_bot,
               'HUMAN' AS is_human,
               [struct_pack({', '.join(
                   f"{f} := " + {'bp_executive_num': 'agent_bp_number', 'agent_id': 'min(agent_id)', 'aht': 'CAST(NULL AS DOUBLE)',
                                 'Canal_de_Atencion': "'cases'"}.get(f, 'CAST(NULL AS VARCHAR)') for f in SEGMENT_FIELDS)})] AS skill_lookup,
               max_by(claim_ai_subtypification, (created_dt, claim_ai_subtypification)) FILTER (claim_ai_subtypification IS NOT NULL) AS cat_pca,
               agent_email
        FROM ticket_rich GROUP BY ticket_id, agent_bp_number, agent_email""",
    "bot_kept": f"""
        SELECT conversation_id, CAST(conversation_start_datetime AS DATE) AS call_date, market_code, channel_type,
               category_voicebot_typification AS cat_bot
        FROM in_bot_sessions
        WHERE conversation_start_datetime >= {MIN} AND conversation_start_datetime < {AS_OF}
          AND originating_direction_type = 'inbound' AND is_voicebot = 1 AND is_has_queue = 0 AND channel_type IN ('voice', 'message')""",
    "calls": """
        SELECT coalesce(q.conversation_id, b.conversation_id) AS conversation_id, coalesce(q.call_date, b.call_date) AS call_date,
               q.skill_name, q.factory_name, coalesce(q.market_code, b.market_code) AS market_code,
               coalesce(q.message_type, b.channel_type) AS channel_type, b.cat_bot,
               CASE WHEN q.conversation_id IS NULL THEN 'NOT_HUMAN' WHEN b.conversation_id IS NULL THEN 'HUMAN' ELSE 'BOTH' END AS is_human,
               q.skill_lookup, q.sag_name, q.first_category AS cat_pca, q.second_category, q.third_category
        FROM seg_cat q FULL JOIN (FROM bot_kept WHERE channel_type = 'voice') b ON q.conversation_id = b.conversation_id
        UNION ALL BY NAME
        SELECT conversation_id, call_date, market_code, 'bot_wsp' AS channel_type, cat_bot, 'NOT_HUMAN' AS is_human
        FROM bot_kept WHERE channel_type = 'message'""",
    "cal": """
        SELECT u.conversation_id, call_date, skill_name, factory_name, coalesce(market_code, upper(n.country), 'SSC') AS market_code,
               coalesce(channel_type, 'voice') AS channel_type, cat_bot, is_human, skill_lookup, cat_pca, second_category,
               third_category, all_agents, agent_email, sag_name,
               CASE WHEN market_code = 'BR' THEN 'BR' WHEN market_code IS NOT NULL THEN 'SSC' ELSE coalesce(upper(n.country), 'SSC') END AS mercado
        FROM (SELECT c.*, l.all_agents FROM calls c LEFT JOIN cat_list l USING (conversation_id)
              UNION ALL BY NAME FROM ticket_one) u
        LEFT JOIN in_queue_country n ON n.sagg = list_sort(u.skill_name)[1]""",
    "chat": "SELECT * FROM cal WHERE channel_type IN ('webmessaging', 'whatsapp') AND is_human = 'HUMAN'",
    "chat_arrays": """
        SELECT conversation_id, list_sort(list_distinct(flatten(list(skill_name)))) AS skill_name,
               list_sort(list_distinct(flatten(list(factory_name)))) AS factory_name,
               list_distinct(flatten(list(skill_lookup))) AS skill_lookup,
               list_distinct(flatten(list(all_agents) FILTER (all_agents IS NOT NULL))) AS all_agents
        FROM chat GROUP BY ALL""",
    "chat_one": """
        SELECT * EXCLUDE (skill_name, factory_name, skill_lookup, all_agents, agent_email) FROM chat
        QUALIFY row_number() OVER (PARTITION BY conversation_id ORDER BY call_date, skill_name[1] NULLS FIRST,
            skill_lookup[1].agent_id NULLS FIRST, market_code NULLS FIRST, channel_type NULLS FIRST, cat_bot NULLS FIRST,
            is_human, mercado, sag_name NULLS FIRST, cat_pca NULLS FIRST, second_category NULLS FIRST, third_category NULLS FIRST) = 1""",
    "chat_time": """
        SELECT conversation_id, s.agent_id, sum(s.aht) AS total_aht
        FROM (SELECT conversation_id, unnest(skill_lookup) AS s FROM chat_arrays) WHERE s.agent_id IS NOT NULL GROUP BY ALL""",
    "chat_winner": """
        SELECT conversation_id, agent_id, total_aht FROM chat_time
        QUALIFY row_number() OVER (PARTITION BY conversation_id ORDER BY total_aht DESC NULLS LAST, agent_id) = 1""",
    "chat_winner_cat": f"""
        SELECT w.conversation_id, {_LEVELS}
        FROM chat_winner w JOIN (SELECT conversation_id, unnest(all_agents, recursive := true) FROM chat_arrays) a
          ON a.conversation_id = w.conversation_id AND a.agent_id = w.agent_id
        QUALIFY row_number() OVER (PARTITION BY w.conversation_id ORDER BY {generic('first_category')}, {_LEVEL_ORDER}) = 1""",
    "chat_merged": """
        SELECT o.* EXCLUDE (cat_pca, second_category, third_category), a.skill_name, a.factory_name, a.skill_lookup, a.all_agents,
               coalesce(w.first_category, o.cat_pca) AS cat_pca, coalesce(w.second_category, o.second_category) AS second_category,
               coalesce(w.third_category, o.third_category) AS third_category
        FROM chat_one o JOIN chat_arrays a USING (conversation_id) LEFT JOIN chat_winner_cat w USING (conversation_id)""",
    "inter": """
        SELECT * EXCLUDE (agent_email) FROM cal
        WHERE NOT coalesce(channel_type IN ('webmessaging', 'whatsapp') AND is_human = 'HUMAN', false)
        UNION ALL BY NAME FROM chat_merged""",
    "dem_old": f"""
        SELECT CASE WHEN mes[4:5] >= '90' THEN '19' ELSE '20' END || mes[4:5] || '-' || lpad(CAST(list_position([{quoted(MONTH_LABELS)}], mes[1:3]) AS VARCHAR), 2, '0') AS mes,
               canal, CAST(NULL AS VARCHAR) AS zona, 'HUMAN' AS is_human, valor
        FROM (SELECT mes, sum(demanda_voz_agente) AS voz, sum(wa) AS wsp, sum(livechat) AS chat, sum(casos_validado_com_gabi) AS cases,
                     sum(redes_sociales) AS rrss
              FROM in_demand_wide GROUP BY mes)
        UNPIVOT (valor FOR canal IN (voz, wsp, chat, cases, rrss))
        WHERE CASE WHEN mes[4:5] >= '90' THEN '19' ELSE '20' END || mes[4:5] < strftime({CUT}, '%Y')""",
    "dem_new": f"""
        SELECT strftime(date, '%Y-%m') AS mes, m.canal, CASE WHEN upper(country) = 'BR' THEN 'BR' ELSE 'SSC' END AS zona,
               m.is_human, sum(N_R) AS valor
        FROM in_demand_daily JOIN (VALUES {rows_of((c, *t) for c, t in DEMAND_CHANNELS.items())}) m(channel, canal, is_human) USING (channel)
        WHERE date >= {CUT} GROUP BY ALL""",
    "dem": "FROM dem_old UNION ALL FROM dem_new",
    "mt": """
        SELECT i.* EXCLUDE (mercado), mercado AS zona, top.agent_id AS agent_id, top.bp_executive_num AS agent_bp, top.aht AS agent_aht,
               CASE WHEN channel_type IS NULL OR channel_type IN ('voice', 'CC') THEN 'voz'
                    WHEN channel_type IN ('open', 'whatsapp', 'bot_wsp') THEN 'wsp'
                    WHEN channel_type = 'webmessaging' THEN 'chat' WHEN lower(channel_type) = 'cases' THEN 'cases' END AS canal
        FROM (SELECT *, list_sort(list_transform(skill_lookup, lambda e: {'rank': CASE WHEN e.aht IS NULL THEN 1 ELSE 0 END,
                     'minus': -e.aht, 'agent_id': coalesce(e.agent_id, ''), 'e': e}))[1].e AS top FROM inter) i""",
    "cnt": "SELECT strftime(call_date, '%Y-%m') AS mes, canal, zona, is_human, count(conversation_id) AS valor FROM mt GROUP BY ALL",
    "fac": f"""
        SELECT c.mes, c.canal, c.zona, c.is_human,
               CASE WHEN c.mes < {CUT_MONTH} AND c.is_human = 'NOT_HUMAN' THEN 1.0
                    ELSE coalesce(d.valor / nullif(CASE WHEN c.mes < {CUT_MONTH} THEN c.whole ELSE c.valor END, 0), 0) END AS factor
        FROM (SELECT *, CAST(sum(valor) OVER (PARTITION BY mes, canal, is_human) AS DOUBLE) AS whole FROM cnt) c
        LEFT JOIN dem d ON d.mes = c.mes AND d.canal = c.canal AND d.is_human = c.is_human
          AND CASE WHEN c.mes < {CUT_MONTH} THEN d.zona IS NULL ELSE d.zona = c.zona END""",
    "weighted": """
        SELECT m.*, coalesce(f.factor, 1) AS factor FROM mt m
        LEFT JOIN fac f ON f.canal = m.canal AND f.mes = strftime(m.call_date, '%Y-%m') AND f.is_human = m.is_human
          AND (f.zona IS NULL OR f.zona = m.zona)""",
    "casc": f"""
        SELECT w.* EXCLUDE (second_category, third_category, cat_bot, cat_pca),
               CASE WHEN w.canal = 'cases' THEN t.second_category ELSE w.second_category END AS second_category,
               CASE WHEN w.canal = 'cases' THEN t.third_category ELSE w.third_category END AS third_category,
               coalesce(CASE WHEN w.canal = 'cases' THEN t.first_category END, w.cat_pca, w.cat_bot, i.tip) AS category,
               coalesce(w.canal IN ('cases', 'voz') AND CASE WHEN w.canal = 'cases' THEN t.first_category END IS NULL
                 AND w.cat_pca IS NULL AND coalesce(w.cat_bot, i.tip) IS NOT NULL, false) AS kept_bot_category
        FROM weighted w LEFT JOIN (SELECT DISTINCT conversationid AS conversation_id, {bare('tip')} AS tip FROM in_chat_indicators) i USING (conversation_id)
        LEFT JOIN in_ticket_categories t USING (conversation_id)""",
    "social": """
        SELECT 'rrss' AS conversation_id, CAST(mes || '-01' AS DATE) AS call_date, ['NO_FACTORY'] AS factory_name, canal AS channel_type,
               'HUMAN' AS is_human, canal, zona, valor AS factor, 'NOT_CATEGORIZED' AS category, false AS kept_bot_category
        FROM dem WHERE canal = 'rrss'""",
    "base": f"""
        SELECT c.* EXCLUDE (category), coalesce(h.good, 'NOT_CATEGORIZED') AS category
        FROM (FROM casc UNION ALL BY NAME FROM social) c
        LEFT JOIN (VALUES {rows_of(first_owner(CATEGORIES))}) h(raw, good) ON h.raw = c.category""",
    "log_one": """
        SELECT DISTINCT conversation_id, participant_id, TRY_CAST(agent_bp_number AS BIGINT) AS agent_bp_number
        FROM (FROM in_audio_process UNION ALL FROM in_text_process UNION ALL FROM in_whatsapp_process) WHERE participant_id IS NOT NULL""",
    "staff_by_agent": """
        SELECT * FROM in_staff_snapshots QUALIFY row_number() OVER (PARTITION BY agent_id ORDER BY load_datetime DESC NULLS LAST,
            agent_bp_number NULLS FIRST, supervisor_bp_number NULLS FIRST, period_id) = 1""",
    "staff_by_bp": """
        SELECT * FROM in_staff_snapshots WHERE agent_bp_number IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY agent_bp_number ORDER BY load_datetime DESC NULLS LAST,
            agent_id NULLS FIRST, supervisor_bp_number NULLS FIRST, period_id) = 1""",
    "bridge": """
        SELECT DISTINCT l.conversation_id, l.participant_id, s.agent_id FROM log_one l JOIN staff_by_agent s USING (agent_bp_number)""",
    "name_one": """
        SELECT agent_bp_number, agent_name FROM in_agent_names
        QUALIFY row_number() OVER (PARTITION BY agent_bp_number ORDER BY load_date DESC NULLS LAST, agent_name) = 1""",
    "session_one": f"""
        SELECT p.conversation_id, p.participant_id AS agent_id, s.agent_bp_number, n.agent_name, s.supervisor_bp_number, p.load_datetime
        FROM in_participant_sessions p LEFT JOIN in_staff_snapshots s ON s.agent_id = p.participant_id
        LEFT JOIN name_one n ON n.agent_bp_number = s.agent_bp_number
        WHERE p.purpose = 'agent'
        QUALIFY row_number() OVER (PARTITION BY p.conversation_id, p.participant_id
            ORDER BY {gap('s.period_id', 'p.load_datetime')} NULLS FIRST, CASE WHEN s.period_id >= {ym('p.load_datetime')} THEN 0 ELSE 1 END,
            s.load_datetime DESC NULLS LAST, s.agent_bp_number NULLS FIRST, s.supervisor_bp_number NULLS FIRST, p.load_datetime DESC NULLS LAST) = 1""",
    "agents_agg": """
        SELECT conversation_id, string_agg(DISTINCT CAST(agent_bp_number AS VARCHAR), ',' ORDER BY CAST(agent_bp_number AS VARCHAR)) AS all_agent_bp_numbers,
               string_agg(DISTINCT CAST(supervisor_bp_number AS VARCHAR), ',' ORDER BY CAST(supervisor_bp_number AS VARCHAR)) AS all_supervisor_bp_numbers,
               list(agent_bp_number ORDER BY load_datetime DESC NULLS LAST, agent_bp_number DESC NULLS LAST)[1] AS last_agent_bp_number,
               list(agent_name ORDER BY load_datetime DESC NULLS LAST, agent_name DESC NULLS LAST)[1] AS last_agent_name,
               list(supervisor_bp_number ORDER BY load_datetime DESC NULLS LAST, supervisor_bp_number DESC NULLS LAST)[1] AS last_supervisor_bp_number
        FROM session_one GROUP BY conversation_id""",
    "res_all": f"""
        SELECT * FROM (FROM in_voice_resolution UNION ALL FROM in_whatsapp_resolution)
        WHERE is_first_call_resolution IS NOT NULL AND load_datetime >= {MIN}""",
    "res_one": """
        SELECT r.conversation_id, b.agent_id, is_first_call_resolution, reason_resolution_fcr
        FROM res_all r LEFT JOIN bridge b USING (conversation_id, participant_id)
        QUALIFY row_number() OVER (PARTITION BY r.conversation_id, b.agent_id ORDER BY load_datetime DESC NULLS LAST,
            r.participant_id NULLS FIRST, is_first_call_resolution, reason_resolution_fcr NULLS FIRST) = 1""",
    "qual_one": """
        SELECT c.conversation_id, b.agent_id, coalesce(m1_welcome_weight, 0) + coalesce(m2_inquiry_weight, 0) + coalesce(m3_empathy_weight, 0)
               + coalesce(m4_expectation_adjustment_weight, 0) + coalesce(m5_management_weight, 0) + coalesce(m6_information_provision_weight, 0)
               + coalesce(m7_service_confirmation_weight, 0) + coalesce(m8_farewell_weight, 0) AS nota_calidad
        FROM in_compliance c LEFT JOIN bridge b USING (conversation_id, participant_id)
        QUALIFY row_number() OVER (PARTITION BY c.conversation_id, b.agent_id ORDER BY c.participant_id NULLS FIRST,
            m1_welcome_weight NULLS FIRST, m2_inquiry_weight NULLS FIRST, m3_empathy_weight NULLS FIRST, m4_expectation_adjustment_weight NULLS FIRST,
            m5_management_weight NULLS FIRST, m6_information_provision_weight NULLS FIRST, m7_service_confirmation_weight NULLS FIRST,
            m8_farewell_weight NULLS FIRST) = 1""",
    "boss_by_bp": """
        SELECT agent_bp_number, period_id, supervisor_bp_number FROM in_staff_snapshots WHERE agent_bp_number IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY agent_bp_number, period_id ORDER BY load_datetime DESC NULLS LAST, agent_id NULLS FIRST,
            supervisor_bp_number NULLS FIRST) = 1""",
    "boss_by_id": """
        SELECT agent_id, period_id, supervisor_bp_number FROM in_staff_snapshots WHERE agent_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY agent_id, period_id ORDER BY load_datetime DESC NULLS LAST, agent_bp_number NULLS FIRST,
            supervisor_bp_number NULLS FIRST) = 1""",
    "rich": f"""
        SELECT b.*, coalesce(k.code, 'OT') AS country_code,
               CASE WHEN b.canal = 'voz' THEN b.agent_aht ELSE b.agent_aht / nullif(b.factor, 0) END AS aht, v.nps, b.factor AS factor_pca,
               CASE WHEN b.canal = 'cases' THEN CASE {bare('tr.is_first_call_resolution')} WHEN 'true' THEN 1 WHEN 'false' THEN 0 END
                    WHEN {bare('r.is_first_call_resolution')} IN ('true', 'false') THEN CASE WHEN {bare('r.is_first_call_resolution')} = 'true' THEN 1 ELSE 0 END
                    WHEN {bare('o.fcr_ai')} = 'resuelve' THEN 1
                    WHEN {bare('o.fcr_ai')} IN ('deriva', 'crea caso', 'agente deja de contestar', 'short', 'no se puede hacer', 'posterga',
                                            'falla sistema', 'recontacto', 'no se puede determinar') THEN 0 END AS fcr,
               CASE WHEN b.canal = 'cases' THEN tr.reason_resolution_fcr ELSE r.reason_resolution_fcr END AS reason_resolution_fcr,
               q.nota_calidad, b.agent_bp AS last_agent_bp_number, n.agent_name AS last_agent_name,
               coalesce(s1.supervisor_bp_number, s2.supervisor_bp_number) AS last_supervisor_bp_number,
               g.all_agent_bp_numbers, g.all_supervisor_bp_numbers, t.is_hvc, t.is_recontact
        FROM base b
        LEFT JOIN (VALUES {rows_of(first_owner(COUNTRIES))}) k(market, code) ON k.market = b.market_code
        LEFT JOIN (SELECT conversation_id, TRY_CAST(advisor_bp_number AS BIGINT) AS bp, nps FROM in_surveys) v ON v.conversation_id = b.conversation_id
          AND (b.canal <> 'voz' OR b.is_human = 'NOT_HUMAN' OR v.bp = b.agent_bp)
        LEFT JOIN res_one r ON r.conversation_id = b.conversation_id AND (r.agent_id IS NULL OR r.agent_id = b.agent_id)
        LEFT JOIN (SELECT DISTINCT conversationid, fcr_ai FROM in_chat_indicators) o ON o.conversationid = b.conversation_id
        LEFT JOIN in_ticket_resolution tr ON tr.conversation_id = b.conversation_id
        LEFT JOIN qual_one q ON q.conversation_id = b.conversation_id AND (q.agent_id IS NULL OR q.agent_id = b.agent_id)
        LEFT JOIN name_one n ON n.agent_bp_number = b.agent_bp
        LEFT JOIN boss_by_bp s1 ON s1.agent_bp_number = b.agent_bp AND s1.period_id = {ym('b.call_date')}
        LEFT JOIN boss_by_id s2 ON s2.agent_id = b.agent_id AND s2.period_id = {ym('b.call_date')}
        LEFT JOIN agents_agg g ON g.conversation_id = b.conversation_id
        LEFT JOIN (FROM in_retention_flags WHERE conversation_start_dt >= {MIN}) t ON t.conversation_id = b.conversation_id""",
    "share": f"""
        SELECT call_date, canal, market_code, coalesce(sum(factor) FILTER (category <> 'NOT_CATEGORIZED'), 0) AS fac_cat,
               coalesce(sum(factor), 0) AS factor_sum
        FROM rich WHERE is_human = 'HUMAN' AND (canal IN ('wsp', 'voz', 'chat') OR (canal = 'cases' AND call_date >= {CUT})) GROUP BY ALL""",
    "plus": f"""
        SELECT r.*, CASE WHEN coalesce(factor, 0) = 0 THEN 0.0
            WHEN is_human = 'HUMAN' AND (r.canal IN ('wsp', 'voz', 'chat') OR (r.canal = 'cases' AND r.call_date >= {CUT}))
                 AND category <> 'NOT_CATEGORIZED' AND s.fac_cat > 0 THEN factor / nullif(s.fac_cat / nullif(s.factor_sum, 0), 0)
            WHEN category = 'NOT_CATEGORIZED' THEN CASE WHEN r.canal = 'cases' AND r.call_date < {CUT} THEN factor ELSE 0 END
            WHEN is_human = 'NOT_HUMAN' THEN 1.0 ELSE factor END AS factor_plus
        FROM rich r LEFT JOIN share s ON s.call_date = r.call_date AND s.canal = r.canal AND s.market_code = r.market_code""",
    "mart": f"""
        SELECT DISTINCT * EXCLUDE (lost, kept_bot_category) REPLACE (CASE WHEN lost THEN NULL ELSE fcr END AS fcr,
               CASE WHEN lost AND fcr IS NOT NULL THEN NULL ELSE nota_calidad END AS nota_calidad)
        FROM (SELECT *, coalesce(is_human = 'HUMAN' AND canal = 'voz' AND category = 'NOT_CATEGORIZED' AND call_date > {CUT}, false) AS lost FROM plus)""",
}

_WORD = re.compile(r"\b[a-z_]+[a-z0-9_]*\b")


def compose(select: str) -> str:
    """WITH clause of all steps the text needs, in order, and the text itself."""
    order: list[str] = []

    def visit(text: str, own: str | None) -> None:
        for word in dict.fromkeys(_WORD.findall(re.sub(r"'[^']*'", "''", text))):
            if word in STEPS and word != own and word not in order:
                visit(STEPS[word], word)
                order.append(word)

    visit(select, None)
    if not order:
        return select.strip()
    steps = ",\n".join(f"{name} AS MATERIALIZED ({STEPS[name].strip()})" for name in order)
    return f"WITH {steps}\n{select.strip()}"
