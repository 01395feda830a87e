"""Columns and types of every input and layer, and conforming of frames to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = (
    "struct<skill_name:string,bp_executive_num:bigint,agent_id:string,aht:double,Canal_de_Atencion:string,"
    "Departamento_SAG:string,Division:string,Fabrica_dic:string,ID_Cola:string,Cola_con_Demanda:string,"
    "Jefatura:string,SubGerente:string,Gerencia:string,Script:string,ID_Script:string>"
)
AGENT = "struct<agent_id:string,first_category:string,second_category:string,third_category:string>"

_CATEGORIES = "conversation_id string, participant_id string, first_category string, second_category string, third_category string, load_datetime timestamp"
_PROCESS = "conversation_id string, participant_id string, agent_bp_number string, load_datetime timestamp"
_RESOLUTION = "conversation_id string, participant_id string, is_first_call_resolution string, reason_resolution_fcr string, load_datetime timestamp"
_HR = "bp_num bigint, employee_email string, load_dt date, entry_company_date date"

SOURCES = {
    "segments": "conversation_id string, conversation_date date, queue_name string, factory_name string, talk_time_second double, held_time_second double, after_call_work_time_second double, message_type string, agent_bp_number bigint, agent_id string, sag_name string, originating_direction_type string",
    "queue_dictionary": "Nombre_de_Cola string, Canal_de_Atencion string, Departamento_SAG string, Division string, Fabrica string, ID_Cola string, Cola_con_Demanda string, Jefatura string, SubGerente string, Gerencia string, Script string, ID_Script string",
    "bot_sessions": "conversation_id string, entity_id string, customer_id string, conversation_start_datetime timestamp, market_code string, channel_type string, is_voicebot int, is_has_queue int, intent_type string, category_voicebot_typification string, voicebot_category_process string, originating_direction_type string, bp_agent_transferred_bot string",
    "participant_sessions": "conversation_id string, participant_id string, user_id string, purpose string, load_datetime timestamp",
    "voice_categories": _CATEGORIES,
    "text_categories": _CATEGORIES,
    "tickets": "ticket_id string, agent_group_name string, factory_name string, language_name string, contact_form_name string, agent_name string, subject_desc string, tag_list string, claim_ai_typification string, claim_ai_subtypification string, agent_email string, created_dt timestamp, solved_dt timestamp",
    "staff_snapshots": "agent_id string, agent_email string, agent_bp_number bigint, supervisor_bp_number bigint, period_id int, load_datetime timestamp",
    "hr_history": _HR,
    "hr_daily": _HR,
    "queue_country": "sagg string, country string",
    "demand_wide": "mes string, demanda_voz_agente double, wa double, livechat double, casos_validado_com_gabi double, redes_sociales double",
    "demand_daily": "date date, channel string, country string, N_R double",
    "chat_indicators": "conversationid string, tip string, fcr_ai string",
    "ticket_categories": "conversation_id string, first_category string, second_category string, third_category string, load_datetime timestamp",
    "surveys": "conversation_id string, advisor_bp_number string, last_sag_contact_description string, nps string",
    "retention_flags": "conversation_id string, is_hvc int, is_recontact int, conversation_start_dt timestamp",
    "audio_process": _PROCESS,
    "text_process": _PROCESS,
    "whatsapp_process": _PROCESS,
    "agent_names": "agent_bp_number bigint, agent_name string, load_date date, agent_id string, supervisor_bp_number bigint",
    "voice_resolution": _RESOLUTION,
    "whatsapp_resolution": _RESOLUTION,
    "ticket_resolution": _RESOLUTION,
    "compliance": "conversation_id string, participant_id string, m1_welcome_weight double, m2_inquiry_weight double, m3_empathy_weight double, m4_expectation_adjustment_weight double, m5_management_weight double, m6_information_provision_weight double, m7_service_confirmation_weight double, m8_farewell_weight double",
    "recontact": "customer_id string, entity_id string, customer_phone string, record_id string, is_recontact_24_hrs int, creation_datetime timestamp, channel string, contact_channel_name string, factory_name string, service_agent_group_name string, employee_bp_number string, next_contact_channel_name string, next_record_id string, next_creation_datetime timestamp, is_recontact_origin int",
    "queue_performance": "effective_start_date_utc date, handletime_seconds double, handle_qty bigint",
    "dialogues": "id string, dialog string",
    "summaries": "conversation_id string, agent_action_description string, call_reason string, resolution_status string, load_datetime timestamp, first_comment_category string, second_category_comment string, third_category_comment string",
    "bot_transcriptions": "conversation_id string",
}

CALCULATED = (
    f"conversation_id string, call_date date, skill_name array<string>, factory_name array<string>, market_code string, channel_type string, cat_bot string, is_human string, skill_lookup array<{SEGMENT}>, cat_pca string, second_category string, third_category string, all_agents array<{AGENT}>, agent_email string, sag_name string, mercado string"
)
INTERMEDIA = (
    f"conversation_id string, call_date date, skill_name array<string>, factory_name array<string>, market_code string, channel_type string, cat_bot string, is_human string, skill_lookup array<{SEGMENT}>, cat_pca string, second_category string, third_category string, all_agents array<{AGENT}>, sag_name string, mercado string"
)
THIRD = (
    f"conversation_id string, agent_id string, agent_bp bigint, agent_aht double, call_date date, skill_name array<string>, factory_name array<string>, market_code string, channel_type string, is_human string, skill_lookup array<{SEGMENT}>, all_agents array<{AGENT}>, sag_name string, canal string, zona string, factor double, second_category string, third_category string, category string, country_code string, aht double, nps string, factor_pca double, reason_resolution_fcr string, last_agent_bp_number bigint, last_agent_name string, last_supervisor_bp_number bigint, all_agent_bp_numbers string, all_supervisor_bp_numbers string, is_hvc int, is_recontact int, factor_plus double, fcr int, nota_calidad double"
)

_TIMES = (T.TimestampType, T.TimestampNTZType)


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the columns of the schema, in its order. Absent ones become typed NULLs;
    columns that already have the type pass uncast, so that filters still reach the scan."""
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in struct_of(ddl).fields:
        kind = have.get(field.name)
        if kind is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif kind.simpleString() == field.dataType.simpleString() or (
            isinstance(kind, _TIMES) and isinstance(field.dataType, _TIMES)
        ):
            columns.append(F.col(field.name))
        else:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*columns)
