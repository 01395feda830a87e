"""Third layer: scaled, categorised rows with quality and satisfaction indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.functions import arrays, dates, rules
from contact_mart.operators import filters, joins, lookups, scaling
from contact_mart.operators.dedup import down, latest_agent_name, latest_staff, top1, up
from contact_mart.operators.keysets import KeySet, pruned_sources
from contact_mart.operators.reshape import union_all, union_distinct
from contact_mart.params import Params
from contact_mart.session import Workspace
from contact_mart.sources.catalog import Sources
from contact_mart.sources.schemas import THIRD, conform

CONVERSATION = {"conversation_id": "conversation_id"}
# Stands for a missing conversation id while rows are joined by it; no source has this text.
NO_CONVERSATION = "\0none"
# The same for a missing agent id, in a column beside it.
HELD_AGENT, NO_AGENT = "_held_agent", "\0none"
# Lists of what a row meets by conversation and agent, and their values.
MET = {"_resolution": ["is_first_call_resolution", "reason_resolution_fcr"], "_quality": ["nota_calidad"]}
# Sources without a load time of their own, with their conversation column.
WINDOWLESS = {"compliance": "conversation_id", "surveys": "conversation_id", "chat_indicators": "conversationid"}


def since(df: DataFrame, column: str, p: Params, always: bool = False) -> DataFrame:
    """Lower bound on a load time: in a full run only where ``always`` is set."""
    return filters.cut(df, column, p.loads_from) if p.start is not None or always else df


def main_table(intermedia: DataFrame, p: Params | None = None) -> DataFrame:
    """Rows of the second layer with the agent of the longest segment, canal and zone."""
    rows = intermedia
    if p is not None and p.start is not None:
        rows = rows.where(F.col("call_date") >= F.lit(p.start))
    return rows.select(
        "conversation_id",
        arrays.longest_segment(F.col("skill_lookup")).alias("_top"),
        "call_date",
        "skill_name",
        "factory_name",
        "market_code",
        "channel_type",
        "cat_bot",
        "is_human",
        "skill_lookup",
        "all_agents",
        "cat_pca",
        "second_category",
        "third_category",
        "sag_name",
        rules.canal_of(F.col("channel_type"), F.col("is_human")).alias("canal"),
        F.col("mercado").alias("zona"),
    ).withColumns(
        {
            "agent_id": F.col("_top.agent_id"),
            "agent_bp": F.col("_top.bp_executive_num"),
            "agent_aht": F.col("_top.aht"),
        }
    ).drop("_top")


def chat_tips(src: Sources) -> DataFrame:
    return src["chat_indicators"].select(
        F.col("conversationid").alias("conversation_id"), rules.stripped(F.col("tip")).alias("tip")
    ).distinct()


def ticket_levels(src: Sources, p: Params) -> DataFrame:
    return since(src["ticket_categories"], "load_datetime", p).select(
        "conversation_id", *[F.col(c).alias(f"ticket_{c}") for c in ("first_category", "second_category", "third_category")]
    )


def cascade(rows: DataFrame, tips: DataFrame, tickets: DataFrame) -> DataFrame:
    """First known category: text category (tickets only), analytics, bot, chat tip.

    Tickets take levels two and three from their text category alone. Social rows have
    no conversation and meet neither table.
    """
    single = ~F.coalesce(F.col("canal") == "rrss", F.lit(False))
    for side in (tips, tickets):
        same = F.col("conversation_id") == F.col("_k")
        rows = rows.join(side.withColumnRenamed("conversation_id", "_k"), same & single, "left").drop("_k")
    ticket = F.coalesce(F.col("canal") == "cases", F.lit(False))
    # The text category of a conversation that is not a ticket plays no part.
    text = F.when(ticket, F.col("ticket_first_category"))
    analysed_nothing = text.isNull() & F.col("cat_pca").isNull()
    weak_source = F.col("cat_bot").isNotNull() | F.col("tip").isNotNull()
    checked = F.coalesce(F.col("canal").isin("cases", "voz"), F.lit(False))
    levels = {
        f"{level}_category": F.when(ticket, F.col(f"ticket_{level}_category")).otherwise(F.col(f"{level}_category"))
        for level in ("second", "third")
    }
    return (
        rows.withColumn("category", F.coalesce(text, "cat_pca", "cat_bot", "tip"))
        .withColumn("kept_bot_category", checked & analysed_nothing & weak_source)
        .withColumns(levels)
        .drop("cat_bot", "cat_pca", "tip", *[f"ticket_{level}_category" for level in ("first", "second", "third")])
    )


def social_rows(demand: DataFrame, p: Params) -> DataFrame:
    """Demand of the social channel as rows without conversation; their weight is the demand."""
    rows = demand.where(F.col("canal") == "rrss").withColumn(
        "call_date", F.to_date(F.concat("mes", F.lit("-01")))
    )
    if p.start is not None:
        rows = rows.where(F.col("call_date") >= F.lit(p.start))
    grouped = rows.groupBy("mes", "call_date", "canal", "zona", "valor").agg(
        F.count(F.lit(1)).cast("int").alias("copies")
    )
    return grouped.select(
        F.lit("rrss").alias("conversation_id"),
        "call_date",
        F.array_repeat(F.lit("NO_FACTORY"), F.col("copies")).alias("factory_name"),
        F.col("canal").alias("channel_type"),
        F.lit("HUMAN").alias("is_human"),
        "canal",
        "zona",
        F.col("valor").alias("factor"),
    )


def process_rows(src: Sources, p: Params) -> DataFrame:
    """(conversation, participant, agent number) of the three process logs, duplicates included."""
    logs = [
        since(src[name], "load_datetime", p)
        .where(F.col("participant_id").isNotNull())
        .select("conversation_id", "participant_id", F.col("agent_bp_number").try_cast("bigint").alias("agent_bp_number"))
        for name in ("audio_process", "text_process", "whatsapp_process")
    ]
    return union_all(*logs)


def process_log(src: Sources, p: Params) -> DataFrame:
    return union_distinct(process_rows(src, p))


def agent_bridge(logs: DataFrame, staff: DataFrame) -> DataFrame:
    """Agent ids behind a participant, by way of the agent number.

    Grouping by (conversation, participant) removes the duplicates of the logs as well. It is done where the
    conversation lies, so the logs move once, and what is joined to the bridge moves once, to its conversation,
    where the choices per agent need it. The set per participant is as long as the list of ids that share its numbers.
    """
    people = (
        latest_staff(staff, "agent_id")
        .select("agent_id", "agent_bp_number")
        .where(F.col("agent_bp_number").isNotNull())
    )
    agents = F.collect_set(F.struct("agent_id")).alias("agents")
    known = logs.join(people, "agent_bp_number").select("conversation_id", "participant_id", "agent_id")
    sets = known.repartition("conversation_id").groupBy("conversation_id", "participant_id").agg(agents)
    return sets.select("conversation_id", "participant_id", F.inline("agents"))


def on_bridge(df: DataFrame, bridge: DataFrame) -> DataFrame:
    keys = {"conversation_id": "conversation_id", "participant_id": "participant_id"}
    return joins.left_lookup(df, bridge, keys)


def resolution_rows(src: Sources, p: Params) -> DataFrame:
    both = union_all(src["voice_resolution"], src["whatsapp_resolution"])
    return since(both, "load_datetime", p, always=True).where(F.col("is_first_call_resolution").isNotNull())


def resolution_per_agent(rows: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row per conversation and agent, left with its conversation, where ``wildcard_join`` looks for both of its sides."""
    keys = ["conversation_id", F.coalesce("agent_id", F.lit("NULL_AGENT"))]
    order = down("load_datetime") + up(
        "participant_id", "agent_id", "is_first_call_resolution", "reason_resolution_fcr"
    )
    return top1(on_bridge(rows, bridge).repartition("conversation_id"), keys, order).select(
        "conversation_id", "agent_id", "is_first_call_resolution", "reason_resolution_fcr"
    )


def compliance_per_agent(compliance: DataFrame, bridge: DataFrame) -> DataFrame:
    """As ``resolution_per_agent``."""
    weights = list(rules.COMPLIANCE_WEIGHTS)
    known = on_bridge(compliance, bridge).repartition("conversation_id")
    one = top1(known, ["conversation_id", "agent_id"], up("participant_id", *weights))
    return one.select(
        "conversation_id", "agent_id", rules.quality_score([F.col(w) for w in weights]).alias("nota_calidad")
    )


def session_agents(sessions: DataFrame, staff: DataFrame, names: DataFrame) -> DataFrame:
    """Agent sessions with number, name and supervisor of the nearest staff month."""
    agents = sessions.where(F.col("purpose") == "agent").select(
        "conversation_id",
        F.col("participant_id").alias("agent_id"),
        "load_datetime",
        dates.period_of(F.col("load_datetime")).alias("month"),
    )
    nearest = joins.nearest_snapshot(
        agents, staff, "agent_id", "period_id", "load_datetime", ["agent_bp_number", "supervisor_bp_number"]
    )
    found = joins.join_nearest(agents, nearest, "agent_id")
    order = [
        F.col("gap").asc_nulls_first(),
        F.coalesce("before", F.lit(1)).asc(),
        F.col("loaded").desc_nulls_last(),
        *up("agent_bp_number", "supervisor_bp_number"),
        F.col("load_datetime").desc_nulls_last(),
    ]
    one = top1(found, ["conversation_id", "agent_id"], order)
    return joins.left_lookup(one, latest_agent_name(names), {"agent_bp_number": "agent_bp_number"}).select(
        "conversation_id", "agent_id", "agent_bp_number", "agent_name", "supervisor_bp_number", "load_datetime"
    )


def agents_summary(sessions: DataFrame) -> DataFrame:
    """Lists of agents and supervisors, and the last agent, per conversation."""
    moment = F.col("load_datetime")
    return sessions.groupBy("conversation_id").agg(
        arrays.csv_distinct(F.col("agent_bp_number")).alias("all_agent_bp_numbers"),
        arrays.csv_distinct(F.col("supervisor_bp_number")).alias("all_supervisor_bp_numbers"),
        *[
            arrays.latest(F.col(c), moment, ignore_nulls=False).alias(f"last_{c}")
            for c in ("agent_bp_number", "agent_name", "supervisor_bp_number")
        ],
    )


def join_surveys(rows: DataFrame, surveys: DataFrame) -> DataFrame:
    """Surveys of the conversation; on human voice only those of the row's own agent."""
    side = surveys.select(
        F.col("conversation_id").alias("_k"),
        F.col("advisor_bp_number").try_cast("bigint").alias("_bp"),
        "nps",
    )
    fits = (F.col("canal") != "voz") | (F.col("is_human") == "NOT_HUMAN") | (F.col("agent_bp") == F.col("_bp"))
    return rows.join(side, (F.col("conversation_id") == F.col("_k")) & fits, "left").drop("_k", "_bp")


def supervisors(rows: DataFrame, staff: DataFrame) -> DataFrame:
    """Supervisor in the month of the row: by agent number first, then by agent id."""
    by_number = latest_staff(staff.where(F.col("agent_bp_number").isNotNull()), "agent_bp_number", "period_id")
    by_id = latest_staff(staff.where(F.col("agent_id").isNotNull()), "agent_id", "period_id")
    rows = joins.period_lookup(
        rows, by_number, "agent_bp", "agent_bp_number", "call_date", "supervisor_bp_number", "_by_number"
    )
    rows = joins.period_lookup(rows, by_id, "agent_id", "agent_id", "call_date", "supervisor_bp_number", "_by_id")
    return rows.withColumn("last_supervisor_bp_number", F.coalesce("_by_number", "_by_id")).drop(
        "_by_number", "_by_id"
    )


def latest_supervisors(rows: DataFrame, staff: DataFrame) -> DataFrame:
    """Earlier rule: supervisor of the latest snapshot, by agent id first."""
    by_id = latest_staff(staff, "agent_id").select("agent_id", F.col("supervisor_bp_number").alias("_by_id"))
    by_number = latest_staff(staff.where(F.col("agent_bp_number").isNotNull()), "agent_bp_number").select(
        "agent_bp_number", F.col("supervisor_bp_number").alias("_by_number")
    )
    rows = joins.left_lookup(rows, by_id, {"agent_id": "agent_id"})
    rows = joins.left_lookup(rows, by_number, {"agent_bp": "agent_bp_number"})
    return rows.withColumn("last_supervisor_bp_number", F.coalesce("_by_id", "_by_number")).drop(
        "_by_id", "_by_number"
    )


def ticket_resolutions(src: Sources, p: Params) -> DataFrame:
    return since(src["ticket_resolution"], "load_datetime", p).select(
        "conversation_id",
        F.col("is_first_call_resolution").alias("_ticket_fcr"),
        F.col("reason_resolution_fcr").alias("_ticket_reason"),
    )


def chat_outcomes(src: Sources) -> DataFrame:
    return src["chat_indicators"].select(F.col("conversationid").alias("conversation_id"), "fcr_ai").distinct()


def retention(src: Sources, p: Params) -> DataFrame:
    flags = since(src["retention_flags"], "conversation_start_dt", p, always=True)
    return flags.select("conversation_id", "is_hvc", "is_recontact")


def staff_lookups(rows: DataFrame, src: Sources) -> DataFrame:
    """Agent name and supervisor."""
    names = latest_agent_name(src["agent_names"]).withColumnRenamed("agent_name", "last_agent_name")
    named = joins.left_lookup(rows, names, {"agent_bp": "agent_bp_number"})
    return supervisors(named, src["staff_snapshots"])


def held_agent(agent_id: Column) -> Column:
    return F.coalesce(agent_id, F.lit(NO_AGENT))


def agent_lookups(rows: DataFrame, src: Sources, p: Params) -> DataFrame:
    """Resolution and quality of the row's own agent and of no agent, as lists; reads and drops ``HELD_AGENT``.

    They come before the joins on the conversation alone, which find the rows in the order of these."""
    bridge = agent_bridge(process_rows(src, p), src["staff_snapshots"])
    sides = {
        "_resolution": resolution_per_agent(resolution_rows(src, p), bridge),
        "_quality": compliance_per_agent(src["compliance"], bridge),
    }
    met = {name: (side, MET[name]) for name, side in sides.items()}
    return joins.wildcard_lists(rows, met, "conversation_id", "agent_id", HELD_AGENT).drop(HELD_AGENT)


def conversation_lookups(rows: DataFrame, src: Sources, p: Params) -> DataFrame:
    """Surveys, resolution, quality, agent lists and recontact: all joined on the conversation. ``rows`` come
    from ``agent_lookups``; its lists unfold after the last join, as that breaks the order of the rows."""
    staff = src["staff_snapshots"]
    sessions = session_agents(since(src["participant_sessions"], "load_datetime", p), staff, src["agent_names"])
    summary = agents_summary(sessions).select(
        "conversation_id", "all_agent_bp_numbers", "all_supervisor_bp_numbers"
    )

    rows = join_surveys(rows, src["surveys"])
    rows = joins.left_lookup(rows, chat_outcomes(src), CONVERSATION)
    rows = joins.left_lookup(rows, ticket_resolutions(src, p), CONVERSATION)
    rows = joins.left_lookup(rows, summary, CONVERSATION)
    rows = joins.left_lookup(rows, retention(src, p), CONVERSATION)
    rows = joins.unfolded(rows, MET)

    canal = F.col("canal")
    outcome = rules.fcr_flag(canal, F.col("_ticket_fcr"), F.col("is_first_call_resolution"), F.col("fcr_ai"))
    reason = F.when(canal == "cases", F.col("_ticket_reason")).otherwise(F.col("reason_resolution_fcr"))
    return rows.withColumns(
        {
            "aht": rules.effective_time(canal, F.col("agent_aht"), F.col("factor")),
            "factor_pca": F.col("factor"),
            "fcr": outcome,
            "reason_resolution_fcr": reason,
            "last_agent_bp_number": F.col("agent_bp"),
        }
    ).drop("_ticket_fcr", "_ticket_reason", "is_first_call_resolution", "fcr_ai")


def staff_of_rows(rows: DataFrame, src: Sources) -> DataFrame:
    """Agent name and supervisor of the rows with an agent, per conversation, agent and day.

    The lookups go by agent and month. Only what they need moves there and back to the conversation, not the rows
    with their lists."""
    keys = ("conversation_id", "agent_bp", "agent_id", "call_date")
    known = rows.select(*keys).where(F.col("agent_bp").isNotNull() | F.col("agent_id").isNotNull())
    found = staff_lookups(known, src).where(
        F.col("last_agent_name").isNotNull() | F.col("last_supervisor_bp_number").isNotNull()
    )
    return found.repartition("conversation_id").distinct()


def join_staff(rows: DataFrame, staffed: DataFrame) -> DataFrame:
    """Attach ``staff_of_rows``, and ``HELD_AGENT``. Conversations are known; of agent and day any may be missing.

    The agent stands second, so that ``agent_lookups`` finds the rows in its order."""
    side = staffed.withColumnsRenamed({c: f"_{c}" for c in ("conversation_id", "agent_bp", "agent_id", "call_date")})
    side = side.withColumn("_agent_id", held_agent(F.col("_agent_id")))
    same = (F.col("conversation_id") == F.col("_conversation_id")) & (F.col(HELD_AGENT) == F.col("_agent_id"))
    for c in ("agent_bp", "call_date"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    rows = rows.withColumn(HELD_AGENT, held_agent(F.col("agent_id")))
    return rows.join(side, same, "left").drop("_conversation_id", "_agent_bp", "_agent_id", "_call_date")


def enrich(base: DataFrame, src: Sources, p: Params) -> DataFrame:
    """Country, satisfaction, resolution, quality, names, supervisors and recontact."""
    staffed = staff_lookups(base, src).withColumn(HELD_AGENT, held_agent(F.col("agent_id")))
    return conversation_lookups(lookups.with_country(agent_lookups(staffed, src, p)), src, p)


def null_out_kpis(rows: DataFrame, p: Params) -> DataFrame:
    """Uncategorised human voice after the cutover: resolution becomes NULL, and quality with it
    where there was a resolution."""
    lost = rules.unreliable_voice(
        F.col("is_human"), F.col("canal"), F.col("category"), F.col("call_date"), p.cutover
    )
    quality = F.when(lost & F.col("fcr").isNotNull(), None).otherwise(F.col("nota_calidad"))
    return rows.withColumn("nota_calidad", quality).withColumn(
        "fcr", F.when(lost, None).otherwise(F.col("fcr"))
    )


def counted_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies. After the joins on the conversation this
    needs no further exchange, as equal rows already lie in one partition."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def scaled_rows(main: DataFrame, src: Sources, p: Params, ws: Workspace) -> DataFrame:
    """Weighted rows of the second layer and the social demand rows."""
    wanted = ws.stage(scaling.demand(src["demand_wide"], src["demand_daily"], p), "demand")
    counts = ws.stage(scaling.observed_counts(main), "counts")
    factors = ws.stage(scaling.scaling_factors(counts, wanted, p), "factors")
    return union_all(scaling.apply_factor(main, factors), social_rows(wanted, p), fill=True)


def categorised_rows(rows: DataFrame, src: Sources, p: Params) -> DataFrame:
    return lookups.homologate(cascade(rows, chat_tips(src), ticket_levels(src, p)))


def window_sources(intermedia: DataFrame, src: Sources, p: Params, ws: Workspace) -> Sources:
    """Incremental: sources that only their conversation ties to the window, pruned to its conversations.

    Each of them is joined to the window's rows on the conversation, so no row that matters goes."""
    if p.start is None:
        return src
    rows = intermedia.where(F.col("call_date") >= F.lit(p.start))
    keys = KeySet(rows.select("conversation_id"), ws, "window-conversations")
    return pruned_sources(src, keys, WINDOWLESS)


def final_rows(intermedia: DataFrame, src: Sources, p: Params, ws: Workspace) -> DataFrame:
    """All rows before re-weighting.

    Every join of the wide rows is on the conversation, so they move once, and the partitioning also serves the
    removal of duplicates; staff is looked up on narrow rows. The joins that also go by agent come first and the lists
    unfold last, so that the rows are sorted once. A missing conversation stands as a text meanwhile."""
    src = window_sources(intermedia, src, p, ws)
    main = main_table(intermedia, p)
    held = F.coalesce("conversation_id", F.lit(NO_CONVERSATION))
    staffed = staff_of_rows(main.withColumn("conversation_id", held), src)
    rows = scaled_rows(main, src, p, ws).withColumn("conversation_id", held)
    rows = agent_lookups(join_staff(rows, staffed), src, p)
    rows = lookups.with_country(categorised_rows(rows, src, p))
    return conversation_lookups(rows, src, p)


def given_back(rows: DataFrame) -> DataFrame:
    """Rows whose conversation was missing lack it again."""
    return rows.withColumn("conversation_id", F.nullif("conversation_id", F.lit(NO_CONVERSATION)))


def layer_schema(p: Params) -> str:
    return THIRD + (", kept_bot_category boolean" if p.kept_bot else "")


def build_third(intermedia: DataFrame, src: Sources, p: Params, ws: Workspace) -> DataFrame:
    """Final layer. The distinct rows are written once with their copies, since both the
    category share and the result read them; a copied row weighs once per copy."""
    schema = layer_schema(p)
    unweighted = conform(null_out_kpis(final_rows(intermedia, src, p, ws), p), schema).drop("factor_plus")
    base = ws.stage(given_back(counted_rows(unweighted)), "final-base")
    copies = F.lit(1) if p.dedupe_before_share else F.col("copies")
    share = ws.stage(scaling.category_share(base, p, copies), "category-share")
    return conform(scaling.factor_plus(base, share, p), schema)
