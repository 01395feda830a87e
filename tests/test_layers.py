"""Whole layers: tables, incremental runs, invariants, hot keys and plans."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from contact_mart import Workspace
from contact_mart.functions import dates
from contact_mart.operators import filters, joins, scaling
from contact_mart.plans import results, segments
from contact_mart.plans.conversations import build_intermedia, collapse_conversations, whole_conversation_start
from contact_mart.plans.run import LayerPaths, full_run, incremental_run
from contact_mart.sources import driver
from contact_mart.sources.catalog import Sources
from contact_mart.sources.schemas import CALCULATED, THIRD, conform, struct_of
from contact_mart.sources.tables import read_layer, replace_where, write_layer

SF = "/root/testdata/sf0.001"
LAYER = "conversation_id string, call_date date, v int"


@pytest.fixture(scope="module")
def mart(spark):
    """Second layer, unweighted rows and final layer of the driver's smallest tables."""
    src, p, ws = driver.driver_sources(spark, SF), driver.PARAMS, Workspace(spark)
    calculated = ws.stage(segments.build_calculated(src, p), "calculated")
    intermedia = ws.stage(build_intermedia(calculated), "intermedia")
    third = ws.stage(results.build_third(intermedia, src, p, ws), "third")
    yield {"src": src, "p": p, "ws": ws, "calculated": calculated, "intermedia": intermedia, "third": third}
    ws.close()


def test_replace_where_drops_vacated_days_and_keeps_the_past(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame(
        [("a", date(2025, 12, 31), 1), ("b", date(2026, 1, 1), 1), ("c", date(2026, 1, 2), 1)], LAYER
    )
    write_layer(old, path)
    past = next((tmp_path / "t").glob("version=*/call_date=2025-12-31"))
    before = {f.name: f.stat().st_mtime_ns for f in past.iterdir()}
    replace_where(spark.createDataFrame([("d", date(2026, 1, 2), 2), ("e", date(2026, 1, 3), 2)], LAYER), path, date(2026, 1, 1))
    assert rows(read_layer(spark, path), "conversation_id", "call_date", "v") == [
        ("a", date(2025, 12, 31), 1), ("d", date(2026, 1, 2), 2), ("e", date(2026, 1, 3), 2),
    ]
    assert {f.name: f.stat().st_mtime_ns for f in past.iterdir()} == before


def test_replace_where_reads_its_own_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_layer(spark.createDataFrame([("a", date(2026, 1, 1), 1), ("b", date(2026, 1, 2), 1)], LAYER), path)
    doubled = read_layer(spark, path).withColumn("v", F.col("v") * 2).where("call_date >= '2026-01-02'")
    replace_where(doubled, path, date(2026, 1, 2))
    assert rows(read_layer(spark, path), "conversation_id", "v") == [("a", 1), ("b", 2)]


def test_replace_where_refuses_rows_before_the_window(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_layer(spark.createDataFrame([("a", date(2026, 1, 1), 1)], LAYER), path)
    stray = spark.createDataFrame([("z", date(2025, 1, 1), 1), ("y", date(2026, 1, 1), 1)], LAYER)
    with pytest.raises(Exception, match="a row lies before the window"):
        replace_where(stray, path, date(2026, 1, 1))
    assert rows(read_layer(spark, path), "conversation_id") == [("a",)]


def test_replace_where_with_an_empty_window(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_layer(spark.createDataFrame([("a", date(2025, 1, 1), 1), ("b", date(2026, 1, 2), 1)], LAYER), path)
    replace_where(spark.createDataFrame([], LAYER), path, date(2026, 1, 1))
    assert rows(read_layer(spark, path), "conversation_id") == [("a",)]


def test_a_large_day_becomes_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    big = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("conversation_id"), F.lit(date(2026, 1, 1)).alias("call_date"), F.lit(1).alias("v")
    )
    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        write_layer(big, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)
    assert len(list((tmp_path / "t").glob("version=*/call_date=2026-01-01/*.parquet"))) > 2


def _steady_sources(spark):
    """Driver inputs in which every conversation and ticket lies within one day."""
    whole = driver.driver_sources(spark, SF)

    def load(name):
        df = whole[name]
        if name == "bot_sessions":
            return df.where(F.col("intent_type") == "intent")
        return df.where(F.col("subject_desc") != "subject") if name == "tickets" else df

    return Sources(load)


def test_incremental_equals_full(spark, rows, tmp_path):
    src, paths = _steady_sources(spark), LayerPaths.under(str(tmp_path / "mart"))
    p = replace(driver.PARAMS, min_date=date(2001, 2, 1), cutover=date(2001, 3, 1), lookback_days=9999)
    full_run(spark, src, p, paths)

    def content():
        return {
            name: sorted(map(repr, read_layer(spark, path).drop("skill_lookup", "all_agents").collect()))
            for name, path in vars(paths).items()
        }

    before = content()
    assert all(before.values())
    assert incremental_run(spark, src, p, paths) == date(2001, 5, 1)
    after = content()
    for name in before:
        assert after[name] == before[name], name


def _chat(spark, data):
    schema = "conversation_id string, call_date date, channel_type string, is_human string, agent string, aht double, cat string"
    df = spark.createDataFrame(data, schema)
    lookup = F.array(F.struct(F.lit("q").alias("skill_name"), F.lit(1).cast("bigint").alias("bp_executive_num"),
                              F.col("agent").alias("agent_id"), "aht"))
    full = struct_of(CALCULATED)["skill_lookup"].dataType.elementType
    names = [f.name for f in full.fields]
    packed = F.transform(
        lookup, lambda e: F.struct(*[e[n].alias(n) if n in ("skill_name", "bp_executive_num", "agent_id", "aht")
                                     else F.lit(None).cast("string").alias(n) for n in names])
    )
    return conform(df.withColumn("skill_lookup", packed).withColumn("cat_pca", F.col("cat"))
                   .withColumn("skill_name", F.array(F.lit("q"))).drop("agent", "aht", "cat"), CALCULATED)


def test_whole_conversation_start_moves_back_until_nothing_crosses(spark):
    chats = _chat(spark, [
        ("a", date(2026, 3, 30), "whatsapp", "HUMAN", "x", 1.0, None), ("a", date(2026, 4, 2), "whatsapp", "HUMAN", "x", 1.0, None),
        ("b", date(2026, 2, 20), "whatsapp", "HUMAN", "x", 1.0, None), ("b", date(2026, 3, 2), "whatsapp", "HUMAN", "x", 1.0, None),
        ("c", date(2026, 1, 5), "voice", "HUMAN", "x", 1.0, None), ("c", date(2026, 2, 5), "voice", "HUMAN", "x", 1.0, None),
    ])
    assert whole_conversation_start(chats, date(2026, 4, 1)) == date(2026, 2, 1)
    assert whole_conversation_start(chats, date(2026, 5, 1)) == date(2026, 5, 1)


def test_whole_conversation_start_follows_a_chain_over_six_months(spark):
    """Each conversation reaches into the next month; the chain ends where none does. One Spark job reads the layer."""
    days = [(date(2025, m, 25), date(2025, m + 1, 3)) for m in range(4, 10)]
    chain = [(f"c{k}", d, "whatsapp", "HUMAN", "x", 1.0, None) for k, two in enumerate(days) for d in two]
    long = [("l", d, "whatsapp", "HUMAN", "x", 1.0, None) for d in (date(2024, 2, 1), date(2024, 9, 1))]
    chats = _chat(spark, chain + long)
    expected = {date(2025, 10, 1): date(2025, 4, 1), date(2025, 7, 1): date(2025, 4, 1), date(2025, 11, 1): date(2025, 11, 1),
                date(2025, 4, 1): date(2025, 4, 1), date(2024, 5, 1): date(2024, 2, 1), date(2024, 9, 1): date(2024, 2, 1), date(2024, 10, 1): date(2024, 10, 1),
                date(2023, 1, 1): date(2023, 1, 1)}
    for start, wanted in expected.items():
        assert whole_conversation_start(chats, start) == wanted
    with pytest.raises(ValueError):
        whole_conversation_start(chats, date(2025, 4, 2))
    assert whole_conversation_start(chats.where("false"), date(2025, 4, 1)) == date(2025, 4, 1)


def test_winner_without_categories_falls_back(spark, rows):
    chats = _chat(spark, [
        ("a", date(2026, 1, 1), "whatsapp", "HUMAN", "x", 9.0, "first"), ("a", date(2026, 1, 2), "whatsapp", "HUMAN", "y", 1.0, "second"),
    ])
    assert rows(collapse_conversations(chats), "conversation_id", "call_date", "cat_pca") == [("a", date(2026, 1, 1), "first")]


def test_hot_conversation_collapses_whole(spark, rows):
    """A third of all rows in one conversation: one row, every distinct segment kept."""
    data = [("hot", date(2026, 1, 1), "whatsapp", "HUMAN", f"a{n % 7}", float(n), "VENTAS") for n in range(2000)]
    data += [(f"c{n}", date(2026, 1, 1), "whatsapp", "HUMAN", "a", 1.0, None) for n in range(4000)]
    out = collapse_conversations(_chat(spark, data))
    assert out.count() == 4001
    assert rows(out.where("conversation_id = 'hot'"), F.size("skill_lookup"), "cat_pca") == [(2000, "VENTAS")]


def test_one_chat_row_per_conversation(mart):
    chats = mart["intermedia"].where(filters.is_chat_segment())
    assert chats.count() == chats.select("conversation_id").distinct().count() > 0
    others = mart["calculated"].where(~F.coalesce(filters.is_chat_segment(), F.lit(False))).count()
    assert mart["intermedia"].count() == others + chats.count()


def test_third_layer_rows_are_distinct_and_typed(mart):
    third = mart["third"]
    assert third.count() == third.distinct().count() > 0
    assert [f.name for f in third.schema] == [f.name for f in struct_of(THIRD)]
    assert [f.dataType.simpleString() for f in third.schema] == [f.dataType.simpleString() for f in struct_of(THIRD)]


def test_weights_are_only_moved(mart):
    """Per day, canal and market the categorised rows carry the weight of all human rows."""
    rows_ = results.final_rows(mart["intermedia"], mart["src"], mart["p"], mart["ws"])
    share = scaling.category_share(rows_, mart["p"])
    spread = scaling.factor_plus(rows_, share, mart["p"]).where(
        (F.col("is_human") == "HUMAN") & (F.col("category") != "NOT_CATEGORIZED") & F.col("canal").isin("wsp", "voz", "chat")
    )
    moved = spread.groupBy("call_date", "canal", "market_code").agg(F.sum("factor_plus").alias("moved"))
    both = moved.join(share.where("fac_cat > 0"), ["call_date", "canal", "market_code"])
    assert both.count() > 0
    assert both.where(F.abs(F.col("moved") - F.col("factor_sum")) > 1e-6).count() == 0


def test_scaled_counts_meet_the_demand(mart):
    """From the cutover on, weights of a month, canal, zone and origin add up to its demand."""
    p, src = mart["p"], mart["src"]
    main = results.main_table(mart["intermedia"])
    wanted = scaling.demand(src["demand_wide"], src["demand_daily"], p)
    weighted = scaling.apply_factor(main, scaling.scaling_factors(scaling.observed_counts(main), wanted, p))
    sums = weighted.where(F.col("call_date") >= F.lit(p.cutover)).groupBy(
        dates.month_text(F.col("call_date")).alias("mes"), "canal", "zona", "is_human"
    ).agg(F.sum("factor").alias("total"))
    both = sums.join(wanted, ["mes", "canal", "zona", "is_human"])
    assert both.count() > 0
    assert both.where(F.abs(F.col("total") - F.col("valor")) > 1e-6).count() == 0


def test_kept_bot_variant_adds_its_flag(mart):
    p = replace(mart["p"], kept_bot=True)
    out = results.build_third(mart["intermedia"], mart["src"], p, mart["ws"])
    assert out.columns[-1] == "kept_bot_category"
    flagged = out.where("kept_bot_category and is_human = 'HUMAN'")
    assert flagged.count() > 0
    assert flagged.where("factor_plus <> 0").count() == 0


def test_ticket_overrides_come_first(spark, mart):
    kept = filters.filter_tickets(mart["src"]["tickets"], mart["p"])
    address = kept.select("agent_email").first()[0]
    overrides = spark.createDataFrame([(address, 77)], "agent_email string, agent_bp_number bigint")
    out = segments.tickets_resolved(mart["src"], mart["p"], overrides)
    assert {r[0] for r in out.where(F.col("agent_email") == address).select("agent_bp_number").distinct().collect()} == {77}
    assert out.count() == kept.count()


# ---- plans ---------------------------------------------------------------------------


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def test_date_filters_reach_the_scan(spark, mart, tmp_path):
    path = str(tmp_path / "segments")
    mart["src"]["segments"].write.parquet(path)
    src = Sources.from_parquet(spark, {"segments": path})
    text = plan(filters.filter_segments(src["segments"], mart["p"]).select("conversation_id"))
    assert "GreaterThanOrEqual(conversation_date,1995-02-01)" in text
    assert "LessThan(conversation_date,2001-06-16)" in text
    assert "held_time_second" not in text.split("ReadSchema")[1].splitlines()[0]


def test_ranks_are_cut_before_the_shuffle(mart):
    text = plan(results.latest_staff(mart["src"]["staff_snapshots"], "agent_id"), "simple")
    assert text.count("WindowGroupLimit") == 2


def test_final_rows_have_no_cartesian_product_and_need_no_exchange_for_duplicates(spark, mart):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16KB")
    try:
        base = results.final_rows(mart["intermedia"], mart["src"], mart["p"], mart["ws"])
        plain, counted = plan(base, "simple"), plan(results.counted_rows(base), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "CartesianProduct" not in plain and "NestedLoop" not in plain
    assert counted.count("Exchange hashpartitioning") == plain.count("Exchange hashpartitioning")


def test_unknown_columns_are_reported():
    class Frame:
        columns = ["sagg"]

    with pytest.raises(ValueError, match="country"):
        Sources(lambda name: Frame())["queue_country"]


def test_a_cluster_without_shared_folder_is_refused(spark):
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        _ = Workspace(Session()).root


def moved_with(df, *columns, step="Exchange"):
    """Exchanges (or other steps) of the plan whose rows have the columns."""
    kept = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "16KB")
    try:
        text = plan(df)
    finally:
        df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    parts = re.findall(rf"\n\(\d+\) {step}\nInput \[\d+\]: \[(.*?)\]\n", text)
    return sum(all(re.search(rf"\b{c}#", p) for c in columns) for p in parts)


def test_chats_are_collapsed_where_their_joins_leave_them(mart):
    calculated = segments.build_calculated(mart["src"], mart["p"], None, mart["ws"])
    assert moved_with(calculated, "skill_lookup") == moved_with(calculated, "Gerencia") == 0
    assert moved_with(calculated, "all_agents") == 0
    assert moved_with(build_intermedia(calculated), "skill_lookup") == 0


def test_wide_rows_of_the_final_layer_move_once(mart):
    assert moved_with(results.final_rows(mart["intermedia"], mart["src"], mart["p"], mart["ws"]), "skill_lookup") == 1


def test_wide_rows_of_the_final_layer_are_sorted_once(mart):
    """For all of their joins, with the agent and without. Before, each choice of agent rows and its unfolding sorted them again."""
    rows_ = results.final_rows(mart["intermedia"], mart["src"], mart["p"], mart["ws"])
    assert moved_with(rows_, "skill_lookup", step="Sort") == 1


def test_the_tenure_report_reads_the_final_layer_without_writing_it_again(monkeypatch):
    """Only the columns that it needs are read then."""
    from types import SimpleNamespace

    from contact_mart.checks import q_layers

    staged = []
    monkeypatch.setattr(q_layers.reports, "tenure_rows", lambda third, *rest: third)
    monkeypatch.setattr(q_layers.reports, "tenure_report", lambda rows, version: rows)
    monkeypatch.setattr(q_layers, "tenure", lambda c, mart: None)
    ws = SimpleNamespace(stage=lambda df, name: staged.append(name) or df)
    c = SimpleNamespace(third="third", intermedia="intermedia", ws=ws, p=SimpleNamespace(as_of=None, cutover=None))
    assert q_layers.tenure_table(c, None) == "third" and staged == []


def test_staff_of_narrow_rows_is_that_of_the_rows(spark, rows):
    """Missing conversations, agents, numbers and days; repeated rows; months that the staff table lacks."""
    day = date(1999, 3, 5)
    main = spark.createDataFrame(
        [("c1", 1, "a1", day), ("c1", 1, "a1", day), ("c1", 2, None, day), (None, 1, "a1", day), (None, None, "a2", day),
         ("c2", None, None, day), ("c3", 1, "a1", None), ("c4", 9, "a9", day), ("c5", 2, "a1", date(1999, 4, 1))],
        "conversation_id string, agent_bp bigint, agent_id string, call_date date",
    )
    tables = {
        "agent_names": spark.createDataFrame([(1, "one", day), (2, "two", day)], "agent_bp_number bigint, agent_name string, load_date date"),
        "staff_snapshots": spark.createDataFrame(
            [("a1", 1, 91, 199903), ("a2", None, 92, 199903), (None, 2, 93, 199903), ("a1", 3, 94, 199904)],
            "agent_id string, agent_bp_number bigint, supervisor_bp_number bigint, period_id int",
        ).withColumn("load_datetime", F.lit(day).cast("timestamp_ntz")),
    }
    wanted = results.staff_lookups(main, tables)
    held = main.withColumn("conversation_id", F.coalesce("conversation_id", F.lit(results.NO_CONVERSATION)))
    got = results.given_back(results.join_staff(held, results.staff_of_rows(held, tables)))
    assert rows(got, *wanted.columns) == rows(wanted)


def test_queue_attributes_do_not_move_where_no_market_is_read(mart):
    """The planner leaves the market out then; the first exchange is that of the categories."""
    calculated = segments.build_calculated(mart["src"], mart["p"], None, mart["ws"])
    main = results.main_table(build_intermedia(calculated))
    assert moved_with(main.select("conversation_id", "agent_id", "cat_pca", "all_agents", "skill_lookup"), "Gerencia") == 0


def test_rows_of_a_wildcard_join_move_once(spark):
    """Before, they moved to (key, optional) and again to the key; the right side moved for its choice and for both joins."""
    left = spark.range(5000).selectExpr("id % 900 AS conversation_id", "'a' || id % 7 AS agent_id", "id AS n")
    rows = spark.range(5000).selectExpr(
        "id % 800 AS conversation_id", "'p' || id % 9 AS participant_id", "'true' AS is_first_call_resolution",
        "'r' || id % 3 AS reason_resolution_fcr", "id AS load_datetime",
    )
    bridge = spark.range(5000).selectExpr("id % 800 AS conversation_id", "'p' || id % 8 AS participant_id", "'a' || id % 5 AS agent_id")
    values = ["is_first_call_resolution", "reason_resolution_fcr"]
    resolved = results.resolution_per_agent(rows, bridge)
    joined = joins.wildcard_join(left, resolved, "conversation_id", "agent_id", values)
    assert moved_with(joined, "n") == 1
    # Each of the two sides: to the bridge and to the conversation.
    assert moved_with(joined, "reason_resolution_fcr") == 4
    raw = rows.selectExpr("conversation_id", "participant_id AS agent_id", *values)
    assert moved_with(joins.wildcard_join(left, raw, "conversation_id", "agent_id", values), "n") == 1


def test_rows_joined_to_the_bridge_move_once(spark, rows):
    """Before, they moved to (conversation, participant) and again to the conversation."""
    logs = spark.range(3000).selectExpr("'c' || id % 400 AS conversation_id", "'p' || id % 7 AS participant_id", "id % 11 AS agent_bp_number")
    staff = spark.range(30).selectExpr(
        "'a' || id AS agent_id", "id % 10 AS agent_bp_number", "id AS supervisor_bp_number", "199901 AS period_id",
        "TIMESTAMP_NTZ'1999-01-01 00:00:00' AS load_datetime",
    )
    bridge = results.agent_bridge(logs, staff)
    people = [(f"a{k}", k % 10) for k in range(30)]
    wanted = {(f"c{k % 400}", f"p{k % 7}", a) for k in range(3000) for a, bp in people if bp == k % 11}
    assert rows(bridge) == sorted(wanted)
    resolution = spark.range(5000).selectExpr(
        "'c' || id % 500 AS conversation_id", "'p' || id % 9 AS participant_id", "'true' AS is_first_call_resolution",
        "'r' || id % 3 AS reason_resolution_fcr", "id AS load_datetime",
    )
    assert moved_with(results.resolution_per_agent(resolution, bridge), "reason_resolution_fcr") == 1


def test_scan_tasks_stay_small(spark, tmp_path):
    path, asked = str(tmp_path / "t"), "spark.sql.files.minPartitionNum"
    spark.range(3_000_000, numPartitions=1).select(F.rand(1)).write.option("parquet.block.size", 1 << 20).parquet(path)
    spark.conf.set(asked, 1)
    try:
        assert spark.read.parquet(path).rdd.getNumPartitions() >= 2
    finally:
        spark.conf.unset(asked)
