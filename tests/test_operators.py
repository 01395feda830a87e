"""Joins, ranks, weights and reconciliation on small hand-made frames."""

from __future__ import annotations

from dataclasses import replace
import random
from datetime import date, datetime

from pyspark.sql import functions as F

from contact_mart.operators import aggregates, dedup, filters, joins, reshape, scaling
from contact_mart.operators.reconcile import reconcile
from contact_mart.params import Params
from contact_mart.plans import results, segments
from contact_mart.sources.schemas import SOURCES

P = Params(as_of=date(2026, 6, 1))
CATEGORY = "conversation_id string, agent_id string, first_category string, second_category string, third_category string"


def test_best_category_specific_wins(spark, rows):
    df = spark.createDataFrame(
        [
            ("c1", "a", "OTROS", None, None), ("c1", "a", "VENTAS", None, None),
            ("c2", "a", "SIN_CONTEXTO", None, None), ("c2", "a", None, "s", None),
            ("c3", None, "OTROS", None, None), ("c3", "a", "LOGIN", None, None),
        ],
        CATEGORY,
    )
    assert rows(segments.best_category_per_agent(df), "conversation_id", "agent_id", "first_category") == [
        ("c1", "a", "VENTAS"), ("c2", "a", None), ("c3", "a", "LOGIN"), ("c3", None, "OTROS"),
    ]


def test_exact_or_fallback_mixes_columns(spark, rows):
    left = spark.createDataFrame([("c", "a"), ("c", "z"), ("d", None)], "conversation_id string, agent_id string")
    right = spark.createDataFrame(
        [("c", "a", "own", None, "t"), ("c", None, "open", "fill", None), ("d", None, "d", None, None)], CATEGORY
    )
    out = joins.exact_or_fallback(left, right, "conversation_id", "agent_id", segments.LEVELS)
    assert rows(out) == [("c", "a", "own", "fill", "t"), ("c", "z", "open", "fill", None), ("d", None, "d", None, None)]


def test_wildcard_join_keeps_own_and_open_row(spark, rows):
    left = spark.createDataFrame([("c", "a"), ("d", "a")], "conversation_id string, agent_id string")
    right = spark.createDataFrame([("c", "a", 1), ("c", None, 2), ("c", "b", 3)], "conversation_id string, agent_id string, v int")
    out = joins.wildcard_join(left, right, "conversation_id", "agent_id", ["v"])
    assert rows(out) == [("c", "a", 1), ("c", "a", 2), ("d", "a", None)]


def test_nearest_snapshot_prefers_the_later_month(spark, rows):
    moments = spark.createDataFrame([("k", 202603), ("k", 202512), ("k", None), ("none", 202603)], "key string, month int")
    loaded = datetime(2026, 1, 1)
    staff = spark.createDataFrame(
        [("k", 202602, loaded, 1), ("k", 202604, loaded, 2), ("k", 202604, datetime(2026, 2, 1), 3), ("k", 202510, loaded, 4)],
        "key string, period_id int, load_datetime timestamp, v int",
    )
    near = joins.nearest_snapshot(moments, staff, "key", "period_id", "load_datetime", ["v"])
    out = joins.join_nearest(moments, near, "key")
    assert rows(out, "key", "month", "v") == [("k", 202512, 1), ("k", 202603, 3), ("k", None, 3), ("none", 202603, None)]


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_wildcard_join_equals_the_residual_test(spark, rows):
    """Several own and open rows, equal rows, unknown keys and agents on both sides; both keys are in the equi join."""
    rng = random.Random(1)
    pick = lambda *options: rng.choice(options)
    left = spark.createDataFrame([(pick("a", "b", "c", "d", None), pick("x", "y", "z", None), k // 2) for k in range(60)], "k string, o string, n int")
    right = spark.createDataFrame(
        [(pick("a", "b", "c", "e", None), pick("x", "y", None, None), pick(1, 2, None), pick("s", None)) for _ in range(40)],
        "k string, o string, v int, w string",
    )
    side = right.selectExpr("k rk", "o ro", "v", "w")
    test = (F.col("k") == F.col("rk")) & (F.col("ro").isNull() | (F.col("o") == F.col("ro")))
    wanted = left.join(side, test, "left").drop("rk", "ro")
    out = joins.wildcard_join(left, right, "k", "o", ["v", "w"])
    assert out.columns == wanted.columns
    assert rows(out) == rows(wanted)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = [line for line in _executed(joins.wildcard_join(left, right, "k", "o", ["v", "w"])).splitlines() if "Join" in line]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len(plan) == 2 and not any("NestedLoop" in line for line in plan)
    assert any("[k#" in line and "o#" in line.split("]")[0] for line in plan), plan


def test_lists_of_several_wildcard_joins_equal_one_after_the_other(spark, rows):
    """Several own and open rows a key on both sides, rows without values, unknown keys and agents."""
    rng = random.Random(3)
    pick = lambda *options: rng.choice(options)
    left = spark.createDataFrame([(pick("a", "b", "c", "d", None), pick("x", "y", "z", None), k // 2) for k in range(60)], "k string, o string, n int")
    side = lambda *names: spark.createDataFrame(
        [(pick("a", "b", "c", "e", None), pick("x", "y", None, None), *[pick(1, 2, None) for _ in names]) for _ in range(30)],
        "k string, o string, " + ", ".join(f"{n} int" for n in names),
    ).repartition("k")
    one, two = side("v", "w"), side("u")
    wanted = joins.wildcard_join(joins.wildcard_join(left, one, "k", "o", ["v", "w"]), two, "k", "o", ["u"])
    lists = {"first": (one, ["v", "w"]), "second": (two, ["u"])}
    listed = joins.wildcard_lists(left.withColumn("held", F.coalesce("o", F.lit("none"))), lists, "k", "o", "held").drop("held")
    got = joins.unfolded(listed, {name: values for name, (_, values) in lists.items()})
    assert got.columns == wanted.columns
    assert rows(got) == rows(wanted)


def test_nearest_snapshot_equals_the_ranked_candidates(spark, rows):
    """The merge against a join of all candidates; unknown months, periods, loads and values, ties of all kinds."""
    rng = random.Random(2)
    month = lambda: rng.choice([202311, 202312, 202401, 202402, 202406, 202501, 202412, None])
    for n in range(3):
        loads = [None, datetime(2026, 1, 1), datetime(2026, 1, 1, 5), datetime(2026, 3, 1)]
        moments = spark.createDataFrame([(rng.choice("abcdefgh") if rng.random() < 0.95 else None, month()) for _ in range(90)], "k string, month int")
        snapshots = spark.createDataFrame(
            [(rng.choice("abcdefi"), month() if n or rng.random() < 0.9 else 202403, rng.choice(loads), rng.choice([1, 2, None]), rng.choice(["p", None])) for _ in range(45)]
            + [(None, 202401, None, 1, "p")],
            "k string, period int, loaded timestamp, v int, w string",
        )
        if n == 1:
            snapshots = snapshots.where("period is not null")
        both = moments.where("k is not null").distinct().join(snapshots, "k")
        ranked = both.selectExpr(
            "k", "month", "period", "loaded", "v", "w",
            "abs((floor(period / 100) * 12 + period % 100) - (floor(month / 100) * 12 + month % 100)) gap", "if(period >= month, 0, 1) before",
        )
        order = [F.col("gap").asc_nulls_first(), F.col("before"), F.col("loaded").desc_nulls_last(), F.col("v").asc_nulls_first(), F.col("w").asc_nulls_first()]
        wanted = dedup.top1(ranked, ["k", "month"], order)
        out = joins.nearest_snapshot(moments, snapshots, "k", "period", "loaded", ["v", "w"])
        columns = ("k", "month", "gap", "before", "loaded", "v", "w")
        assert rows(out, *columns) == rows(wanted, *columns)
        assert "Join" not in _executed(out) and "Cartesian" not in _executed(out)


def test_outer_parts_equals_full_outer(spark, rows):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "l string, x int")
    right = spark.createDataFrame([("a", 5), ("a", 6), ("c", 7), (None, 8)], "r string, y int")
    expected = left.join(right, F.col("l") == F.col("r"), "full_outer")
    assert rows(joins.outer_parts(left, right, "l", "r"), "l", "x", "r", "y") == rows(expected, "l", "x", "r", "y")


def test_agent_list_keeps_duplicates_and_puts_generic_last(spark, rows):
    df = spark.createDataFrame(
        [("c", "b", "OTROS", None, None), ("c", "z", "VENTAS", None, None), ("c", "z", "VENTAS", None, None), ("c", None, "LOGIN", None, None)],
        CATEGORY,
    )
    out = aggregates.agents_per_conversation(df).select(F.transform("all_agents", lambda a: a["agent_id"]))
    assert rows(out) == [([None, "z", "z", "b"],)]


def test_best_queue_row_prefers_complete(spark, rows):
    names = [item.split(" ")[0] for item in SOURCES["queue_dictionary"].split(", ")]
    base = dict.fromkeys(names, "x")
    data = [
        {**base, "Nombre_de_Cola": " Q1", "Gerencia": "N/A", "ID_Script": "1"},
        {**base, "Nombre_de_Cola": "Q1 ", "Gerencia": "g", "ID_Cola": None, "ID_Script": "2"},
        {**base, "Nombre_de_Cola": "Q1", "Gerencia": "g", "Cola_con_Demanda": "NO", "ID_Script": "3"},
    ]
    df = spark.createDataFrame([tuple(d[n] for n in names) for d in data], SOURCES["queue_dictionary"])
    assert rows(dedup.best_queue_row(df), "queue_key", "ID_Script") == [("Q1", "3")]


def _segment(**changes):
    row = {
        "conversation_id": "c", "conversation_date": date(2026, 1, 5), "queue_name": "Q", "factory_name": "AeC",
        "talk_time_second": 1.0, "held_time_second": None, "after_call_work_time_second": None, "message_type": None,
        "agent_bp_number": 1, "agent_id": "a", "sag_name": "s", "originating_direction_type": "inbound",
    }
    return tuple({**row, **changes}.values())


def test_segment_filter_drops_null_queue_and_bounds_dates(spark, rows):
    data = [
        _segment(conversation_id="kept"),
        _segment(conversation_id="today", conversation_date=date(2026, 6, 1)),
        _segment(conversation_id="tomorrow", conversation_date=date(2026, 6, 2)),
        _segment(conversation_id="old", conversation_date=date(2023, 12, 31)),
        _segment(conversation_id="null queue", queue_name=None),
        _segment(conversation_id="cargo", queue_name="x Cargo y"),
        _segment(conversation_id="denied", queue_name=" AMC_WSP_BAG_ES "),
        _segment(conversation_id="outbound", originating_direction_type="outbound"),
        _segment(conversation_id="no talk", talk_time_second=None),
        _segment(conversation_id="other partner", factory_name="X"),
    ]
    df = spark.createDataFrame(data, SOURCES["segments"])
    assert rows(filters.filter_segments(df, P), "conversation_id") == [("kept",), ("today",)]


def _ticket(**changes):
    row = {
        "ticket_id": "t", "agent_group_name": "G", "factory_name": None, "language_name": "ES", "contact_form_name": "web",
        "agent_name": "n", "subject_desc": "s", "tag_list": "a", "claim_ai_typification": None, "claim_ai_subtypification": None,
        "agent_email": "e", "created_dt": datetime(2026, 1, 1), "solved_dt": datetime(2026, 1, 1, 0, 0, 11),
    }
    return tuple({**row, **changes}.values())


def test_ticket_filter(spark, rows):
    data = [
        _ticket(ticket_id="kept"),
        _ticket(ticket_id="null tags", tag_list=None),
        _ticket(ticket_id="fast", solved_dt=datetime(2026, 1, 1, 0, 0, 10)),
        _ticket(ticket_id="support", agent_group_name="a Suporte b"),
        _ticket(ticket_id="special form", contact_form_name="special services"),
        _ticket(ticket_id="exception", agent_group_name="HVC KON BR", contact_form_name="Special Services"),
        _ticket(ticket_id="exception group only", agent_group_name="HVC KON BR"),
        _ticket(ticket_id="test", subject_desc="a Test Gope"),
        _ticket(ticket_id="year", created_dt=datetime(2023, 12, 31), solved_dt=datetime(2026, 1, 1)),
    ]
    df = spark.createDataFrame(data, SOURCES["tickets"])
    assert rows(filters.filter_tickets(df, P), "ticket_id") == [("exception",), ("kept",)]


def test_split_is_a_partition_of_the_rows(spark, rows):
    df = spark.createDataFrame([("whatsapp", "HUMAN"), (None, "HUMAN"), ("whatsapp", None), ("voice", "HUMAN")],
                               "channel_type string, is_human string")
    inside, outside = filters.split(df, filters.is_chat_segment())
    assert rows(inside) == [("whatsapp", "HUMAN")]
    assert inside.count() + outside.count() == df.count()


def test_unpivot_drops_null_measures(spark, rows):
    df = spark.createDataFrame([("m", 1.0, None)], "mes string, voz double, chat double")
    assert rows(reshape.unpivot_measures(df, ["mes"], ["voz", "chat"], "canal", "valor")) == [("m", "voz", 1.0)]
    assert reshape.unpivot_measures(df, ["mes"], ["voz", "chat"], "canal", "valor", keep_nulls=True).count() == 2


FACTORS = "mes string, canal string, zona string, is_human string, valor double"


def test_scaling_factors_before_and_after_the_cutover(spark, rows):
    counts = spark.createDataFrame(
        [
            ("2025-12", "voz", "BR", "HUMAN", 2.0), ("2025-12", "voz", "SSC", "HUMAN", 2.0),
            ("2025-12", "voz", "BR", "NOT_HUMAN", 9.0), ("2025-12", "voz", "BR", "BOTH", 1.0),
            ("2026-01", "voz", "BR", "HUMAN", 4.0), ("2026-01", "voz", "SSC", "HUMAN", 4.0),
            ("2026-01", "voz", "BR", "NOT_HUMAN", 2.0), ("2026-01", "voz", "BR", "BOTH", 3.0), ("2026-01", "voz", "CL", "HUMAN", 1.0),
        ],
        FACTORS,
    )
    wanted = spark.createDataFrame(
        [
            ("2025-12", "voz", None, "HUMAN", 12.0), ("2026-01", "voz", "BR", "HUMAN", 2.0),
            ("2026-01", "voz", "SSC", "HUMAN", 0.0), ("2026-01", "voz", "BR", "NOT_HUMAN", 5.0),
        ],
        FACTORS,
    )
    assert rows(scaling.scaling_factors(counts, wanted, P)) == [
        ("2025-12", "voz", "BR", "BOTH", 0.0), ("2025-12", "voz", "BR", "HUMAN", 3.0),
        ("2025-12", "voz", "BR", "NOT_HUMAN", 1.0), ("2025-12", "voz", "SSC", "HUMAN", 3.0),
        ("2026-01", "voz", "BR", "BOTH", 0.0), ("2026-01", "voz", "BR", "HUMAN", 0.5),
        ("2026-01", "voz", "BR", "NOT_HUMAN", 2.5), ("2026-01", "voz", "CL", "HUMAN", 0.0),
        ("2026-01", "voz", "SSC", "HUMAN", 0.0),
    ]


def test_demand_meets_the_counts_without_zone_before_the_cutover(spark, rows):
    """The query on a layer of its own: months before the cutover (1999) have demand without a zone, against all zones."""
    from types import SimpleNamespace

    from contact_mart.checks.all import QUERIES
    from contact_mart.session import Workspace
    from contact_mart.sources.driver import PARAMS
    from contact_mart.sources.schemas import INTERMEDIA, conform

    old, new = date(1998, 12, 1), date(1999, 1, 1)
    contacts = spark.createDataFrame(
        [(f"{i}{day}", day, "voice", "HUMAN", zone) for day in (old, new) for i, zone in enumerate(["BR", "SSC", "SSC"])]
        + [("bot", old, "voice", "NOT_HUMAN", "BR"), ("chat", new, "webmessaging", "HUMAN", "BR")],
        "conversation_id string, call_date date, channel_type string, is_human string, mercado string",
    )
    wide = "mes string, demanda_voz_agente double, wa double, livechat double, casos_validado_com_gabi double, redes_sociales double"
    c = SimpleNamespace(
        p=PARAMS,
        ws=Workspace(spark),
        intermedia_once=conform(contacts, INTERMEDIA),
        src={
            "demand_wide": spark.createDataFrame([("Dec98", 12.0, None, None, None, None)], wide),
            "demand_daily": spark.createDataFrame(
                [(new, "Calls", "BR", 5.0), (new, "Calls", "CL", 8.0), (old, "Calls", "BR", 99.0)],
                "date date, channel string, country string, N_R double",
            ),
        },
    )
    found = QUERIES["join_zone_month_demand"](c)
    assert rows(found, "mes", "canal", "zona", "is_human", "valor", "wanted", "total", "factor") == [
        ("1998-12", "voz", "BR", "HUMAN", 1, 12.0, 3, 4.0),
        ("1998-12", "voz", "BR", "NOT_HUMAN", 1, None, 1, 1.0),
        ("1998-12", "voz", "SSC", "HUMAN", 2, 12.0, 3, 4.0),
        ("1999-01", "chat", "BR", "HUMAN", 1, None, 1, 0.0),
        ("1999-01", "voz", "BR", "HUMAN", 1, 5.0, 1, 5.0),
        ("1999-01", "voz", "SSC", "HUMAN", 2, 8.0, 2, 4.0),
    ]
    c.ws.close()


WEIGHTED = "k string, call_date date, canal string, market_code string, is_human string, category string, factor double, kept_bot_category boolean"


def _weighted(spark):
    day, old = date(2026, 2, 1), date(2025, 2, 1)
    return spark.createDataFrame(
        [
            ("cat", day, "voz", "BR", "HUMAN", "VENTAS", 1.0, False), ("open", day, "voz", "BR", "HUMAN", "NOT_CATEGORIZED", 3.0, False),
            ("kept", day, "voz", "BR", "HUMAN", "VENTAS", 1.0, True), ("zero", day, "voz", "BR", "HUMAN", "VENTAS", 0.0, False),
            ("null", day, "voz", "BR", "HUMAN", "VENTAS", None, False), ("bot", day, "voz", "BR", "NOT_HUMAN", "VENTAS", 7.0, False),
            ("open bot", day, "voz", "BR", "NOT_HUMAN", "NOT_CATEGORIZED", 7.0, False), ("both", day, "voz", "BR", "BOTH", "VENTAS", 7.0, False),
            ("old ticket", old, "cases", "BR", "HUMAN", "NOT_CATEGORIZED", 2.0, False),
            ("new ticket", day, "cases", "BR", "HUMAN", "NOT_CATEGORIZED", 2.0, False),
            ("social", day, "rrss", None, "HUMAN", "NOT_CATEGORIZED", 9.0, False),
            ("no market", day, "voz", None, "HUMAN", "VENTAS", 4.0, False),
            ("on cutover", date(2026, 1, 1), "cases", "BR", "HUMAN", "VENTAS", 5.0, False),
        ],
        WEIGHTED,
    )


def test_factor_plus_rule_order(spark, rows):
    df = _weighted(spark)
    out = dict(rows(scaling.factor_plus(df, scaling.category_share(df, P), P), "k", "factor_plus"))
    assert out == {
        "cat": 2.5, "open": 0.0, "kept": 2.5, "zero": 0.0, "null": 0.0, "bot": 1.0, "open bot": 0.0, "both": 7.0,
        "old ticket": 2.0, "new ticket": 0.0, "social": 0.0, "no market": 4.0, "on cutover": 5.0,
    }


def test_factor_plus_with_kept_bot_categories(spark, rows):
    df, p = _weighted(spark), replace(P, kept_bot=True)
    out = dict(rows(scaling.factor_plus(df, scaling.category_share(df, p), p), "k", "factor_plus"))
    assert (out["cat"], out["kept"]) == (5.0, 0.0)


def test_copies_weigh_in_the_share(spark, rows):
    df = _weighted(spark)
    twice = df.unionByName(df.where("k = 'cat'"))
    counted = results.counted_rows(twice)
    share = scaling.category_share(counted, P, F.col("copies"))
    assert rows(share) == rows(scaling.category_share(twice, P))


def test_null_kpi_rule(spark, rows):
    after, on = date(2026, 1, 2), date(2026, 1, 1)
    df = spark.createDataFrame(
        [("a", after, 1), ("b", after, None), ("c", on, 1)], "k string, call_date date, fcr int"
    ).select("*", *[F.lit(v).alias(n) for n, v in
                    {"is_human": "HUMAN", "canal": "voz", "category": "NOT_CATEGORIZED", "nota_calidad": 4.0}.items()])
    assert rows(results.null_out_kpis(df, P), "k", "fcr", "nota_calidad") == [("a", None, None), ("b", None, 4.0), ("c", 1, 4.0)]


def test_surveys_match_the_own_agent_on_human_voice_only(spark, rows):
    base = spark.createDataFrame(
        [("c", "voz", "HUMAN", 1), ("c", "voz", "NOT_HUMAN", 1), ("c", "wsp", "HUMAN", 1)],
        "conversation_id string, canal string, is_human string, agent_bp bigint",
    )
    surveys = spark.createDataFrame([("c", "2", "9"), ("c", "bad", "5")], "conversation_id string, advisor_bp_number string, nps string")
    assert rows(results.join_surveys(base, surveys), "canal", "is_human", "nps") == [
        ("voz", "HUMAN", None), ("voz", "NOT_HUMAN", "5"), ("voz", "NOT_HUMAN", "9"), ("wsp", "HUMAN", "5"), ("wsp", "HUMAN", "9"),
    ]


def test_cascade_for_tickets_and_others(spark, rows):
    schema = "conversation_id string, canal string, cat_pca string, cat_bot string, second_category string, third_category string"
    main = spark.createDataFrame(
        [("t", "cases", "pca", "bot", "s", "t"), ("u", "cases", None, "bot", "s", "t"), ("v", "voz", None, None, "s", "t"),
         ("w", "wsp", None, "bot", "s", "t"), ("rrss", "rrss", None, None, None, None), ("n", None, "pca", None, "s", "t")],
        schema,
    )
    tips = spark.createDataFrame([("v", "tip1"), ("v", "tip2"), ("rrss", "tip")], "conversation_id string, tip string")
    tickets = spark.createDataFrame(
        [("t", "text", "ts", None), ("w", "text", "ts", None)],
        "conversation_id string, ticket_first_category string, ticket_second_category string, ticket_third_category string",
    )
    out = results.cascade(main, tips, tickets)
    assert rows(out, "conversation_id", "category", "second_category", "kept_bot_category") == [
        ("n", "pca", "s", False), ("rrss", None, None, False), ("t", "text", "ts", False), ("u", "bot", None, True),
        ("v", "tip1", "s", True), ("v", "tip2", "s", True), ("w", "bot", "s", False),
    ]


def test_reconcile_status(spark, rows):
    a = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "factor double, factor_plus double")
    b = spark.createDataFrame([(1.0, 2.0, True), (2.005, 2.5, False)], "factor double, factor_plus double, kept_bot_category boolean")
    out = reconcile(a, b, ["factor", "factor_plus"], "kept_bot_category")
    assert rows(out) == [
        ("kept_bot_category_count", "N/A", "1", "OK"), ("row_count", "2", "2", "OK"),
        ("sum_factor", "3.0", "3.005", "OK"), ("sum_factor_plus", "4.0", "4.5", "DIFF"),
    ]


def test_recontact_flags(spark, rows):
    from contact_mart.plans.reports import recontact_view

    names = [item.split(" ")[0] for item in SOURCES["recontact"].split(", ")]
    base = dict.fromkeys(names)
    data = [{**base, "record_id": "a", "customer_id": "12", "is_recontact_24_hrs": 1},
            {**base, "record_id": "b", "customer_id": "bad", "is_recontact_24_hrs": 0},
            {**base, "record_id": "c", "is_recontact_24_hrs": 1}]
    df = spark.createDataFrame([tuple(d[n] for n in names) for d in data], SOURCES["recontact"])
    out = recontact_view(df)
    assert rows(out, "record_id", "customer_id", "is_traceable_contact", "is_traceable_recontact") == [
        ("a", 12, 1, 1), ("b", None, 1, 0), ("c", None, 0, 0),
    ]


def test_tasks_after_an_exchange_stay_small(spark):
    """A table that 8 partitions would hold is dealt to tasks of some 16 MB."""
    wide = spark.range(1_000_000).select("id", *[F.sha2((F.col("id") + k).cast("string"), 512).alias(f"c{k}") for k in range(4)])
    sizes = wide.repartition("id").groupBy(F.spark_partition_id()).agg(*[F.max(f"c{k}") for k in range(4)])
    assert len(sizes.collect()) > 8
