"""Row-wise rules: NULLs, ties and boundaries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from contact_mart.functions import arrays, dates, rules
from contact_mart.operators import lookups
from contact_mart.params import Params, first_of_previous_month

AGENT = "struct<agent_id:string,first_category:string,second_category:string,third_category:string>"
WORK = "array<struct<agent_id:string,bp_executive_num:bigint,aht:double>>"


def test_sunday_weeks(spark, rows):
    days = spark.createDataFrame([(date(2026, 1, 1),), (date(2026, 1, 3),), (date(2026, 1, 4),)], "d date")
    assert rows(days, "d", dates.sunday_week(F.col("d"))) == [
        (date(2026, 1, 1), 0), (date(2026, 1, 3), 0), (date(2026, 1, 4), 1),
    ]
    assert [dates.sunday_week_of(date(2026, 1, d)) for d in (1, 3, 4)] == [0, 0, 1]


def test_window_start_over_the_year_end(spark, rows):
    assert first_of_previous_month(date(2026, 1, 31)) == date(2025, 12, 1)
    day = spark.createDataFrame([(date(2026, 3, 31),)], "d date")
    assert rows(day, dates.window_start(F.col("d"))) == [(date(2026, 2, 1),)]


def test_month_gap_counts_calendar_months(spark, rows):
    pair = spark.createDataFrame([(202512, 202601), (202601, 202601), (None, 202601)], "a int, b int")
    assert rows(pair, dates.month_gap(F.col("a"), F.col("b"))) == [(0,), (1,), (None,)]


def test_longest_segment_puts_unknown_time_last_and_breaks_ties_by_agent(spark, rows):
    df = spark.createDataFrame(
        [
            ("null time", [("a", 1, None), ("b", 2, 3.0)]),
            ("tie", [("b", 2, 5.0), ("a", 1, 5.0)]),
            ("empty", []),
            ("none", None),
        ],
        f"k string, s {WORK}",
    )
    top = arrays.longest_segment(F.col("s"))
    assert rows(df, "k", top["agent_id"], top["bp_executive_num"], top["aht"]) == [
        ("empty", None, None, None), ("none", None, None, None), ("null time", "b", 2, 3.0), ("tie", "a", 1, 5.0),
    ]


def test_busiest_agent_sums_per_agent(spark, rows):
    df = spark.createDataFrame(
        [
            ("sum", [("a", 1, 4.0), ("b", 2, 3.0), ("b", 2, 2.0)]),
            ("tie", [("b", 2, 5.0), ("a", 1, 2.0), ("a", 1, 3.0)]),
            ("unknown", [("a", 1, None), ("b", 2, 0.0)]),
            ("only unknown", [("b", 2, None), ("a", 1, None)]),
            ("part unknown", [("a", 1, None), ("a", 1, 2.0), ("b", 2, 1.0)]),
            ("nobody", [(None, 1, 9.0)]),
        ],
        f"k string, s {WORK}",
    )
    assert rows(df, "k", arrays.busiest_agent(F.col("s"))) == [
        ("nobody", None), ("only unknown", "a"), ("part unknown", "a"), ("sum", "b"), ("tie", "a"), ("unknown", "b"),
    ]


def test_busiest_agent_equals_the_exploded_form(spark, rows):
    from contact_mart.operators.aggregates import agent_time_total, top_agent_by_time

    data = [
        (f"c{n}", [(None if (n + i) % 5 == 0 else f"a{(n * i) % 4}", 1, None if (n + i) % 7 == 0 else float((n * 3 + i) % 6))
                   for i in range(n % 6)])
        for n in range(60)
    ]
    df = spark.createDataFrame(data, f"conversation_id string, skill_lookup {WORK}")
    inside = df.select("conversation_id", arrays.busiest_agent(F.col("skill_lookup")).alias("a")).where("a is not null")
    assert rows(inside) == rows(top_agent_by_time(agent_time_total(df)), "conversation_id", "agent_id")


def test_categories_of_agent_prefer_specific_and_count_null_as_specific(spark, rows):
    df = spark.createDataFrame(
        [
            ("generic first", [("a", "OTROS", "x", None), ("a", "VENTAS", "y", None)], "a"),
            ("null wins", [("a", "OTROS", "x", None), ("a", None, "y", None)], "a"),
            ("absent", [("b", "VENTAS", "y", None)], "a"),
        ],
        f"k string, l array<{AGENT}>, a string",
    )
    own = arrays.categories_of(F.col("l"), F.col("a"))
    assert rows(df, "k", own["first_category"], own["second_category"]) == [
        ("absent", None, None), ("generic first", "VENTAS", "y"), ("null wins", None, "y"),
    ]


def test_array_aggregates_are_null_without_input(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", ["x"]), ("b", None), ("c", [])], "k string, v array<string>")
    out = df.groupBy("k").agg(arrays.concat_arrays(F.col("v")).alias("c"), arrays.merge_arrays(F.col("v")).alias("m"))
    assert rows(out) == [("a", None, None), ("b", ["x"], ["x"]), ("c", [], [])]


def test_latest_skips_or_keeps_nulls(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (1, "b")], "t int, v string")
    out = df.agg(arrays.latest(F.col("v"), F.col("t")), arrays.latest(F.col("v"), F.col("t"), ignore_nulls=False))
    assert rows(out) == [("b", None)]


def test_effective_time_is_null_for_factor_zero(spark, rows):
    df = spark.createDataFrame([("chat", 10.0, 0.0), ("voz", 10.0, 0.0), ("wsp", 10.0, 4.0)], "c string, t double, f double")
    assert rows(df, "c", rules.effective_time(F.col("c"), F.col("t"), F.col("f"))) == [
        ("chat", None), ("voz", 10.0), ("wsp", 2.5),
    ]


def test_nps_variants(spark, rows):
    df = spark.createDataFrame([("7",), ("x",), (None,), ("10",), ("0",)], "s string")
    assert rows(df, "s", rules.nps_by_text(F.col("s")), rules.nps_by_number(F.col("s"))) == [
        ("0", -100, -100), ("10", 100, 100), ("7", 0, 0), ("x", 0, None), (None, None, None),
    ]


def test_homologation_tables(spark, rows):
    assert len(lookups.first_owner(lookups.CATEGORIES)) == 45
    assert len(lookups.COUNTRIES) == 32
    df = spark.createDataFrame([("PT",), ("PORTUGAL",), ("SSC",), (None,), ("UK",)], "market_code string")
    assert rows(lookups.with_country(df)) == [
        ("PORTUGAL", "PT"), ("PT", "BR"), ("SSC", "OT"), ("UK", "GB"), (None, "OT"),
    ]
    raw = spark.createDataFrame([("None",), (None,), ("ventas",), ("UPG",)], "category string")
    assert rows(lookups.homologate(raw, "category", "good")) == [
        ("None", "OTROS"), ("UPG", "CANJE"), ("ventas", "NOT_CATEGORIZED"), (None, "NOT_CATEGORIZED"),
    ]


def test_market_rules(spark, rows):
    df = spark.createDataFrame([("BR", "cl"), ("CL", "br"), (None, "cl"), (None, None)], "m string, c string")
    assert rows(df, "m", "c", rules.market(F.col("m"), F.col("c")), rules.market_zone(F.col("m"), F.col("c"))) == [
        ("BR", "cl", "BR", "BR"), ("CL", "br", "CL", "SSC"), (None, "cl", "CL", "CL"), (None, None, "SSC", "SSC"),
    ]


def test_tenure_labels_of_both_versions(spark, rows):
    from contact_mart.plans.reports import TENURE_V1, TENURE_V2

    df = spark.createDataFrame([(0,), (1,), (2,), (31,), (200,), (211,), (None,)], "d int")
    assert rows(df, "d", rules.tenure_label(F.col("d"), *TENURE_V1), rules.tenure_label(F.col("d"), *TENURE_V2)) == [
        (0, "S/I", "b 30-60"), (1, "S/I", "a 0-30"), (2, "a 0-30", "a 0-30"), (200, "g >180", "g 180-210"),
        (211, "g >180", "h >210"), (31, "b 30-60", "b 30-60"), (None, "S/I", "S/I"),
    ]


def test_month_labels_follow_the_years():
    labels = dict(Params(label_years=(2024, 2025)).month_label_rows())
    assert len(labels) == 24
    assert (labels["Ene24"], labels["Apr24"], labels["Dec25"]) == ("2024-01", "2024-04", "2025-12")
    assert len(Params(as_of=date(2026, 5, 1)).month_label_rows()) == 36


def test_lists_of_one_element_are_rendered_as_longer_ones(spark, rows):
    from contact_mart.checks.registry import agents_text, names_text

    kind = "k int, names array<string>, agents array<struct<agent_id:string,first_category:string,second_category:string,third_category:string>>"
    lone, other = ("a", None, "s", "t"), ("b", "f", None, None)
    df = spark.createDataFrame(
        [(1, ["n"], [lone]), (2, [None], [None]), (3, ["n", None], [other, lone]), (4, [], []), (5, None, None)], kind
    )
    assert rows(df.select("k", names_text("names").alias("n"), agents_text("agents").alias("a"))) == [
        (1, "n", "a/~/s/t"), (2, "~", "~/~/~/~"), (3, "n|~", "a/~/s/t|b/f/~/~"), (4, "", ""), (5, None, None),
    ]
