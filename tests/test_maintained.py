"""Maintained state, sketches and the cutover of the demand."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from contact_mart.operators import aggregates, scaling, sketches
from contact_mart.params import Params
from contact_mart.plans.first_seen import FirstSeen

MART = "call_date date, bps array<long>"


def mart_of(spark, rows):
    lookup = F.transform("bps", lambda b: F.struct(b.alias("bp_executive_num")))
    return spark.createDataFrame(rows, MART).select("call_date", lookup.alias("skill_lookup"))


def test_first_seen_after_three_runs_equals_the_full_form(spark, rows, tmp_path):
    """Each run changes the window: agents appear, go again, and move to a later day."""
    rng = random.Random(3)
    day = lambda lo, hi: date(2026, 1, 1) + timedelta(rng.randrange(lo, hi))
    some = lambda n, lo, hi: [(day(lo, hi), [rng.choice([*range(30), None]) for _ in range(rng.randrange(4))]) for _ in range(n)]
    past, state = some(30, 0, 59), FirstSeen(spark, str(tmp_path / "seen"))
    state.refresh(mart_of(spark, past + some(20, 59, 90)))
    for start in (date(2026, 3, 1), date(2026, 4, 1), date(2026, 3, 1)):
        past = [r for r in past if r[0] < start]
        current = past + some(15, (start - date(2026, 1, 1)).days, 140) + [(None, [99])]
        mart = mart_of(spark, current)
        state.refresh(mart, start)
        assert rows(state.read()) == rows(aggregates.first_seen(mart).where("first_seen is not null"))
        past = current[:-1]
    with pytest.raises(ValueError):
        state.refresh(mart, date(2026, 3, 2))


def test_a_refresh_takes_over_the_window_alone(spark, tmp_path):
    state = FirstSeen(spark, str(tmp_path / "seen"))
    state.refresh(mart_of(spark, [(date(2026, 1, 5), [1]), (date(2026, 2, 5), [1, 2])]))
    state.refresh(mart_of(spark, [(date(2026, 1, 1), [7]), (date(2026, 2, 7), [2])]), date(2026, 2, 1))
    assert sorted(tuple(r) for r in state.read().collect()) == [(1, date(2026, 1, 5)), (2, date(2026, 2, 7))]


def test_sketches_of_days_merge_to_any_period(spark):
    rows = spark.range(60_000).select(
        F.date_add(F.lit(date(2026, 1, 1)), (F.col("id") % 30).cast("int")).alias("call_date"), F.lit("g").alias("canal"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("c"), F.floor(F.col("id") / 3).cast("string"))).alias("c"), (F.col("id") % 500).alias("a"),
    )
    days = sketches.daily_sketches(rows, ["canal"], {"c": "c", "a": "a"})
    assert days.count() == 30
    for start, until in ((None, None), (date(2026, 1, 5), date(2026, 1, 9)), (date(2026, 1, 30), None)):
        near = sketches.distinct_over(days, ["canal"], ["c", "a"], start, until).first()
        part = rows if start is None else rows.where(F.col("call_date") >= F.lit(start))
        part = part if until is None else part.where(F.col("call_date") < F.lit(until))
        for name in ("c", "a"):
            exact = part.select(name).where(f"{name} is not null").distinct().count()
            assert abs(near[name] - exact) <= 4 * sketches.standard_error() * exact + 1
    assert sketches.distinct_over(days.where("false"), ["canal"], ["c"]).count() == 0


def test_demand_is_counted_once_across_the_cutover(spark, rows):
    """A wide table that runs past the cutover adds nothing there; its columns are parameters."""
    p = Params(as_of=date(2026, 3, 1), min_date=date(2025, 11, 1), cutover=date(2026, 1, 1))
    wide = spark.createDataFrame([("Dec25", 5.0, 1.0), ("Ene26", 7.0, None), ("Feb26", 9.0, 2.0)], "mes string, v double, w double")
    daily = spark.createDataFrame(
        [(date(2025, 12, 9), "Calls", "BR", 1.0), (date(2026, 1, 2), "Calls", "BR", 3.0)], "date date, channel string, country string, N_R double"
    )
    past = scaling.historic_demand(wide, p, {"voz": "v", "wsp": "w"})
    assert rows(past, "mes", "canal", "valor") == [("2025-12", "voz", 5.0), ("2025-12", "wsp", 1.0)]
    both = past.unionByName(scaling.current_demand(daily, p))
    assert rows(both.groupBy("mes").agg(F.count("*").alias("n"))) == [("2025-12", 2), ("2026-01", 1)]
    later = scaling.historic_demand(wide, replace(p, cutover=date(2026, 2, 1)), {"voz": "v"})
    assert rows(later, "mes") == [("2025-12",), ("2026-01",)]
