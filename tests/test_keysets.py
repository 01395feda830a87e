"""Pruning by the window's keys: exactness, bounds, and what an incremental run shuffles."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from contact_mart import Workspace
from contact_mart.operators import keysets
from contact_mart.operators.keysets import KeySet
from contact_mart.plans import results, segments
from contact_mart.plans.conversations import build_intermedia
from contact_mart.sources import driver
from contact_mart.sources.catalog import Sources

SF = "/root/testdata/sf0.001"


@pytest.fixture
def ws(spark):
    workspace = Workspace(spark)
    yield workspace
    workspace.close()


def keys(spark, n, step=1):
    return spark.range(0, n * step, step).select(F.concat(F.lit("k"), "id").alias("k"))


def test_every_key_passes_and_few_others(spark, ws):
    found = KeySet(keys(spark, 20_000, 3), ws)
    assert found.blocks > 1
    rows = keys(spark, 60_000).withColumn("v", F.lit(1))
    left = found.prune(rows, "k")
    assert left.columns == rows.columns
    inside = left.where(F.substring("k", 2, 9).cast("int") % 3 == 0).count()
    assert inside == 20_000
    assert left.count() - inside < 0.04 * 40_000


def test_copies_stay_and_null_keys_go(spark, ws):
    found = KeySet(spark.createDataFrame([("a",), ("a",), (None,)], "k string"), ws)
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("zz", 3)], "k string, v int")
    assert [tuple(r) for r in found.prune(rows, "k").collect()] == [("a", 1), ("a", 1)]


def test_no_keys_let_nothing_pass(spark, ws):
    assert KeySet(keys(spark, 0), ws).prune(keys(spark, 50), "k").count() == 0


def test_numbers_are_keys_like_texts(spark, ws):
    found = KeySet(spark.range(10).select("id"), ws)
    assert {r[0] for r in found.prune(spark.range(5, 15), "id").collect()} >= set(range(5, 10))


def test_more_keys_than_the_bound_are_joined(spark, ws, monkeypatch):
    monkeypatch.setattr(keysets, "MOST_BLOCKS", 0)
    found = KeySet(keys(spark, 100), ws)
    assert found.bits is None
    assert found.prune(keys(spark, 300), "k").count() == 100


def test_the_test_lies_before_any_exchange(spark, ws):
    found = KeySet(keys(spark, 100), ws)
    plan = found.prune(keys(spark, 300), "k").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    assert plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin") and plan.count("Exchange hashpartitioning") == 1


def _shuffled(spark, df):
    """Rows that the exchanges of a query wrote."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    total, left = 0, [plan]
    while left:
        node = left.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            left.append(node.executedPlan())
        elif "QueryStage" in name:
            left.append(node.plan())
        else:
            if name == "Exchange":
                total += node.metrics().get("shuffleRecordsWritten").get().value()
            children = node.children()
            left += [children.apply(i) for i in range(children.size())]
    return total


def _with_history(src, times):
    """Sources whose sessions, tickets, surveys, marks and chat indicators hold strangers, ``times`` as many rows."""
    strange = {
        "participant_sessions": ["conversation_id", "participant_id"], "tickets": ["ticket_id"], "surveys": ["conversation_id"],
        "compliance": ["conversation_id"], "chat_indicators": ["conversationid"],
    }

    def load(name):
        df = src[name]
        if name in strange:
            copies = df.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(times)))).withColumns(
                {c: F.concat(F.lit("old-"), F.col("_n").cast("string"), F.lit("-"), c) for c in strange[name]}
            )
            if name == "tickets":
                copies = copies.withColumn("created_dt", F.add_months("created_dt", -60).cast(df.schema["created_dt"].dataType))
            df = df.unionByName(copies.drop("_n"))
        return df

    return Sources(load)


def test_what_an_incremental_run_shuffles_does_not_follow_the_history(spark, ws):
    plain = driver.driver_sources(spark, SF)
    p = replace(driver.PARAMS, min_date=driver.PARAMS.min_date).incremental()
    moved = {}
    for times in (1, 10):
        src = _with_history(plain, times)
        calculated = ws.stage(segments.build_calculated(src, p, None, ws), f"calculated-{times}")
        third = results.window_sources(build_intermedia(calculated, p), src, p, ws)
        moved[times] = [
            _shuffled(spark, segments.category_rows(src, p, ws)),
            _shuffled(spark, segments.tickets_resolved(src, p, None, ws)),
            *(_shuffled(spark, third[name].groupBy(column).count()) for name, column in results.WINDOWLESS.items()),
        ]
    assert moved[10][0] > 0
    # Without the window's keys the history moves.
    assert _shuffled(spark, segments.category_rows(src, p)) > 2 * moved[10][0]
    for few, many in zip(moved[1], moved[10]):
        assert many <= 1.3 * few + 60, moved
