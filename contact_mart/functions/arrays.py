"""Array columns: wrapping, merging inside a group, picking one element.

All of these stay inside the row or use aggregates with a map-side step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GENERIC_CATEGORIES = ("OTROS", "SIN_CONTEXTO")


def singleton(value: Column, empty_on_null: bool = False) -> Column:
    wrapped = F.array(value)
    return F.when(value.isNull(), F.slice(wrapped, 1, 0)).otherwise(wrapped) if empty_on_null else wrapped


def null_if_empty(values: Column) -> Column:
    return F.when(F.size(values) > 0, values)


def collect_distinct(value: Column) -> Column:
    """Aggregate: sorted distinct non-NULL values, NULL when there are none."""
    return null_if_empty(F.array_sort(F.collect_set(value)))


def csv_distinct(value: Column) -> Column:
    """Aggregate: comma list of the distinct values in text order, NULL when there are none."""
    return F.array_join(collect_distinct(value.cast("string")), ",")


def concat_arrays(values: Column) -> Column:
    """Aggregate: all arrays of the group joined, NULL when every array is NULL."""
    return F.flatten(null_if_empty(F.collect_list(values)))


def merge_arrays(values: Column) -> Column:
    """Aggregate: sorted distinct elements over all arrays of the group.

    Equal arrays meet in ``collect_set`` before the shuffle, so a list repeated
    on every row of its group is sent once per map task.
    """
    return F.array_sort(F.array_distinct(F.flatten(null_if_empty(F.collect_set(values)))))


def latest(value: Column, moment: Column, ignore_nulls: bool = True) -> Column:
    """Aggregate: value with the last ``moment``; the larger value wins a tie."""
    key = F.struct(moment, value)
    return F.max_by(value, F.when(value.isNotNull(), key) if ignore_nulls else key)


def is_generic(category: Column) -> Column:
    """1 for a category without content. NULL counts as specific."""
    return F.when(category.isin(*GENERIC_CATEGORIES), 1).otherwise(0)


def longest_segment(lookup: Column) -> Column:
    """Element with the largest handling time: NULL times last, then the smaller agent id. A list of one element needs
    no loop, which is not compiled."""

    def ranked(s: Column) -> Column:
        return F.struct(
            s["aht"].isNull().alias("no_time"),
            (-s["aht"]).alias("minus_time"),
            s["agent_id"].alias("agent_id"),
            s["bp_executive_num"].alias("bp_executive_num"),
            s["aht"].alias("aht"),
        )

    return F.when(F.size(lookup) == 1, ranked(F.get(lookup, F.lit(0)))).otherwise(F.array_min(F.transform(lookup, ranked)))


def busiest_agent(lookup: Column) -> Column:
    """Agent with the largest summed handling time inside one array of segments.

    One pass over the elements sorted by agent: the state holds the running agent
    and the best one so far. A NULL total loses against any number and ties go
    to the smaller agent id.
    """
    worked = F.array_sort(
        F.transform(
            F.filter(lookup, lambda s: s["agent_id"].isNotNull()),
            lambda s: F.struct(s["agent_id"].alias("agent"), s["aht"].cast("double").alias("time")),
        )
    )
    no_agent, no_time = F.lit(None).cast("string"), F.lit(None).cast("double")
    begin = F.struct(
        no_agent.alias("agent"), no_time.alias("time"), no_agent.alias("best"), no_time.alias("best_time")
    )

    def better(state: Column) -> Column:
        return state["best"].isNull() | (
            state["time"].isNotNull() & (state["best_time"].isNull() | (state["time"] > state["best_time"]))
        )

    def settle(state: Column) -> tuple[Column, Column]:
        wins = state["agent"].isNotNull() & better(state)
        return (
            F.when(wins, state["agent"]).otherwise(state["best"]),
            F.when(wins, state["time"]).otherwise(state["best_time"]),
        )

    def step(state: Column, item: Column) -> Column:
        same = state["agent"].eqNullSafe(item["agent"])
        total = F.when(state["time"].isNull(), item["time"]).otherwise(
            state["time"] + F.coalesce(item["time"], F.lit(0.0))
        )
        best, best_time = settle(state)
        return F.struct(
            item["agent"].alias("agent"),
            F.when(same, total).otherwise(item["time"]).alias("time"),
            F.when(same, state["best"]).otherwise(best).alias("best"),
            F.when(same, state["best_time"]).otherwise(best_time).alias("best_time"),
        )

    return F.aggregate(worked, begin, step, lambda state: settle(state)[0])


def categories_of(agents: Column, agent: Column) -> Column:
    """Categories listed for ``agent``: a specific entry before a generic one, then by text."""
    own = F.filter(agents, lambda a: a["agent_id"] == agent)
    return F.array_min(
        F.transform(
            own,
            lambda a: F.struct(
                is_generic(a["first_category"]).alias("generic"),
                a["first_category"].alias("first_category"),
                a["second_category"].alias("second_category"),
                a["third_category"].alias("third_category"),
            ),
        )
    )
