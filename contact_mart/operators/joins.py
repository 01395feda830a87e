"""Join forms. None carries a broadcast hint: small sides are small tables, whose
size the planner knows, and large ones are shuffled and split when skewed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contact_mart.functions.rules import stripped
from contact_mart.functions import dates
from contact_mart.operators.dedup import top1


def _both(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k] == right[k] for k in keys])


def left_lookup(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """LEFT equi join whose right-hand keys are dropped from the result."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on.values()})
    test = reduce(lambda a, b: a & b, [F.col(l) == F.col(f"_r_{r}") for l, r in on.items()])
    return left.join(renamed, test, "left").drop(*[f"_r_{r}" for r in on.values()])


def left_lookup_trimmed(left: DataFrame, key: str, right: DataFrame, trimmed_key: str) -> DataFrame:
    """LEFT equi join of a padded text key to an already trimmed one."""
    return left_lookup(left.withColumn("_key", stripped(F.col(key))), right, {"_key": trimmed_key}).drop("_key")


def exact_or_fallback(
    left: DataFrame, right: DataFrame, key: str, optional: str, values: list[str]
) -> DataFrame:
    """LEFT join on (key, optional), else on the rows of ``key`` without ``optional``.

    The choice is made per column, so one result row may mix both sources.
    """
    exact = right.where(F.col(optional).isNotNull()).select(
        F.col(key).alias("_k1"), F.col(optional).alias("_o1"), *[F.col(v).alias(f"_exact_{v}") for v in values]
    )
    general = right.where(F.col(optional).isNull()).select(
        F.col(key).alias("_k2"), *[F.col(v).alias(f"_general_{v}") for v in values]
    )
    joined = left.join(general, F.col(key) == F.col("_k2"), "left").join(
        exact, (F.col(key) == F.col("_k1")) & (F.col(optional) == F.col("_o1")), "left"
    )
    chosen = [F.coalesce(f"_exact_{v}", f"_general_{v}").alias(v) for v in values]
    return joined.select(*[c for c in left.columns if c not in values], *chosen)


def outer_sides(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> tuple[DataFrame, DataFrame]:
    """FULL OUTER join on one key in two parts: the LEFT join, and the unmatched right rows.

    A full outer join cannot be split at run time when one key is hot; a LEFT and an
    ANTI join can, and the anti side holds each key once.
    """
    matched = left.join(right, F.col(left_key) == F.col(right_key), "left")
    keys = left.select(F.col(left_key).alias("_seen")).where(F.col("_seen").isNotNull()).distinct()
    return matched, right.join(keys, F.col(right_key) == F.col("_seen"), "left_anti")


def outer_parts(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """FULL OUTER join on one key, as LEFT join plus the unmatched right rows."""
    matched, unmatched = outer_sides(left, right, left_key, right_key)
    return matched.unionByName(unmatched, allowMissingColumns=True)


def _own_and_open(right: DataFrame, key: str, optional: str, values: list[str], name: str = "") -> tuple[DataFrame, DataFrame]:
    """The two indexes of a wildcard join: rows with ``optional``, by (key, optional), and rows without, by key."""
    ties = [F.col(v).asc_nulls_first() for v in values]
    found = F.struct(*values)
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*ties))
    own = right.where(F.col(optional).isNotNull()).select(
        F.col(key).alias(f"_k{name}"),
        F.col(optional).alias(f"_o{name}"),
        found.alias(f"_own{name}"),
        place(key, optional).alias(f"_place{name}"),
    )
    open_ = right.where(F.col(optional).isNull()).select(
        F.col(key).alias(f"_k2{name}"), found.alias(f"_open{name}"), (place(key) == 1).alias(f"_first{name}")
    )
    return own, open_


def wildcard_join(left: DataFrame, right: DataFrame, key: str, optional: str, values: list[str]) -> DataFrame:
    """LEFT join on ``key`` where a right row without ``optional`` fits every left row.

    A left row may meet its own rows and the open ones; all are kept. The right side is two
    indexes, each met by an equi join: open rows on the key, own rows on (key, optional), which
    finds the left rows where the first join has them. So that own rows do not multiply with open
    ones, the first open match of a left row meets them all and the others none; the pairs are
    then listed, open match once.
    """
    own, open_ = _own_and_open(right, key, optional, values)
    same = (F.col(key) == F.col("_k")) & (F.col(optional) == F.col("_o"))
    joined = left.join(open_, F.col(key) == F.col("_k2"), "left").join(own, same & F.coalesce("_first", F.lit(True)), "left")
    once = F.when(F.coalesce("_place", F.lit(1)) == 1, F.col("_open"))
    listed = joined.withColumn("_met", F.explode_outer(F.array_compact(F.array(F.col("_own"), once))))
    return listed.select(*left.columns, *[F.col(f"_met.{v}").alias(v) for v in values])


def wildcard_lists(
    left: DataFrame, sides: dict[str, tuple[DataFrame, list[str]]], key: str, optional: str, own_key: str
) -> DataFrame:
    """Several wildcard joins of one left side, the matches of each as a list column to be unfolded last.

    ``sides``: right side and values by the name of the list; each lies with its ``key``. ``own_key``: column of the
    left side for ``optional``. The own rows of all sides come first, as their order of (key, own key) also serves all
    joins on the key that follow; wide rows are sorted once. The first own match of a left row meets all open ones and
    the others none, and an own match is listed with the first of them. A list without a match holds one NULL.
    """
    indexes = {name: _own_and_open(right, key, optional, values, name) for name, (right, values) in sides.items()}
    rows = left
    for name, (own, _) in indexes.items():
        rows = rows.join(own, (F.col(key) == F.col(f"_k{name}")) & (F.col(own_key) == F.col(f"_o{name}")), "left")
    for name, (_, open_) in indexes.items():
        first_own = F.coalesce(F.col(f"_place{name}"), F.lit(1)) == 1
        rows = rows.join(open_, (F.col(key) == F.col(f"_k2{name}")) & first_own, "left")
    lists = []
    for name in sides:
        once = F.when(F.coalesce(F.col(f"_first{name}"), F.lit(True)), F.col(f"_own{name}"))
        met = F.col(f"_open{name}")
        both = F.when(once.isNull(), F.array(met)).when(met.isNull(), F.array(once)).otherwise(F.array(once, met))
        lists.append(both.alias(name))
    return rows.select(*left.columns, *lists)


def unfolded(rows: DataFrame, lists: dict[str, list[str]]) -> DataFrame:
    """One row per entry of each list of ``wildcard_lists``, with the entry's values as columns."""
    for name, values in lists.items():
        others = [c for c in rows.columns if c != name]
        rows = rows.withColumn("_met", F.explode(name)).select(*others, *[F.col(f"_met.{v}").alias(v) for v in values])
    return rows


def nearest_snapshot(
    moments: DataFrame,
    snapshots: DataFrame,
    key: str,
    period: str,
    newest: str,
    values: list[str],
) -> DataFrame:
    """As-of join by month: the snapshot nearest to each distinct (key, month).

    ``moments`` has columns ``key`` and ``month``; months and periods are yyyymm. Ties:
    snapshots not before the month first, then the latest load, then the values. A snapshot
    without a period has no distance and comes first; for an unknown month none has one.

    A merge on one line per key: moments and snapshots (one per period) in the order of
    their months. Two running windows carry the last known and the next known snapshot to
    each moment, and the nearer of the two is taken. The rows are moments plus snapshots.
    """
    ties = [F.col(v).asc_nulls_first() for v in values]
    latest = [F.col(newest).desc_nulls_last(), *ties]
    per_period = top1(snapshots.select(key, period, newest, *values), [key, period], latest)
    known = per_period.where(F.col(key).isNotNull()).select(
        key, F.col(period).alias("_at"), F.lit(False).alias("_asked"), F.struct(period, newest, *values).alias("_snapshot")
    )
    asked = moments.select(key, F.col("month").alias("_at")).where(F.col(key).isNotNull()).distinct()
    line = known.unionByName(asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    # Snapshots without a period come first, so that the running window has met them.
    forth = Window.partitionBy(key).orderBy(F.col("_at").asc_nulls_first(), "_asked").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(key).orderBy(F.col("_at").desc_nulls_last(), "_asked").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(key)
    load = F.col("_snapshot")[newest]
    line = line.withColumn("_load", F.max(load).over(whole))
    freshest = F.when(F.col("_snapshot").isNotNull() & load.eqNullSafe(F.col("_load")), F.struct(
        F.struct(*[F.col("_snapshot")[v].alias(v) for v in values]).alias("order"), F.col("_snapshot").alias("snapshot")
    ))
    dated = F.when(F.col("_at").isNotNull(), F.col("_snapshot"))
    carried = line.select(
        key, "_at", "_asked",
        F.first(F.when(F.col("_at").isNull(), F.col("_snapshot")), True).over(forth).alias("_undated"),
        F.min(freshest).over(whole)["snapshot"].alias("_latest"),
        F.last(dated, True).over(forth).alias("_last"),
        F.last(dated, True).over(back).alias("_next"),
    ).where("_asked")
    gap = lambda side: dates.month_gap(F.col(side)[period], F.col("_at"))
    later = F.col("_last").isNull() | (gap("_next") <= gap("_last"))
    nearest = F.when(F.col("_next").isNotNull() & later, F.col("_next")).otherwise(F.col("_last"))
    chosen = F.when(F.col("_at").isNull(), F.col("_latest")).otherwise(F.coalesce("_undated", nearest))
    found = carried.select(key, F.col("_at").alias("month"), chosen.alias("_snapshot")).where(F.col("_snapshot").isNotNull())
    own = F.col("_snapshot")[period]
    return found.select(
        key, "month",
        dates.month_gap(own, F.col("month")).alias("gap"),
        F.when(own >= F.col("month"), 0).otherwise(1).alias("before"),
        F.col("_snapshot")[newest].alias("loaded"),
        *[F.col("_snapshot")[v].alias(v) for v in values],
    )


def join_nearest(left: DataFrame, nearest: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Attach the result of ``nearest_snapshot``; an unknown month is a month of its own."""
    side = nearest.withColumnsRenamed({key: "_k", "month": "_m"})
    test = (F.col(key) == F.col("_k")) & F.col("month").eqNullSafe(F.col("_m"))
    return left.join(side, test, how).drop("_k", "_m")


def period_lookup(
    df: DataFrame, staff: DataFrame, key: str, staff_key: str, day: str, value: str, name: str
) -> DataFrame:
    """LEFT join on a key and the month of ``day``."""
    side = staff.select(
        F.col(staff_key).alias("_k"), F.col("period_id").alias("_p"), F.col(value).alias(name)
    )
    test = (F.col(key) == F.col("_k")) & (dates.period_of(F.col(day)) == F.col("_p"))
    return df.join(side, test, "left").drop("_k", "_p")
