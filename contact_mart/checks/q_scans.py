"""Inputs and table writing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contact_mart.checks.registry import Context, register
from contact_mart.functions import dates
from contact_mart.operators import filters
from contact_mart.operators.keysets import KeySet
from contact_mart.plans.results import null_out_kpis
from contact_mart.sources.driver import INPUTS
from contact_mart.sources.schemas import SOURCES, conform
from contact_mart.sources.tables import append_layer, read_layer, replace_where, write_layer
from contact_mart.sources.versions import VersionedTable


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps as texts, so that the zone of the session plays no part."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName().startswith("timestamp")]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in times})


def _plain_sql(name: str) -> str:
    columns = []
    for item in SOURCES[name].split(", "):
        column, kind = item.split(" ")
        columns.append(f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}" if kind == "timestamp" else column)
    return ", ".join(columns)


def _scan(name: str):
    return lambda c: _plain(c.src[name])


for _name in INPUTS:
    register(f"scan_{_name}", _scan(_name), f"SELECT {_plain_sql(_name)} FROM in_{_name}")


def _orders(c: Context) -> DataFrame:
    """Orders as a layer table with one partition per month."""
    return c.table("orders").select(
        F.concat(F.lit("c"), F.col("o_orderkey")).alias("conversation_id"),
        F.trunc("o_orderdate", "MM").alias("call_date"),
        F.col("o_totalprice").alias("factor"),
        F.col("o_custkey").alias("customer"),
    )


_ORDERS_SQL = "SELECT 'c' || o_orderkey AS conversation_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS call_date, {0} AS factor, o_custkey AS customer FROM orders"


def full_rebuild(c: Context) -> DataFrame:
    path = c.ws.path("full-rebuild")
    write_layer(_orders(c), path)
    return read_layer(c.spark, path).select("conversation_id", "call_date", "factor", "customer")


register("full_rebuild", full_rebuild, _ORDERS_SQL.format("o_totalprice"))

register(
    "rolling_window_start",
    lambda c: c.table("orders").select("o_orderkey", dates.window_start(F.to_date("o_orderdate")).alias("start")),
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS start FROM orders",
)


def replaced(c: Context) -> DataFrame:
    """New rows exist for every other partition of the window; the others lose their old rows."""
    path = c.ws.path("replace-where")
    start = c.p.incremental().start
    orders = _orders(c)
    write_layer(orders, path)
    fresh = orders.where((F.col("call_date") >= F.lit(start)) & (F.month("call_date") % 2 == 1)).withColumn(
        "factor", F.col("factor") * 2
    )
    replace_where(fresh, path, start)
    return read_layer(c.spark, path).select("conversation_id", "call_date", "factor", "customer")


register(
    "replace_where",
    replaced,
    _ORDERS_SQL.format("CASE WHEN o_orderdate >= DATE '2001-05-01' THEN o_totalprice * 2 ELSE o_totalprice END")
    + " WHERE o_orderdate < DATE '2001-05-01' OR month(o_orderdate) % 2 = 1",
)



def restored(c: Context) -> DataFrame:
    """A table whose window was replaced, appended to and set back: the first version is the current one again."""
    table = VersionedTable(c.spark, c.ws.path("restore"))
    orders = _orders(c)
    first = table.rewrite(orders)
    table.replace_from(orders.where(F.col("call_date") >= F.lit(c.p.cutover)).withColumn("factor", F.lit(0.0)), c.p.cutover)
    table.append(orders.limit(10))
    table.restore(first)
    table.vacuum(keep=1)
    return table.read().select("conversation_id", "call_date", "factor", "customer")


register("restore_version", restored, _ORDERS_SQL.format("o_totalprice"))


def version_counts(c: Context) -> DataFrame:
    """Rows and sums of three versions: rebuilt, window replaced twice. Earlier versions stay readable."""
    table = VersionedTable(c.spark, c.ws.path("versions"))
    orders = _orders(c)
    late = date(2000, 1, 1)
    table.rewrite(orders)
    table.replace_from(orders.where(F.col("call_date") >= F.lit(c.p.cutover)).withColumn("factor", F.lit(1.0)), c.p.cutover)
    table.replace_from(orders.where(F.col("call_date") >= F.lit(late)).withColumn("factor", F.lit(2.0)), late)
    parts = [
        table.read(v).groupBy(F.lit(v).alias("version"), F.year("call_date").alias("year")).agg(
            F.count("*").alias("n"), F.sum(F.when(F.col("factor") <= 2, F.col("factor"))).alias("replaced")
        )
        for v in table.versions()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


register(
    "version_counts",
    version_counts,
    """SELECT v AS version, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
              CAST(sum(CASE WHEN v = 3 AND o_orderdate >= DATE '2000-01-01' THEN 2.0 WHEN v >= 2 AND o_orderdate >= DATE '1999-01-01' THEN 1.0
                            WHEN o_totalprice <= 2 THEN o_totalprice END) AS DOUBLE) AS replaced
       FROM orders, (VALUES (1), (2), (3)) versions(v) GROUP BY 1, 2""",
)

register(
    "windowed_source_filter",
    lambda c: _plain(
        filters.cut(c.src["voice_resolution"], "load_datetime", c.p.incremental().start, c.p.as_of)
    ),
    f"SELECT {_plain_sql('voice_resolution')} FROM in_voice_resolution WHERE load_datetime >= DATE '2001-05-01' AND load_datetime < DATE '2001-06-15'",
)


def _kpi_rows(c: Context) -> DataFrame:
    """Orders with the columns the indicator rule reads."""
    key = F.col("o_orderkey")
    return c.table("orders").select(
        key,
        F.when(key % 3 == 0, "NOT_HUMAN").otherwise("HUMAN").alias("is_human"),
        F.when(key % 2 == 0, "voz").otherwise("wsp").alias("canal"),
        F.when(key % 5 == 0, "VENTAS").otherwise("NOT_CATEGORIZED").alias("category"),
        F.to_date("o_orderdate").alias("call_date"),
        F.when(key % 7 != 0, (key % 2).cast("int")).alias("fcr"),
        (key % 11).cast("double").alias("nota_calidad"),
    )


_LOST = "o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0 AND o_orderdate >= DATE '1999-01-02'"
_KPI_SQL = f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'NOT_HUMAN' ELSE 'HUMAN' END AS is_human,
       CASE WHEN o_orderkey % 2 = 0 THEN 'voz' ELSE 'wsp' END AS canal,
       CASE WHEN o_orderkey % 5 = 0 THEN 'VENTAS' ELSE 'NOT_CATEGORIZED' END AS category, CAST(o_orderdate AS DATE) AS call_date,
       CASE WHEN o_orderkey % 7 = 0 OR ({_LOST}) THEN NULL ELSE CAST(o_orderkey % 2 AS INTEGER) END AS fcr,
       CASE WHEN o_orderkey % 7 <> 0 AND {_LOST} THEN NULL ELSE CAST(o_orderkey % 11 AS DOUBLE) END AS nota_calidad
FROM orders"""

register("conditional_update", lambda c: null_out_kpis(_kpi_rows(c), c.p), _KPI_SQL)


def appended(c: Context) -> DataFrame:
    """Two writes with different column orders end up under the same names."""
    path = c.ws.path("append")
    orders = _orders(c)
    day = F.lit(c.p.cutover)
    write_layer(orders.where(F.col("call_date") < day), path)
    later = orders.where(F.col("call_date") >= day).select("customer", "factor", "call_date", "conversation_id")
    append_layer(conform(later, "conversation_id string, call_date date, factor double, customer bigint"), path)
    return read_layer(c.spark, path).select("conversation_id", "call_date", "factor", "customer")


register("append_union_insert", appended, _ORDERS_SQL.format("o_totalprice"))


def window_sessions(c: Context) -> DataFrame:
    """Sessions of the participants whose categories were loaded in the window: pruned in the scan, then joined."""
    p = c.p.incremental()
    raw = c.src["voice_categories"].unionByName(c.src["text_categories"])
    keys = KeySet(filters.cut(raw, "load_datetime", p.loads_from, p.as_of).select("participant_id"), c.ws)
    left = keys.prune(c.src["participant_sessions"], "participant_id")
    exact = left.join(keys.keys, F.col("participant_id") == F.col("key"), "left_semi")
    return _plain(exact)


register(
    "window_key_pruning",
    window_sessions,
    f"""SELECT {_plain_sql('participant_sessions')} FROM in_participant_sessions WHERE participant_id IN (
          SELECT participant_id FROM in_voice_categories WHERE load_datetime >= DATE '2001-05-01' AND load_datetime < DATE '2001-06-15'
          UNION ALL SELECT participant_id FROM in_text_categories WHERE load_datetime >= DATE '2001-05-01' AND load_datetime < DATE '2001-06-15')""",
)
