"""Demand against observed counts, and re-spreading of uncategorised weight."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.functions import dates, rules
from contact_mart.operators.joins import left_lookup
from contact_mart.operators.lookups import DEMAND_CHANNELS, lookup_frame, map_column
from contact_mart.operators.reshape import union_all, unpivot_measures
from contact_mart.params import Params

# Canal -> measure column of the wide demand table.
WIDE_MEASURES = {
    "voz": "demanda_voz_agente",
    "wsp": "wa",
    "chat": "livechat",
    "cases": "casos_validado_com_gabi",
    "rrss": "redes_sociales",
}


def historic_demand(wide: DataFrame, p: Params, measures: Mapping[str, str] = WIDE_MEASURES) -> DataFrame:
    """Monthly demand per canal from the wide table; it knows no zone and humans only.

    Months from the cutover on are those of the daily table, so they are left out here. An unknown label has no
    month. ``measures``: the wide table's column of each canal."""
    months = wide.groupBy("mes").agg(*[F.sum(m).cast("double").alias(c) for c, m in measures.items()])
    long = unpivot_measures(months, ["mes"], list(measures), "canal", "valor")
    past = F.coalesce(F.col("mes") < p.cutover_month, F.lit(True))
    return map_column(long, "mes", "mes", p.month_label_rows(), None).where(past).select(
        "mes",
        "canal",
        F.lit(None).cast("string").alias("zona"),
        F.lit("HUMAN").alias("is_human"),
        "valor",
    )


def current_demand(daily: DataFrame, p: Params) -> DataFrame:
    """Monthly demand per canal, zone and origin from the daily table."""
    channels = lookup_frame(
        daily.sparkSession,
        ["channel", "canal", "is_human"],
        [(channel, *target) for channel, target in DEMAND_CHANNELS.items()],
    )
    recent = daily.where(F.col("date") >= F.lit(p.cutover)).join(channels, "channel")
    return recent.groupBy(
        dates.month_text(F.col("date")).alias("mes"),
        "canal",
        rules.zone_of_country(F.col("country")).alias("zona"),
        "is_human",
    ).agg(F.sum("N_R").cast("double").alias("valor"))


def demand(wide: DataFrame, daily: DataFrame, p: Params) -> DataFrame:
    return union_all(historic_demand(wide, p), current_demand(daily, p))


def observed_counts(main: DataFrame) -> DataFrame:
    return main.groupBy(dates.month_text(F.col("call_date")).alias("mes"), "canal", "zona", "is_human").agg(
        F.count("conversation_id").alias("valor")
    )


def _ratio(wanted: Column, seen: Column) -> Column:
    """Demand over count; 0 when either is missing or zero."""
    return F.coalesce(F.try_divide(wanted, seen), F.lit(0.0))


def counts_with_demand(counts: DataFrame, wanted: DataFrame, p: Params) -> DataFrame:
    """Every count with its demand (``wanted``) and the count that this demand is set against (``total``).

    Before the cutover demand has no zone, so it is met without one and set against the count over all zones.
    From the cutover on every zone and origin has its own demand. An unknown month has none.
    """
    early = F.coalesce(F.col("mes") < p.cutover_month, F.lit(False))
    keys = ["mes", "canal", "is_human"]
    before, after = counts.where(early), counts.where(~early)
    totals = before.groupBy(*keys).agg(F.sum("valor").alias("total"))
    unzoned = wanted.where(F.col("zona").isNull()).select(*keys, F.col("valor").alias("wanted"))
    zoned = wanted.select(*keys, "zona", F.col("valor").alias("wanted"))
    met = left_lookup(left_lookup(before, totals, {k: k for k in keys}), unzoned, {k: k for k in keys})
    own = left_lookup(after.withColumn("total", F.col("valor")), zoned, {k: k for k in [*keys, "zona"]})
    return union_all(met, own)


def scaling_factors(counts: DataFrame, wanted: DataFrame, p: Params, parts: bool = False) -> DataFrame:
    """Weight of one observed contact per month, canal, zone and origin.

    Demand over count, as ``counts_with_demand`` brings them together; before the cutover bots keep weight 1.
    Counts of an unknown month have no weight. ``parts``: these counts too, and what the weight is made of.
    """
    keys = ["mes", "canal", "zona", "is_human"]
    met = counts_with_demand(counts, wanted, p)
    bot = (F.col("mes") < p.cutover_month) & (F.col("is_human") == "NOT_HUMAN")
    factor = F.when(bot, 1.0).otherwise(_ratio(F.col("wanted"), F.col("total")))
    if parts:
        return met.select(*keys, "valor", "wanted", "total", F.when(F.col("mes").isNotNull(), factor).alias("factor"))
    return met.where(F.col("mes").isNotNull()).select(*keys, factor.alias("factor"))


def zone_factors(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Earlier rule: every month set against demand of the same zone."""
    keys = ["mes", "canal", "zona", "is_human"]
    joined = left_lookup(counts, wanted.withColumnRenamed("valor", "wanted"), {k: k for k in keys})
    return joined.select(*keys, _ratio(F.col("wanted"), F.col("valor")).alias("factor"))


def apply_factor(main: DataFrame, factors: DataFrame) -> DataFrame:
    """Attach the weight; a factor without zone fits every zone, and no match means 1."""
    side = factors.select(*[F.col(c).alias(f"_{c}") for c in ("mes", "canal", "zona", "is_human", "factor")])
    test = (
        (F.col("canal") == F.col("_canal"))
        & (dates.month_text(F.col("call_date")) == F.col("_mes"))
        & (F.col("is_human") == F.col("_is_human"))
        & (F.col("_zona").isNull() | (F.col("zona") == F.col("_zona")))
    )
    weight = F.coalesce("_factor", F.lit(1.0))
    return main.join(side, test, "left").select(*main.columns, weight.alias("factor"))


def category_share(rows: DataFrame, p: Params, copies: Column | None = None) -> DataFrame:
    """Categorised and total weight per day, canal and market."""
    copies = F.lit(1) if copies is None else copies
    weight = F.col("factor") * copies
    counted = F.col("category") != rules.NOT_CATEGORIZED
    if p.kept_bot:
        counted = counted & ~F.col("kept_bot_category")
    kept = rows.where(rules.reweighted(F.col("is_human"), F.col("canal"), F.col("call_date"), p.cutover))
    return kept.groupBy("call_date", "canal", "market_code").agg(
        F.sum(F.when(counted, weight).otherwise(0.0)).alias("fac_cat"),
        F.coalesce(F.sum(weight), F.lit(0.0)).alias("factor_sum"),
    )


def factor_plus(rows: DataFrame, share: DataFrame, p: Params) -> DataFrame:
    """Re-spread the weight of uncategorised rows over the categorised ones of the same group."""
    keys = ["call_date", "canal", "market_code"]
    joined = left_lookup(rows, share, {k: k for k in keys})
    factor, open_category = F.col("factor"), F.col("category") == rules.NOT_CATEGORIZED
    old_ticket = (F.col("canal") == "cases") & (F.col("call_date") < F.lit(p.cutover))
    nothing = F.coalesce(factor == 0, F.lit(True))
    if p.kept_bot:
        nothing = nothing | (F.col("kept_bot_category") & (F.col("is_human") == "HUMAN"))
    spread = (
        rules.reweighted(F.col("is_human"), F.col("canal"), F.col("call_date"), p.cutover)
        & ~open_category
        & (F.col("fac_cat") > 0)
    )
    value = (
        F.when(nothing, 0.0)
        .when(spread, F.try_divide(factor, F.try_divide(F.col("fac_cat"), F.col("factor_sum"))))
        .when(open_category & old_ticket, factor)
        .when(open_category, 0.0)
        .when(F.col("is_human") == "NOT_HUMAN", 1.0)
        .otherwise(factor)
    )
    return joined.withColumn("factor_plus", value).drop("fac_cat", "factor_sum")


def binary_market(market: Column) -> Column:
    return F.when(market == "BR", "BR").otherwise("SSC")


def plain_factor_plus(rows: DataFrame) -> DataFrame:
    """Earlier rule before its correction: 1 for uncategorised and bot rows; the factor itself
    where the day, canal and market hold re-weighted human rows; 0 elsewhere."""
    group = ["call_date", "canal", "_market"]
    marked = rows.withColumn("_market", binary_market(F.col("market_code")))
    present = (
        marked.where((F.col("is_human") == "HUMAN") & F.col("canal").isin(*rules.WEIGHTED_CANALS))
        .select(*group)
        .distinct()
        .withColumn("_present", F.lit(True))
    )
    joined = left_lookup(marked, present, {k: k for k in group})
    alone = (F.col("category") == rules.NOT_CATEGORIZED) | (F.col("is_human") == "NOT_HUMAN")
    value = (
        F.when(F.coalesce(F.col("factor") == 0, F.lit(True)), 0.0)
        .when(alone, 1.0)
        .when(F.col("_present"), F.col("factor"))
        .otherwise(0.0)
    )
    return joined.withColumn("factor_plus", value).drop("_market", "_present")


def correction_factors(rows: DataFrame) -> DataFrame:
    """Weight of all human rows over the plain weight of the categorised ones, per day and canal."""
    human = rows.where(F.col("canal").isin("voz", "wsp") & (F.col("is_human") == "HUMAN"))
    categorised = F.when(F.col("category") != rules.NOT_CATEGORIZED, F.col("factor_plus"))
    return human.groupBy("call_date", "canal").agg(
        F.try_divide(F.sum("factor"), F.sum(categorised)).alias("correction")
    )


def corrected_factor_plus(rows: DataFrame, corrections: DataFrame) -> DataFrame:
    joined = left_lookup(rows, corrections, {"call_date": "call_date", "canal": "canal"})
    corrected = (
        F.col("canal").isin("voz", "wsp")
        & (F.col("is_human") == "HUMAN")
        & (F.col("category") != rules.NOT_CATEGORIZED)
        & F.col("correction").isNotNull()
    )
    value = F.when(corrected, F.col("factor_plus") * F.col("correction")).otherwise(F.col("factor_plus"))
    return joined.withColumn("factor_plus", value).drop("correction")
