"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of (source, language, topic). The tokens of the cells are raked: in turn
the cells of each source, each language and each topic are scaled so that their sum meets the
target, until all three marginals hold. The quotient of raked and present tokens is a cell's
density; a document is taken with probability ``scale * density``, at most 1, where the scale is
the one that makes the expected tokens meet the budget. Where a cell is taken whole, the scale of
the others makes up for it.

Only cells are joined and summed; their number is that of distinct combinations, not of documents,
and they are a table like any other.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contact_mart.llm.common import SPACES, SPACE_CLASS, Tables, prepare

DIMENSIONS = ("source", "lang", "topic")
TOLERANCE, ROUNDS_PER_TABLE, MOST_ROUNDS = 1e-4, 3, 60
# Exponent of the present shares that the default targets are made of: 1 keeps them, 0 makes all alike.
TEMPER = {"source": 0.7, "lang": 0.8, "topic": 0.9}


def form_topic(text: str = "text") -> Column:
    """A topic for tables without one: the form of the text, from whole-text counts."""
    size, bars = F.length(text), F.length(text) - F.length(F.replace(F.col(text), F.lit("|"), F.lit("")))
    lines = size - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1
    return (
        F.when(F.coalesce(size, F.lit(0)) == 0, "empty")
        .when(bars * 40 > size, "table")
        .when(size > 400 * lines, "paragraphs")
        .when(size < 1000, "note")
        .otherwise("lines")
    )


def word_count(text: str = "text") -> Column:
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, f"{SPACE_CLASS}+", -1))).cast("long")


def cells(docs: DataFrame, topic: Column, text: str = "text") -> DataFrame:
    """source, lang, topic, tokens (1 at least, so that documents without words have a density) and n_docs."""
    rows = docs.select("source", "lang", topic.alias("topic"), word_count(text).alias("tokens"))
    return rows.groupBy(*DIMENSIONS).agg(
        F.greatest(F.sum("tokens"), F.lit(1)).cast("double").alias("tokens"), F.count("*").alias("n_docs")
    )


def _total(rows: DataFrame, column: str) -> float:
    return rows.agg(F.sum(column)).first()[0] or 0.0


def tempered(present: DataFrame, dimension: str, exponent: float) -> DataFrame:
    """value, target: the present share to the exponent, as a share of all."""
    powers = present.groupBy(F.col(dimension).alias("value")).agg(F.pow(F.sum("tokens"), F.lit(exponent)).alias("p"))
    return powers.select("value", (F.col("p") / F.lit(_total(powers, "p"))).alias("target"))


def raked(present: DataFrame, targets: dict[str, DataFrame], tables: Tables, name: str = "raked") -> DataFrame:
    """The cells with ``share``: raked shares, summing to 1, and ``gap``: how far a sum is from its target at the end.
    A value without a target gets 0; a target without cells is left out and the others of its dimension share its part.
    Targets that contradict each other (a source and a language that are the same documents, with different shares) end
    after MOST_ROUNDS, with the last dimension met, a gap of TOLERANCE or more and a warning."""
    rows = present
    for d, target in targets.items():  # the goals of the values that have cells, summing to 1
        wanted = target.groupBy(F.col("value").alias("__v")).agg(F.sum(F.col("target").cast("double")).alias("__t"))
        held = present.select(F.col(d).alias("v")).distinct()
        goal = held.join(wanted, held["v"].eqNullSafe(wanted["__v"]), "left").select("v", F.coalesce("__t", F.lit(0.0)).alias("__t"))
        goal = tables.put(goal, f"{name}-{d}")
        total = _total(goal, "__t") or 1.0
        rows = rows.join(goal, rows[d].eqNullSafe(goal["v"])).withColumn(f"goal_{d}", F.col("__t") / F.lit(total)).drop("v", "__t")
    rows = tables.put(rows.withColumn("share", F.col("tokens") / F.lit(_total(present, "tokens") or 1.0)), f"{name}-0")
    step, gap = 0, 0.0
    while step < MOST_ROUNDS:
        for _ in range(ROUNDS_PER_TABLE):
            for d in targets:
                held = F.sum("share").over(Window.partitionBy(d))
                rows = rows.withColumn("share", F.when(held > 0, F.col("share") * F.col(f"goal_{d}") / held).otherwise(0.0))
        step += ROUNDS_PER_TABLE
        rows = tables.put(rows, f"{name}-{step}")
        gaps = None
        for d in targets:
            off = rows.groupBy(d).agg(F.abs(F.sum("share") - F.max(f"goal_{d}")).alias("gap")).select("gap")
            gaps = off if gaps is None else gaps.unionByName(off)
        gap = gaps.agg(F.max("gap")).first()[0] or 0.0
        tables.drop(f"{name}-{step - ROUNDS_PER_TABLE}")
        if gap < TOLERANCE:
            break
    if gap >= TOLERANCE:
        warnings.warn(f"raking ended after {step} rounds with a gap of {gap:.2g}: the targets contradict each other", stacklevel=2)
    return rows.drop(*[f"goal_{d}" for d in targets]).withColumn("gap", F.lit(gap))


def probabilities(shares: DataFrame, fraction: float) -> DataFrame:
    """The cells with density and probability, whose expected tokens are ``fraction`` of all, or all that have a share.

    The scale is found from below: what the scale so far takes whole is set aside, and the scale that the budget leaves
    for the others is the next one. It only grows, and is the answer once it takes no more cells whole; each step is one
    aggregate over the cells."""
    cells_ = shares.where("share > 0").withColumn("density", F.col("share") / F.col("tokens"))
    budget, scale, whole = fraction * _total(cells_, "tokens"), 0.0, -1
    while True:
        taken = F.lit(scale) * F.col("density") >= 1
        n, tokens, rest = cells_.agg(
            F.count_if(taken), F.sum(F.when(taken, F.col("tokens"))), F.sum(F.when(~taken, F.col("share")))
        ).first()
        if n == whole:
            break
        # Nothing is left to scale: every cell is whole.
        whole, scale = n, max(scale, (budget - (tokens or 0.0)) / rest) if rest else scale
    chance = F.when(F.lit(scale) * F.col("density") >= 1, 1.0).otherwise(F.lit(scale) * F.col("density"))
    return cells_.withColumn("probability", chance).select(*DIMENSIONS, "tokens", "n_docs", "share", "density", "probability")


def drawn(id_column: str, seed: int) -> Column:
    """A number in [0, 1) of the id: the same in every run and on every machine."""
    return F.pmod(F.xxhash64(F.lit(seed), id_column), F.lit(1 << 53)) / F.lit(float(1 << 53))


def mix(
    docs: DataFrame,
    fraction: float = 0.5,
    targets: dict[str, DataFrame] | None = None,
    tables: Tables | None = None,
    topic: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 1,
) -> DataFrame:
    """``docs`` with topic, probability, weight (1 / probability) and kept.

    ``targets``: for each of source, lang and topic a table (value, target) of shares; by default the present ones,
    tempered by TEMPER. ``topic`` defaults to the form of the text. Null values of source or lang are a value of their
    own; null texts have 0 tokens and the topic "empty". The draw depends on the id alone: rows with the same id in the
    same cell are taken together, null ids share one draw. An empty table gives an empty result. Columns with the names
    of the results are replaced, others are kept. The documents are read twice, for the cells and for the draw; the
    cells are a written table, which the planner sends to the tasks as long as its size allows.
    """
    spark = prepare(docs.sparkSession)
    tables = tables or Tables(spark)
    topic = form_topic(text) if topic is None else topic
    present = tables.put(cells(docs, topic, text), "cells")
    goals = targets or {d: tempered(present, d, TEMPER[d]) for d in DIMENSIONS}
    chances = tables.put(probabilities(raked(present, goals, tables), fraction), "chances")
    named = chances.select(*[F.col(d).alias(f"__{d}") for d in DIMENSIONS], F.col("probability").alias("__p"))
    own = docs.withColumn("topic", topic)
    joined = own.join(named, [own[d].eqNullSafe(named[f"__{d}"]) for d in DIMENSIONS], "left")
    chance = F.coalesce("__p", F.lit(0.0))
    return joined.withColumns(
        {"probability": chance, "weight": F.when(chance > 0, 1 / chance), "kept": drawn(doc_id, seed) < chance}
    ).drop("__p", *[f"__{d}" for d in DIMENSIONS])
