"""Raking, the scale and the draw against plain loops over lists."""

from __future__ import annotations

import math
import random
import warnings
from contextlib import closing

import pytest

from contact_mart.llm import mixing
from contact_mart.llm.common import Tables
from contact_mart.llm.queries import QUERIES

CELLS = "source string, lang string, topic string, tokens double, n_docs long"


def plain_raking(cells, goals):
    shares = {k: t / sum(cells.values()) for k, t in cells.items()}
    for _ in range(500):
        for n, goal in enumerate(goals):
            held = {}
            for k, s in shares.items():
                held[k[n]] = held.get(k[n], 0) + s
            whole = sum(goal.get(v, 0) for v in held)
            shares = {k: s * goal.get(k[n], 0) / whole / held[k[n]] if held[k[n]] else 0 for k, s in shares.items()}
    return shares


def plain_chances(cells, shares, fraction):
    """The scale by halving."""
    held = {k: s / cells[k] for k, s in shares.items() if s > 0}
    budget = fraction * sum(cells[k] for k in held)
    low, high = 0.0, max(1 / d for d in held.values())
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(1, mid * d) * cells[k] for k, d in held.items()) < budget else (low, mid)
    return {k: min(1, high * d) for k, d in held.items()}


@pytest.fixture(scope="module")
def drawn_cells():
    rng = random.Random(3)
    keys = [(s, v, t) for s in ("hot", "b", "c", None) for v in ("en", "de", None) for t in ("x", "y", "z")]
    return {k: float(rng.randrange(1, 400) * (200 if k[0] == "hot" else 1)) for k in keys}


@pytest.mark.parametrize("fraction", [0.05, 0.95])
def test_shares_and_probabilities(spark, drawn_cells, fraction):
    goals = [{"hot": 0.1, "b": 0.4, "c": 0.3, None: 0.1, "absent": 0.1}, {"en": 0.5, "de": 0.3, None: 0.2}, {"x": 0.8, "y": 0.2}]
    present = spark.createDataFrame([(*k, t, 1) for k, t in drawn_cells.items()], CELLS)
    targets = {d: spark.createDataFrame(list(g.items()), "value string, target double") for d, g in zip(mixing.DIMENSIONS, goals)}
    with closing(Tables(spark)) as tables:
        cells = mixing.raked(tables.put(present, "cells"), targets, tables)
        found = {tuple(r[d] for d in mixing.DIMENSIONS): r for r in cells.collect()}
        wanted = plain_raking(drawn_cells, goals)
        assert found.keys() == wanted.keys()
        for k, r in found.items():
            assert r["share"] == pytest.approx(wanted[k], abs=2e-4) and r["gap"] < mixing.TOLERANCE
        chances = mixing.probabilities(cells, fraction).collect()
    shares = {k: r["share"] for k, r in found.items()}
    plain = plain_chances(drawn_cells, shares, fraction)
    assert {tuple(r[d] for d in mixing.DIMENSIONS) for r in chances} == plain.keys()
    for r in chances:
        assert r["probability"] == pytest.approx(plain[tuple(r[d] for d in mixing.DIMENSIONS)], rel=1e-6)


def test_contradicting_targets_report_their_gap(spark):
    present = spark.createDataFrame([("a", "en", "x", 10.0, 1), ("b", "de", "x", 30.0, 1)], CELLS)
    targets = {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.2, "de": 0.8}}
    tables = {d: spark.createDataFrame(list(t.items()), "value string, target double") for d, t in targets.items()}
    with closing(Tables(spark)) as space, pytest.warns(UserWarning, match="contradict"):
        rows = mixing.raked(space.put(present, "cells"), tables, space).collect()
    assert {r["source"]: r["share"] for r in rows} == pytest.approx({"a": 0.2, "b": 0.8})
    assert all(r["gap"] == pytest.approx(0.7) for r in rows)


def test_no_cells(spark):
    present = spark.createDataFrame([], CELLS)
    with closing(Tables(spark)) as tables, warnings.catch_warnings():
        warnings.simplefilter("error")
        goals = {d: mixing.tempered(present, d, 1.0) for d in mixing.DIMENSIONS}
        rows = mixing.raked(present, goals, tables)
        assert rows.collect() == [] and mixing.probabilities(rows, 0.5).collect() == []


def test_draw(spark, corpus, rows):
    result = QUERIES["op7_mixing"](spark, corpus)
    got = rows(result, "doc_id", "probability", "weight", "kept")
    draws = dict(rows(spark.read.parquet(f"{corpus}/documents.parquet").select("doc_id", mixing.drawn("doc_id", 1).alias("x"))))
    assert all(kept == (draws[doc] < p) and (math.isclose(w * p, 1) if p else w is None) for doc, p, w, kept in got)
