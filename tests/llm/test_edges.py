"""Empty tables, rows without ids, repeated rows; the reversible line index; raking."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from contact_mart.llm import line_dedup, mixing
from contact_mart.llm.common import Tables
from contact_mart.llm.queries import QUERIES

from . import brute
from .conftest import SF

INPUTS = ("documents", "benchmark", "labels", "pages", "conversations")
# Queries with rows of their own: passages, conversations, nodes. Their tests are in files of their own.
# And the ablations, a row for each rule.
OTHER_ROWS = ("op4_substring_dedup", "op12_conversation_repair", "op13_prefix_trie", "quality_ablations")


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    """The tables without rows."""
    folder = str(tmp_path_factory.mktemp("nothing"))
    for name in INPUTS:
        spark.read.parquet(f"{SF}/{name}.parquet").where("false").write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Some documents and pages twice, some without an id, some without a text."""
    folder = str(tmp_path_factory.mktemp("odd"))
    for name in INPUTS:
        table = spark.read.parquet(f"{SF}/{name}.parquet")
        if name in ("documents", "pages"):
            key, text = ("doc_id", "text") if name == "documents" else ("page_id", "html")
            few = table.where(f"{key} < 40")
            table = (
                few.unionByName(few.where(f"{key} % 3 = 0"))
                .unionByName(few.where(f"{key} % 5 = 0").withColumn(key, F.lit(None).cast("long")))
                .unionByName(few.where(f"{key} % 7 = 0").selectExpr(*[
                    f"cast(null as string) {c}" if c == text else f"{key} + 5000 {c}" if c == key else c for c in few.columns
                ]))
            )
        table.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "quality_ablations"])
def test_empty_tables_give_empty_results(spark, nothing, name):
    assert QUERIES[name](spark, nothing).collect() == []


def test_ablations_have_a_row_a_rule_whatever_the_table(spark, nothing, odd):
    """They are sums over the ledger: of an empty table zeros."""
    empty, some = (QUERIES["quality_ablations"](spark, folder).collect() for folder in (nothing, odd))
    assert sorted(r["rule"] for r in empty) == sorted(r["rule"] for r in some) and len({r["rule"] for r in some}) == len(some)
    assert all(value == 0 for r in empty for name, value in r.asDict().items() if name != "rule")


def test_pipeline_of_empty_tables_is_empty(spark, nothing):
    assert corpus_pipeline.run(spark, nothing).collect() == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in OTHER_ROWS])
def test_rows_without_id_and_repeated_rows_stay(spark, odd, name):
    result = QUERIES[name](spark, odd)
    source, key = ("pages", "page_id") if "page_id" in result.columns else ("documents", "doc_id")
    ids = lambda df: sorted((r[0] for r in df.select(key).collect()), key=repr)
    assert ids(result) == ids(spark.read.parquet(f"{odd}/{source}.parquet"))


def test_passages_of_repeated_rows(spark, odd):
    assert all(r["of_doc"] < r["doc_id"] for r in QUERIES["op4_substring_dedup"](spark, odd).collect())


def _gone(index, rows):
    return sorted((r["doc"], sorted(r["places"])) for r in index.dropped().collect())


def test_line_index_is_reversible(spark, monkeypatch):
    """Inserting and deleting gives what building from the remaining documents gives; owners pass on."""
    lines = [f"line number {k} of the lot" for k in range(60)]
    rows = [(d, "\n".join(lines[(d * 7 + k) % 60] for k in range(9))) for d in range(40)]
    frame = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    tables = Tables(spark)
    index = line_dedup.LineIndex.build(frame(rows[:25]), tables, keys_per_shard=8)
    start = _gone(index, rows)
    more = index.insert(frame(rows[25:]))
    whole = line_dedup.LineIndex.build(frame(rows), Tables(spark), keys_per_shard=8)
    assert _gone(more, rows) == _gone(whole, rows) != start
    counted = lambda index: sorted(tuple(r) for r in index.counts.select("hi", "lo", "n_docs", "owner").collect())
    assert counted(more) == counted(whole)
    with pytest.raises(ValueError):
        more.insert(frame(rows[3:4]))
    back = more.delete(frame(rows[25:]).select("doc_id"))
    assert _gone(back, rows) == start
    assert counted(back) == counted(index)
    without_owners = back.delete(frame(rows[:6]).select("doc_id"))
    rest = line_dedup.LineIndex.build(frame(rows[6:25]), Tables(spark), keys_per_shard=8)
    assert _gone(without_owners, rows) == _gone(rest, rows)
    assert counted(without_owners) == counted(rest)
    monkeypatch.setattr(line_dedup, "COMPACT", 2)
    small = without_owners
    for doc in range(6, 20):
        small = small.delete(frame(rows[doc : doc + 1]).select("doc_id"))
    assert counted(small) == counted(line_dedup.LineIndex.build(frame(rows[20:25]), Tables(spark), keys_per_shard=8))
    assert len(small.refs) <= 2


def test_a_change_counts_its_own_lines_alone(spark):
    """The lines of one document in a hundred are as many as the rows of the deltas at most."""
    rows = [(d, "\n".join(f"line {k} of document {d if k % 3 else 'all'}" for k in range(10))) for d in range(200)]
    frame = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    tables = Tables(spark)
    index = line_dedup.LineIndex.build(frame(rows[:198]), tables)
    more = index.insert(frame(rows[198:]))
    assert spark.read.parquet(tables._paths["refs-1"]).count() == 20
    assert spark.read.parquet(tables._paths["deltas-1"]).count() <= 20
    more.delete(frame(rows[:2]).select("doc_id"))
    assert spark.read.parquet(tables._paths["deltas-2"]).count() <= 20


def test_a_line_with_a_long_run_of_blanks_takes_linear_time(spark):
    lines = spark.range(1).select(F.concat(F.lit("a" * 10), F.repeat(F.lit(" \t"), 5_000_000), F.lit("B \x0b")).alias("line"))
    began = time.perf_counter()
    assert lines.select(F.length(line_dedup.line_key(F.col("line")))).first()[0] == 10_000_011
    assert time.perf_counter() - began < 20


def test_line_index_by_shard_equals_sent_filters(spark, monkeypatch):
    rows = [(d, "\n".join(f"a line that is long {(d * k) % 50}" for k in range(12))) for d in range(30)]
    index = line_dedup.LineIndex.build(spark.createDataFrame(rows, "doc_id long, text string"), Tables(spark), keys_per_shard=8)
    sent = _gone(index, rows)
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", 0)
    assert sent and _gone(index, rows) == sent


def test_cuckoo_filter_never_forgets_a_key():
    keys = np.arange(1, 4001, dtype=np.int64) * 7919
    cuckoo = line_dedup.CuckooFilter(3000)
    cuckoo.add(keys)
    assert cuckoo.contains(keys).all()
    cuckoo.remove(keys[::2])
    assert cuckoo.contains(keys[1::2]).all()
    again = line_dedup.CuckooFilter.load(*cuckoo.dump())
    assert again.contains(keys[1::2]).all()
    assert again.contains(keys[::2]).mean() < 0.05


def test_raking_meets_the_marginals(spark):
    """Against a plain raking of the same cells, and against the targets."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = Tables(spark)
    present = tables.put(mixing.cells(docs, mixing.form_topic()), "cells")
    goals = {d: mixing.tempered(present, d, mixing.TEMPER[d]) for d in mixing.DIMENSIONS}
    got = mixing.raked(present, goals, tables).collect()
    wanted = {d: {r["value"]: r["target"] for r in goals[d].collect()} for d in mixing.DIMENSIONS}
    for d in mixing.DIMENSIONS:
        for value, target in wanted[d].items():
            assert sum(r["share"] for r in got if r[d] == value) == pytest.approx(target, abs=2e-4)
    total = sum(r["tokens"] for r in got)
    shares = {tuple(r[d] for d in mixing.DIMENSIONS): r["tokens"] / total for r in got}
    for _ in range(200):
        for n, d in enumerate(mixing.DIMENSIONS):
            held = {v: sum(s for k, s in shares.items() if k[n] == v) for v in wanted[d]}
            shares = {k: s * wanted[d][k[n]] / held[k[n]] for k, s in shares.items()}
    for r in got:
        assert r["share"] == pytest.approx(shares[tuple(r[d] for d in mixing.DIMENSIONS)], abs=5e-4)


def test_mixture_meets_its_budget(spark, corpus):
    rows = QUERIES["op7_mixing"](spark, corpus).select("doc_id", "probability", "weight", "kept").collect()
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    tokens = {r[0]: r[1] for r in docs.select("doc_id", mixing.word_count()).collect()}
    expected = sum(r["probability"] * tokens[r["doc_id"]] for r in rows)
    assert expected == pytest.approx(0.5 * sum(tokens.values()), rel=0.02)
    assert all(r["weight"] == pytest.approx(1 / r["probability"]) for r in rows if r["probability"] > 0)
