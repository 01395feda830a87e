"""The pipeline on hard documents with clashing columns: each stage against the plain versions, input columns untouched."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from contact_mart.llm.common import Tables
from contact_mart.llm.queries import QUERIES

from . import brute

CLASHES = ("score", "predicted", "held_out", "n_lines", "n_dropped", "kept", "weight", "n_hit", "items", "component_id")


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    """The hard documents, each with its id under the names that the operators give to their results; some rows twice, one
    without an id."""
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{corpus}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(docs.where("doc_id % 17 = 3")).unionByName(docs.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    docs = docs.withColumns({c: F.coalesce("doc_id", F.lit(-5)) for c in CLASHES})
    docs.repartition(4).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Rows before the first stage and after each."""
    tables = Tables(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = tables.put(stage(spark, docs, folder), name.replace(" ", "-"))
        seen.append(docs)
    return seen


def pairs(df):
    return sorted(((r[0], r[1]) for r in df.select("doc_id", "text").collect()), key=repr)


def test_columns_keep_their_values(stages):
    before = stages[0].columns
    for after in stages[1:]:
        assert after.columns[: len(before)] == before
        wrong = [F.col(c) != F.coalesce("doc_id", F.lit(-5)) for c in CLASHES]
        assert after.where(F.greatest(*[w.cast("int") for w in wrong]) > 0).count() == 0
    assert stages[-1].columns[len(before) :] == ["topic", "probability", "weight_mix"]


def test_quality_stage(spark, folder, stages):
    predicted = {r[0]: r[1] for r in QUERIES["op10_quality_classifier"](spark, folder).select("doc_id", "predicted").collect()}
    wanted = [p for p in pairs(stages[0]) if predicted[p[0]] == 1]
    assert 0 < len(wanted) < stages[0].count()
    assert pairs(stages[1]) == wanted


def test_line_stage(stages):
    rows = pairs(stages[1])
    numbered = sorted({p for p in rows if p[0] is not None}, key=repr)
    kept = {r[0]: r[3] for r in brute.line_dedup(numbered)}
    for doc, text in pairs(stages[2]):
        if doc is not None:
            assert brute.sha(text) == kept[doc]
    assert len(rows) == stages[2].count()
    lengths = [(r[0], len(r[1])) for r in stages[2].select("n_chars", "text").collect()]
    assert all(n == size for n, size in lengths)


def test_near_copy_stage(stages):
    rows = pairs(stages[2])
    kept = {r[0] for r in brute.near_components(sorted({p for p in rows if p[0] is not None}, key=repr)) if r[3]}
    assert pairs(stages[3]) == [p for p in rows if p[0] is None or p[0] in kept]


def test_benchmark_stage(spark, folder, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    rows = pairs(stages[3])
    hit = {doc for doc, text in set(rows) for r in brute.contaminated([(doc, text)], items) if r[5]}
    assert hit and pairs(stages[4]) == [p for p in rows if p[0] not in hit]


def test_mixing_stage(stages):
    drawn = stages[5].select("doc_id", "text", "probability", "weight_mix").collect()
    before = pairs(stages[4])
    assert 0 < len(drawn) <= len(before) and {(r[0], r[1]) for r in drawn} <= set(before)
    assert all(0 < r[2] <= 1 and r[3] == pytest.approx(1 / r[2]) for r in drawn)
