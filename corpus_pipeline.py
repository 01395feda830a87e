"""A training corpus from raw documents: five stages, each an operator of contact_mart.llm.

A stage takes the documents that the one before it kept and returns those that stay, with the
columns of the input, whatever their names. The last one adds topic, probability and weight. Repeated
rows are treated alike, empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contact_mart.llm.common import Tables, table
from contact_mart.llm.decontamination import decontaminate
from contact_mart.llm.line_dedup import dedup_lines
from contact_mart.llm.mixing import mix
from contact_mart.llm.near_dedup import near_duplicates
from contact_mart.llm.quality_model import classify

# Share of the tokens that the mixture is made of.
FRACTION = 0.8
ROW = "__document"


def _aside(docs: DataFrame, *read: str) -> DataFrame:
    """doc_id, text, the other columns that the operator reads, and all but doc_id and text as one column: an operator's
    results cannot take the place of a column of the documents then, whatever their names."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = [F.struct(*rest).alias(ROW)] if rest else []
    return docs.select("doc_id", "text", *read, *row)


def _back(columns: list[str]) -> list[Column]:
    return [F.col(c) if c in ("doc_id", "text") else F.col(ROW)[c].alias(c) for c in columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null and empty texts have a score like any other."""
    scored = classify(_aside(docs), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*_back(docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go; n_chars is that of the text that is left. A null text becomes empty."""
    left = dedup_lines(_aside(docs)).select(*_back(docs.columns))
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near copies stays. Rows without an id stay."""
    gone = near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go, each row by its own text; rows without an id too."""
    hit = decontaminate(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark")).where("n_hit > 0")
    hit = hit.select(F.col("doc_id").alias("__id"), "__hash").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(hit, same, "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with the probabilities of the raked weights; topic, probability and weight come after the columns
    of the documents, with the ending _mix where the documents have a column of the name."""
    drawn = mix(_aside(docs, "source", "lang"), FRACTION).where("kept")
    own = [F.col(c).alias(f"{c}_mix" if c in docs.columns else c) for c in ("topic", "probability", "weight")]
    return drawn.select(*_back(docs.columns), *own)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near dedup", near_copies),
    ("benchmark decontamination", benchmark),
    ("mixing", mixture),
]
# The classifier and the min-hashes cannot be said in SQL; tests/llm/brute.py has plain versions of the operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    tables = Tables(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = tables.put(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
