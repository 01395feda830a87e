"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contact_mart.llm import (
    conversation_repair,
    decontamination,
    language,
    line_dedup,
    mixing,
    near_dedup,
    passages,
    pii,
    prefix_trie,
    quality_model,
    quality_rules,
    token_counts,
    warc,
)
from contact_mart.llm.common import prepare, table
from contact_mart.llm.oracles import ORACLES as ORACLES

POLICY = 2


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", _sha256(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_passages(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, vocabulary).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "lang", "topic", "probability", "weight", "kept"
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.lit(quality_rules.mask(quality_rules.BASE)).cast("long")
    return quality_rules.apply_policy(rows, POLICY).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(base) != 0).alias("base_failed"), "kept", "fail_bits",
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy does alone, from the ledger of op8."""
    prepare(spark)
    rows = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return quality_rules.ablations(rows, POLICY)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", _sha256(F.col("text")).alias("kept_sha256"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_model.classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score", "languages")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")), present="present")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_decontamination": op2_decontamination,
    "op3_near_dedup": op3_near_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_warc": op6_warc,
    "op7_mixing": op7_mixing,
    "op8_quality_rules": op8_quality_rules,
    "quality_ablations": quality_ablations,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_language": op11_language,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_prefix_trie": op13_prefix_trie,
}
