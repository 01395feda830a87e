"""Earlier variants of the third layer's side tables and weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.functions import rules
from contact_mart.operators import scaling
from contact_mart.operators.dedup import top1, up
from contact_mart.operators.joins import left_lookup


def canal_of(channel: Column, human: Column) -> Column:
    """Earlier channel rule: tickets are recognised in upper case only."""
    return F.when(F.upper(channel) == "CASES", F.when(channel == "CASES", "cases")).otherwise(
        rules.canal_of(channel, human)
    )


def first_resolution(resolution: DataFrame) -> DataFrame:
    """Resolution of the first participant, on every row of its conversation (not deduplicated).

    The first value is an aggregate joined back, not a window over the whole group.
    """
    flag = F.col("is_first_call_resolution")
    firsts = resolution.groupBy("conversation_id").agg(
        F.min_by(flag, F.struct("participant_id", flag)).alias("is_first_call_resolution")
    )
    return left_lookup(resolution.select("conversation_id"), firsts, {"conversation_id": "conversation_id"})


def compliance_per_conversation(compliance: DataFrame) -> DataFrame:
    """Weights of the last participant; any NULL weight makes the score NULL."""
    weights = list(rules.COMPLIANCE_WEIGHTS)
    one = top1(compliance, ["conversation_id"], [F.col("participant_id").desc_nulls_last(), *up(*weights)])
    score = F.col(weights[0])
    for weight in weights[1:]:
        score = score + F.col(weight)
    return one.select("conversation_id", score.alias("nota_calidad"))


def corrected_rows(rows: DataFrame) -> DataFrame:
    """Plain weights multiplied by the correction of their day and canal."""
    plain = scaling.plain_factor_plus(rows)
    return scaling.corrected_factor_plus(plain, scaling.correction_factors(plain))
