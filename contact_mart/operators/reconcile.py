"""Side-by-side check of a candidate table against production."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(
    original: DataFrame,
    test: DataFrame,
    sums: list[str],
    flag: str | None = None,
    tolerance: float = 0.01,
    digits: int = 4,
) -> DataFrame:
    """One row per metric: row count (exact), rounded sums (within the tolerance), flag count.

    Each table is aggregated once; only the two one-row results meet.
    """

    def totals(df: DataFrame, side: str, with_flag: bool) -> DataFrame:
        columns = [F.count(F.lit(1)).alias(f"{side}_rows")]
        columns += [F.sum(c).cast("double").alias(f"{side}_{c}") for c in sums]
        if with_flag:
            columns.append(F.count_if(F.col(flag)).alias(f"{side}_flags"))
        return df.agg(*columns)

    both = totals(original, "a", False).join(totals(test, "b", flag is not None))

    def line(metric: str, left: Column, right: Column, good: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            left.cast("string").alias("original"),
            right.cast("string").alias("test"),
            F.when(good, "OK").otherwise("DIFF").alias("status"),
        )

    lines = [line("row_count", F.col("a_rows"), F.col("b_rows"), F.col("a_rows") == F.col("b_rows"))]
    for c in sums:
        a, b = F.col(f"a_{c}"), F.col(f"b_{c}")
        lines.append(line(f"sum_{c}", F.round(a, digits), F.round(b, digits), F.abs(a - b) < tolerance))
    if flag is not None:
        lines.append(line(f"{flag}_count", F.lit("N/A"), F.col("b_flags"), F.lit(True)))
    return both.select(F.explode(F.array(*lines)).alias("line")).select("line.*")
