"""Random and repeatable samples of n rows (a top-n by a random or hashed key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_n(df: DataFrame, n: int = 300, seed: int | None = None, key: list[Column] | None = None) -> DataFrame:
    """n rows in random order; with ``key`` the order is fixed by it, so the sample repeats."""
    order = key if key is not None else [F.rand(seed)]
    return df.orderBy(*order).limit(n)


def hashed_order(*columns: str, seed: int = 0) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]), *[F.col(c) for c in columns]]
