"""Named access to the inputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from contact_mart.sources.schemas import SOURCES, conform, struct_of


class Sources:
    """Inputs by name, checked against their schema when first used."""

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._seen: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._seen:
            frame = self._load(name)
            wanted = [f.name for f in struct_of(SOURCES[name]).fields]
            missing = [c for c in wanted if c not in frame.columns]
            if missing:
                raise ValueError(f"source {name} lacks the columns {', '.join(missing)}")
            self._seen[name] = conform(frame, SOURCES[name])
        return self._seen[name]

    @classmethod
    def from_tables(cls, spark: SparkSession, tables: Mapping[str, str]) -> Sources:
        return cls(lambda name: spark.table(tables[name]))

    @classmethod
    def from_parquet(cls, spark: SparkSession, paths: Mapping[str, str]) -> Sources:
        return cls(lambda name: spark.read.parquet(paths[name]))
