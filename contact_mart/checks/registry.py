"""Registry of queries: name -> Spark function and DuckDB text."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contact_mart.checks.steps import compose
from contact_mart.params import Params
from contact_mart.plans.conversations import build_intermedia
from contact_mart.plans.results import build_third
from contact_mart.plans.segments import best_category_per_agent, bot_rows, build_calculated, category_rows, segments_enriched
from contact_mart.session import Workspace, tune
from contact_mart.sources import driver


class Context:
    """Inputs, parameters and staged layers of one query over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir
        self.p: Params = driver.PARAMS
        self.src = driver.driver_sources(spark, sf_dir)
        self.ws = Workspace(spark)

    def table(self, name: str) -> DataFrame:
        return driver.table(self.spark, self.sf_dir, name)

    @cached_property
    def segments(self) -> DataFrame:
        return segments_enriched(self.src, self.p, self.ws)

    @cached_property
    def categories(self) -> DataFrame:
        return category_rows(self.src, self.p)

    @cached_property
    def best_categories(self) -> DataFrame:
        """As in the layer: moved to their conversation, where the segments meet them."""
        return best_category_per_agent(self.categories.repartition("conversation_id"))

    @cached_property
    def bots(self) -> DataFrame:
        return bot_rows(self.src, self.p)

    @cached_property
    def calculated(self) -> DataFrame:
        """For one reader, as is ``intermedia_once``: not written, so that the collapse finds the chats where the
        joins on their conversation leave them, and columns that the reader lacks do not move."""
        return build_calculated(self.src, self.p, None, self.ws)

    @cached_property
    def intermedia_once(self) -> DataFrame:
        return build_intermedia(self.calculated)

    @cached_property
    def intermedia(self) -> DataFrame:
        return self.ws.stage(self.intermedia_once, "intermedia")

    @cached_property
    def third(self) -> DataFrame:
        return build_third(self.intermedia, self.src, self.p, self.ws)


Query = Callable[[Context], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = compose(sql)


def _joined(column: str, one: Callable[[Column], Column]) -> Column:
    """Texts of the elements, sorted and joined. A list of one element needs no loop, which is not compiled."""
    many = F.array_join(F.array_sort(F.transform(column, one)), "|")
    return F.when(F.size(column) == 1, one(F.get(column, F.lit(0)))).otherwise(many)


def names_text(column: str) -> Column:
    """Array of texts as one sorted text."""
    return _joined(column, lambda x: F.coalesce(x, F.lit("~")))


def _structs_text(column: str, fields: tuple[str, ...], whole: tuple[str, ...] = ()) -> Column:
    def one(e: Column) -> Column:
        parts = [e[f].cast("bigint") if f in whole else e[f] for f in fields]
        return F.concat_ws("/", *[F.coalesce(v.cast("string"), F.lit("~")) for v in parts])

    return _joined(column, one)


def agents_text(column: str) -> Column:
    return _structs_text(column, ("agent_id", "first_category", "second_category", "third_category"))


def segments_text(column: str) -> Column:
    from contact_mart.checks.steps import SEGMENT_FIELDS

    return _structs_text(column, SEGMENT_FIELDS, ("aht", "bp_executive_num"))


def flat(df: DataFrame) -> DataFrame:
    """Nested layer columns as texts."""
    rendered = {
        "skill_name": names_text, "factory_name": names_text, "all_agents": agents_text, "skill_lookup": segments_text,
    }
    return df.select(*[rendered[c](c).alias(c) if c in rendered else F.col(c) for c in df.columns])


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Sums of fractions agree between engines up to the last bits only."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
