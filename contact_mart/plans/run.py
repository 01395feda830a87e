"""Full rebuilds and incremental runs of the three layer tables."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contact_mart.params import Params
from contact_mart.plans.conversations import build_intermedia, whole_conversation_start
from contact_mart.plans.first_seen import FirstSeen
from contact_mart.plans.results import build_third
from contact_mart.plans.segments import build_calculated
from contact_mart.session import Workspace, tune
from contact_mart.sources.catalog import Sources
from contact_mart.sources.tables import drop_old_versions, read_layer, replace_where, write_layer


@dataclass(frozen=True)
class LayerPaths:
    calculated: str
    intermedia: str
    third: str

    @classmethod
    def under(cls, folder: str) -> LayerPaths:
        return cls(*[f"{folder.rstrip('/')}/{name}" for name in ("calculated", "intermedia", "third")])


def _tidy(spark: SparkSession, paths: LayerPaths, keep_versions: int) -> None:
    """The last versions of each layer stay, for readers that are under way and for going back."""
    for path in vars(paths).values():
        drop_old_versions(spark, path, keep_versions)


def full_run(
    spark: SparkSession, src: Sources, p: Params, paths: LayerPaths, overrides: DataFrame | None = None, keep_versions: int = 2,
    first_seen: FirstSeen | None = None,
) -> None:
    """Rebuild all layers; each reads the written table of the one before. ``first_seen`` is refreshed from the last."""
    tune(spark)
    p = replace(p, start=None)
    workspace = Workspace(spark)
    try:
        write_layer(build_calculated(src, p, overrides, workspace), paths.calculated)
        write_layer(build_intermedia(read_layer(spark, paths.calculated)), paths.intermedia)
        write_layer(build_third(read_layer(spark, paths.intermedia), src, p, workspace), paths.third)
    finally:
        workspace.close()
    if first_seen is not None:
        first_seen.refresh(read_layer(spark, paths.third))
    _tidy(spark, paths, keep_versions)


def incremental_run(
    spark: SparkSession, src: Sources, p: Params, paths: LayerPaths, overrides: DataFrame | None = None, keep_versions: int = 2,
    first_seen: FirstSeen | None = None,
) -> date:
    """Recompute the previous and the current month. Returns the start of the rebuilt window.

    With ``whole_conversations`` the upper layers start early enough that no chat
    conversation is cut in two.
    """
    tune(spark)
    p = p.incremental() if p.start is None else p
    if p.start.day != 1:
        raise ValueError(f"the window starts on {p.start}: weights are of whole months, so it must start with a month")
    workspace = Workspace(spark)
    try:
        replace_where(build_calculated(src, p, overrides, workspace), paths.calculated, p.start)
        calculated = read_layer(spark, paths.calculated)
        if p.whole_conversations:
            p = replace(p, start=whole_conversation_start(calculated, p.start))
        replace_where(build_intermedia(calculated, p), paths.intermedia, p.start)
        intermedia = read_layer(spark, paths.intermedia).where(F.col("call_date") >= F.lit(p.start))
        replace_where(build_third(intermedia, src, p, workspace), paths.third, p.start)
    finally:
        workspace.close()
    if first_seen is not None:
        first_seen.refresh(read_layer(spark, paths.third), p.start)
    _tidy(spark, paths, keep_versions)
    return p.start
