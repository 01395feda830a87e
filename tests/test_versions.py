"""Layer tables in versions: crashes, readers under way, two writers, going back, pruning."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from contact_mart.sources import versions
from contact_mart.sources.versions import VersionConflict, VersionedTable

LAYER = "conversation_id string, call_date date, v int"
DAY1, DAY2, DAY3 = date(2026, 1, 1), date(2026, 1, 2), date(2026, 2, 1)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), LAYER)


@pytest.fixture
def table(spark, tmp_path):
    found = VersionedTable(spark, str(tmp_path / "t"))
    found.rewrite(frame(spark, ("a", DAY1, 1), ("b", DAY2, 1), ("c", DAY3, 1), ("n", None, 1)))
    return found


FIRST = [("a", 1), ("b", 1), ("c", 1), ("n", 1)]


def content(rows, df):
    return rows(df, "conversation_id", "v")


def test_a_run_killed_before_the_switch_leaves_the_old_table(spark, rows, table, monkeypatch):
    def killed(self, content, number):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_publish", killed)
        with pytest.raises(KeyboardInterrupt):
            table.replace_from(frame(spark, ("x", DAY2, 2)), DAY2)
    assert table.versions() == [1] and content(rows, table.read()) == FIRST
    assert table.replace_from(frame(spark, ("y", DAY2, 3)), DAY2) == 2
    assert content(rows, table.read()) == [("a", 1), ("n", 1), ("y", 3)]


def test_a_run_that_fails_while_writing_leaves_the_old_table(spark, rows, table):
    failing = frame(spark, ("x", DAY2, 2)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.replace_from(failing, DAY2)
    assert content(rows, table.read()) == FIRST


def test_a_reader_opened_before_the_switch_finishes(spark, rows, table):
    opened = table.read()
    table.replace_from(frame(spark, ("x", DAY2, 2)), DAY1)
    table.rewrite(frame(spark, ("z", DAY1, 9)))
    assert content(rows, opened) == FIRST
    assert content(rows, table.read()) == [("z", 9)]


def test_the_second_of_two_writers_is_refused(spark, rows, table, monkeypatch):
    known = VersionedTable.versions
    other = VersionedTable(spark, table.path)
    other.append(frame(spark, ("p", DAY1, 5)))
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "versions", lambda self: known(self)[:1])
        with pytest.raises(VersionConflict):
            table.append(frame(spark, ("q", DAY1, 6)))
    assert content(rows, table.read()) == sorted([*FIRST, ("p", 5)])
    assert not [n for n in table._names(versions.MANIFESTS) if not n.endswith(".json") and not n.endswith(".crc")]


def test_earlier_versions_can_be_read_and_restored(spark, rows, table):
    table.replace_from(frame(spark, ("x", DAY2, 2)), DAY2)
    table.replace_from(frame(spark), DAY1)
    assert [content(rows, table.read(v)) for v in (1, 2, 3)] == [FIRST, [("a", 1), ("n", 1), ("x", 2)], [("n", 1)]]
    assert table.restore(2) == 4
    assert content(rows, table.read()) == [("a", 1), ("n", 1), ("x", 2)]


def test_vacuum_keeps_what_the_last_versions_use(spark, rows, table, tmp_path):
    table.replace_from(frame(spark, ("x", DAY2, 2)), DAY2)
    table.replace_from(frame(spark, ("y", DAY3, 3)), DAY2)
    unpublished = tmp_path / "t" / "version=0000000004-run"
    unpublished.mkdir()
    assert [name.split("-")[0] for name in table.vacuum(keep=1)] == ["0000000002"]
    assert table.versions() == [3] and unpublished.exists()
    assert content(rows, table.read()) == [("a", 1), ("n", 1), ("y", 3)]


def test_a_manifest_grows_with_folders_in_use_not_with_runs(spark, table):
    for k in range(4):
        table.replace_from(frame(spark, ("x", DAY3, k)), DAY2)
    assert len(table._manifest()["pieces"]) == 2


def test_days_are_pruned_in_the_scan(spark, table):
    table.replace_from(frame(spark, ("x", DAY3, 2)), DAY3)
    plan = table.read().where(F.col("call_date") >= F.lit(DAY3))._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "call_date" in filters.split("PartitionFilters")[1].split("]")[0]


def test_a_table_without_versions_is_not_readable(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, str(tmp_path / "none")).read()
