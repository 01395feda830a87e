"""Layer tables in versions: a write puts its rows into a folder of its own and is switched on by one file.

Under the table's path lie ``version=<number>-<token>/<day>=.../`` with rows and ``_versions/<number>.json``, a
manifest per version: the folders that make up the table, each with the range of days taken from it. A
manifest appears by one rename that fails if its number is taken. So

* a run that dies before the rename leaves the table as it was,
* a reader that has opened a version finishes on it, as its folders stay,
* of two writers that started from the same version, the second one is refused,
* an earlier version can be read, or made the current one again.

``vacuum`` removes what only old versions use. Every operation lists names and reads one small file on the
driver; the ranges make a manifest as long as the number of folders in use, not the number of days.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

MANIFESTS = "_versions"
FOLDER = "version"


class VersionConflict(RuntimeError):
    """Another run has published a version since this one started."""


@dataclass(frozen=True)
class Piece:
    """Rows of one folder with ``since <= day < until``; without a lower bound, rows without a day as well."""

    folder: str
    since: str | None = None
    until: str | None = None

    def before(self, start: str) -> Piece | None:
        if self.since is not None and self.since >= start:
            return None
        return Piece(self.folder, self.since, start if self.until is None else min(self.until, start))

    def condition(self, day: str) -> Column:
        test = F.col(FOLDER) == self.folder
        if self.since is not None:
            test &= F.col(day) >= F.lit(date.fromisoformat(self.since))
        if self.until is not None:
            inside = F.col(day) < F.lit(date.fromisoformat(self.until))
            test &= inside if self.since is not None else inside | F.col(day).isNull()
        return test


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, day: str = "call_date", cluster: str = "conversation_id"):
        self.spark, self.path, self.day, self.cluster = spark, path.rstrip("/"), day, cluster

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        names = [name.removesuffix(".json") for name in self._names(MANIFESTS) if name.endswith(".json")]
        return sorted(int(name) for name in names if name.isdigit())

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, the current one by default. Day ranges reach the scan as partition filters."""
        manifest = self._manifest(version)
        schema = StructType.fromJson(manifest["schema"])
        pieces = [Piece(**p) for p in manifest["pieces"]]
        if not pieces:
            return self.spark.createDataFrame([], schema)
        found = (
            self.spark.read.schema(StructType(schema.fields).add(FOLDER, StringType()))
            .option("basePath", self.path)
            .parquet(*sorted({f"{self.path}/{FOLDER}={p.folder}" for p in pieces}))
        )
        return found.where(reduce(or_, [p.condition(self.day) for p in pieces])).select(*schema.names)

    def rewrite(self, df: DataFrame) -> int:
        """The given rows are the whole table."""
        return self._write(df, lambda pieces, folder: [Piece(folder)])

    def append(self, df: DataFrame) -> int:
        return self._write(df, lambda pieces, folder: [*pieces, Piece(folder)])

    def replace_from(self, df: DataFrame, start: date) -> int:
        """The given rows take the place of all rows with ``day >= start``; older folders are not read or rewritten.

        A row before ``start`` fails the run, as it would not belong to the window."""
        inside = F.coalesce(F.col(self.day) >= F.lit(start), F.lit(False))
        refuse = F.raise_error(F.lit(f"a row lies before the window that starts on {start}")).cast("boolean")
        checked = df.where(F.when(inside, F.lit(True)).otherwise(refuse))

        def merged(pieces: list[Piece], folder: str) -> list[Piece]:
            older = [p.before(str(start)) for p in pieces]
            return [*(p for p in older if p is not None), Piece(folder, since=str(start))]

        return self._write(checked, merged)

    def restore(self, version: int) -> int:
        """Make the content of an earlier version the current one, as a new version."""
        return self._publish(self._manifest(version), self.versions()[-1] + 1)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the last ``keep`` versions and the folders that none of these uses. Returns the folders.

        Folders of runs that have not published yet carry a number above the current one and stay."""
        versions = self.versions()
        if not versions or keep < 1:
            return []
        kept = versions[-keep:]
        used = {p["folder"] for v in kept for p in self._manifest(v)["pieces"]}
        gone = []
        for v in versions[:-keep]:
            self._delete(f"{MANIFESTS}/{v:010d}.json")
        for name in self._names(""):
            folder = name.removeprefix(f"{FOLDER}=")
            if folder != name and folder not in used and int(folder.split("-")[0]) <= versions[-1]:
                self._delete(name)
                gone.append(folder)
        return gone

    def _arranged(self, df: DataFrame) -> DataFrame:
        """Rows grouped by day and sorted by the cluster column inside each file.

        The rebalance lets the engine cut a large day into several files of the advisory
        size and merge small ones, so one hot day does not become one task.
        """
        return df.hint("rebalance", self.day).sortWithinPartitions(self.day, self.cluster)

    def _write(self, df: DataFrame, merge) -> int:
        versions = self.versions()
        number = versions[-1] + 1 if versions else 1
        pieces = [Piece(**p) for p in self._manifest(versions[-1])["pieces"]] if versions else []
        folder = f"{number:010d}-{uuid.uuid4().hex[:12]}"
        self._arranged(df).write.mode("errorifexists").partitionBy(self.day).parquet(f"{self.path}/{FOLDER}={folder}")
        schema = StructType([*(f for f in df.schema if f.name != self.day), df.schema[self.day]])
        content = {"schema": schema.jsonValue(), "pieces": [asdict(p) for p in merge(pieces, folder)]}
        return self._publish(content, number)

    # Names and small files, by way of the file system of the path.

    def _fs(self, name: str = ""):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return target, target.getFileSystem(conf), conf

    def _names(self, folder: str) -> list[str]:
        target, fs, _ = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def _delete(self, name: str) -> None:
        target, fs, _ = self._fs(name)
        fs.delete(target, True)

    def _manifest(self, version: int | None = None) -> dict:
        if version is None:
            versions = self.versions()
            if not versions:
                raise FileNotFoundError(f"{self.path} has no version")
            version = versions[-1]
        target, fs, _ = self._fs(f"{MANIFESTS}/{version:010d}.json")
        stream = fs.open(target)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, content: dict, number: int) -> int:
        """The switch: the manifest is written beside its place and renamed, which fails if the number is taken."""
        draft, fs, conf = self._fs(f"{MANIFESTS}/.{uuid.uuid4().hex}")
        target, _, _ = self._fs(f"{MANIFESTS}/{number:010d}.json")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(draft, target, options)
        except Exception as error:
            fs.delete(draft, False)
            if fs.exists(target):
                raise VersionConflict(f"version {number} of {self.path} has been published by another run") from error
            raise
        return number
