"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that let the optimizer split hot keys and share exchanges.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the split costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A side already partitioned by conversation also serves a (conversation, agent) join.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Tasks that sort wide rows get little of them, however large the table; small tables have few tasks still.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    # Tasks that scan get as little of a file: some sort or deal out all they read.
    "spark.sql.files.maxPartitionBytes": "16m",
    # A job's shuffle files go when its table is written.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


class Workspace:
    """Writes intermediate results to the cluster's shared folder and reads them back.

    A written table cuts the lineage, survives lost executors, is computed once
    however often it is read, and carries its real size, so that the planner
    broadcasts it only when it is below ``spark.sql.autoBroadcastJoinThreshold``
    and shuffles it otherwise.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._root: str | None = None

    @property
    def root(self) -> str:
        if self._root is None:
            shared = self.spark.conf.get("spark.checkpoint.dir", None)
            if not shared:
                if not self.spark.sparkContext.master.startswith("local"):
                    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
                shared = tempfile.mkdtemp(prefix="contact-mart-")
            self._root = f"{shared.rstrip('/')}/contact-mart-{uuid.uuid4().hex}"
        return self._root

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Remove the intermediate tables; call it once their readers have finished."""
        if self._root is not None:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._root)
            conf = self.spark._jsparkSession.sessionState().newHadoopConf()
            folder.getFileSystem(conf).delete(folder, True)
            self._root = None
