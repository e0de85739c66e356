"""Session helpers: where intermediate results are made durable."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is missing and the
    session is local; a cluster must name a folder every executor can reach.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="gramspan-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class RollingTable:
    """The state of a loop, as one table that each round replaces.

    A round is written in full before the one it was computed from is removed,
    so the loop holds at most two copies and never grows a lineage.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/state-{uuid.uuid4().hex}"
        self.round = 0

    def advance(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.round}"
        df.write.parquet(path)
        self.round += 1
        if self.round > 1:
            self._remove(f"{self.folder}/{self.round - 2}")
        return self.spark.read.schema(df.schema).parquet(path)

    def _remove(self, path: str) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def close(self) -> None:
        """Remove what is left; nothing may read the state afterwards."""
        self._remove(self.folder)
