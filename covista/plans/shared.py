"""The folder that every executor can reach, for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, which also becomes the checkpoint folder.

    A folder of our own is used only on a local master with the setting unset.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="covista-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Workspace:
    """Intermediate tables of one computation, in the shared folder.

    ``store`` writes a frame and reads it back, ``drop`` deletes it as soon as everything made
    from it is itself stored, so that a long computation holds a few steps on disk, not all.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def store(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.option("compression", "zstd").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(back)] = (back, path)
        return back

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            _, path = self._paths.pop(id(df))
            remove_path(self.spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For a result that several later steps read: it is computed once, lost executors do not
    bring its lineage back, and later steps read only the columns they need and know its size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
