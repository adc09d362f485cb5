"""Where jobs put what several executors must read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a session in one process uses a temporary folder; any
    other session must name one that all executors reach.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="tickloom-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new location below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this package has written; one that is gone already is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def mounted(spark: SparkSession, path: str) -> str | None:
    """What the operating system calls ``path``; None on a file system that only Hadoop reaches."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(at).toUri().getPath() if files.getUri().getScheme() == "file" else None


class shuffles_removed:
    """Shuffle files go when the write that made them has ended, not when the driver next collects its garbage.

    Only for writes: each is planned anew, so none needs the files of another.
    """

    def __init__(self, spark: SparkSession):
        self.conf, self.name = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __enter__(self) -> None:
        self.before = self.conf.get(self.name)
        self.conf.set(self.name, "true")

    def __exit__(self, *_) -> None:
        self.conf.set(self.name, self.before)


class Scratch:
    """Intermediate rows of one job in the shared folder, deleted when the job ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        """Rows written once, for plans that read them several times."""
        path = fresh_path(self.spark, label)
        self.paths.append(path)
        with shuffles_removed(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            remove_folder(self.spark, path)


def ready_for_checkpoint(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable in this session."""
    if spark.sparkContext.getCheckpointDir() is None:
        root = shared_root(spark)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
