"""Folders that the driver and all executors share, for tables that are written
and read again: they cut lineage, so a lost executor repeats only what follows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Fixed value: Spark's setting by which a query's shuffle files are deleted when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else the SQL warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each query that runs inside are deleted when it ends;
    otherwise they stay until the driver collects its garbage. For queries whose
    rows are written: what was shuffled for them is not read again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


class Staging:
    """Tables under one new folder of the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._cuts = 0

    def cut(self, df: DataFrame, name: str | None = None, done: Sequence[str] = ()) -> DataFrame:
        """``df`` written and read again; then its shuffle files and the tables
        ``done``, which no later step reads, are deleted."""
        self._cuts += 1
        path = f"{self.root}/{name or self._cuts}"
        with freed_shuffles(self.spark):
            df.write.parquet(path)
        self.drop(*done)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        for name in names:
            delete(self.spark, f"{self.root}/{name}")

    def close(self) -> None:
        """Delete the folder, once nothing reads its tables any more."""
        delete(self.spark, self.root)


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target must not exist."""
    fs, p = _path(spark, source)
    _, q = _path(spark, target)
    if fs.exists(q) or not fs.rename(p, q):
        raise OSError(f"cannot move {source} to {target}")
