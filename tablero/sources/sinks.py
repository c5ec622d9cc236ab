"""Writing report results (the reports themselves only return DataFrames)."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tablero.sources.staging import delete, exists, freed_shuffles, move


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """Write a report. Labels with spaces/accents are valid Parquet names."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


@dataclass(frozen=True)
class Receipt:
    """What a sink has written: rows and the sum of their 64-bit hashes, which
    depends on neither order nor partitioning."""

    rows: int
    digest: int


def receipt(df: DataFrame) -> Receipt:
    cols = [F.col("`" + c.replace("`", "``") + "`") for c in sorted(df.columns)]
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("h")).first()
    return Receipt(r.n, int(r.h or 0))


def replace_result(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Receipt:
    """Write ``df`` as the result at ``path``, so that a run can fail or be
    repeated at any point and readers see the old result or the new one.

    The rows go to a staging folder beside ``path`` first, are read back and
    counted and hashed; only then is the result touched. Without
    ``partition_by`` the staged folder takes the place of the old one. With it,
    only the partitions that ``df`` has rows for are replaced (dynamic partition
    overwrite, whose own commit moves whole partitions), the others stay; what
    was written is read back and must hash like what was staged. A run that
    fails before this leaves the old result as it was; running again with the
    same rows gives the same result. Rows are written once more for partitions,
    in exchange for never publishing a partition that was not verified. (Spark
    reads an empty string in a partition column back as NULL: that run fails.)
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    try:
        df.write.parquet(staged)
        rows = spark.read.schema(df.schema).parquet(staged)
        told = receipt(rows)
        if not partition_by:
            old = f"{staged}.old"
            had = exists(spark, path)
            if had:
                move(spark, path, old)
            try:
                move(spark, staged, path)
            except Exception:
                if had:
                    move(spark, old, path)
                raise
            delete(spark, old)
            return told
        keys = list(partition_by)
        # a partition's rows may come from several tasks: a hot partition is split by AQE, small ones are merged
        rows.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
        # only the partitions of this run, found by their values
        parts = rows.select(*keys).distinct()
        back = spark.read.schema(df.schema).parquet(path).select(*df.columns)
        same = [F.col(f"b.`{k}`").eqNullSafe(F.col(f"p.`{k}`")) for k in keys]
        written = receipt(back.alias("b").join(parts.alias("p"), same, "left_semi"))
        if written != told:
            raise OSError(f"{path}: wrote {told}, read back {written}")
        return told
    finally:
        delete(spark, staged)


def with_position(df: DataFrame, order: Sequence[Column], path: str, name: str = "position") -> DataFrame:
    """Write ``df`` in its order to ``path`` and read it back with each row's
    place in that order (from 1) in ``name``.

    Spark samples the range boundaries of the sort; a row's number inside its
    range is taken as it is written, and the ranges' offsets are sums of their
    row counts. No window runs over the rows. The driver gets one number for
    each range, as many as the sort has partitions. ``order`` should end in
    columns that tell rows apart, so that many rows of one sort value (NULL, for
    instance) are cut into several ranges.
    """
    spark, at = df.sparkSession, "_wp_at"
    rows = spark.read.schema(StructType([*df.schema.fields, StructField(at, LongType())]))
    part = F.shiftright(F.col(at), 33)  # the upper bits of the id are the partition
    with freed_shuffles(spark):
        df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()).write.parquet(path)
        rows = rows.parquet(path)
        sizes = sorted(rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = itertools.accumulate((r.n for r in sizes), initial=0)
    offsets = spark.createDataFrame([(r.part, n) for r, n in zip(sizes, before)], "_wp_part long, _wp_before long")
    inside = F.col(at).bitwiseAND((1 << 33) - 1)
    placed = rows.join(F.broadcast(offsets), part == F.col("_wp_part"))
    return placed.select(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns], (F.col("_wp_before") + inside + 1).alias(name))
