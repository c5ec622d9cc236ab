"""SparkSession construction with the settings every report relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tablero",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests.

    On a cluster the caller's own session is used instead; only
    ``configure`` is applied to it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", os.environ.get("TABLERO_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Settings the reports assume.

    * Session zone UTC: stored timestamps are UTC wall-clock values
      (``timestamp_ntz``); local time is always derived explicitly.
    * AQE on, with skew-join splitting and partition coalescing, so join
      strategies and reducer counts are picked from runtime sizes.
    * Runtime Bloom filters on: a join with a filtered, not too large side drops
      rows of the other side (from 1 GB on) at its scan, before they are shuffled
      (``members``). A filter has at most 64 million bits (Spark's default bound).
    """
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1g")
    return spark
