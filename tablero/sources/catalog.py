"""Loading report inputs.

Reports take a ``Mapping[str, DataFrame]`` keyed by table name (qualified
for the ``webscraping`` namespace), so the same code runs over a metastore,
a folder of Parquet files or test fixtures.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablero.sources.schemas import SCHEMAS


class Tables(Mapping):
    """Lazy table mapping: a table is resolved on first access."""

    def __init__(self, resolve, names: Iterable[str]):
        self._resolve = resolve
        self._names = list(names)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self._names:
                raise KeyError(name)
            self._cache[name] = self._resolve(name)
        return self._cache[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def from_parquet(spark: SparkSession, root: str, names: Iterable[str] | None = None) -> Tables:
    """``<root>/<name>.parquet`` (or ``<root>/<namespace>/<name>.parquet``)
    read with the declared schema, so nothing is inferred and only the
    columns a report selects are read."""
    names = list(names or SCHEMAS)

    def resolve(name: str) -> DataFrame:
        path = os.path.join(root, *name.split(".")) + ".parquet"
        return spark.read.schema(SCHEMAS[name]).parquet(path)

    return Tables(resolve, names)


def _qualified(name: str, database: str | None, namespaces: Mapping[str, str]) -> str:
    """Full name of a table: ``ns.t`` is in the database of namespace ``ns``, a
    plain ``t`` in ``database`` (None: the session's current one)."""
    namespace, _, table = name.rpartition(".")
    where = namespaces.get(namespace, namespace) if namespace else database
    return f"`{where}`.`{table}`" if where else f"`{table}`"


def from_catalog(spark: SparkSession, names: Iterable[str] | None = None, database: str | None = None,
                 namespaces: Mapping[str, str] | None = None) -> Tables:
    """Tables registered in the session catalog (``webscraping.x`` as its own
    database, or in the one that ``namespaces`` gives for ``webscraping``)."""
    names = list(names or SCHEMAS)
    return Tables(lambda name: spark.table(_qualified(name, database, namespaces or {})), names)


def month_of(column: str) -> str:
    """Partition column of a table that ``publish`` has partitioned by ``column``."""
    return f"{column}_month"


def publish(frames: Mapping[str, DataFrame], root: str, database: str, namespaces: Mapping[str, str] | None = None,
            months: Mapping[str, str] | None = None) -> None:
    """Write ``frames`` below ``root`` and register them in the session catalog,
    under the names by which ``from_catalog`` with the same ``database`` and
    ``namespaces`` resolves them. Existing tables of these names are replaced.

    ``months`` maps a table to a date or time column: the table is partitioned by
    that column's month (``month_of``; rows without a time have a partition of
    their own). A month with very many rows is written by several tasks."""
    for name, df in frames.items():
        spark, full = df.sparkSession, _qualified(name, database, namespaces or {})
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {full.split('.')[0]}")
        writer = df.write
        if name in (months or {}):
            month = month_of(months[name])
            writer = df.withColumn(month, F.trunc(months[name], "month")).hint("rebalance", month).write.partitionBy(month)
        writer.mode("overwrite").option("path", f"{root}/{full.replace('`', '').replace('.', '/')}").saveAsTable(full)


def within(column: str, first: str, beyond: str) -> Column:
    """``first <= column < beyond`` for a table partitioned by the month of
    ``column``: the same range of months goes with it, so that the scan lists and
    reads only those partitions."""
    low, high = F.lit(first).cast("timestamp_ntz"), F.lit(beyond).cast("timestamp_ntz")
    month = F.col(month_of(column))
    return ((F.col(column) >= low) & (F.col(column) < high)
            & (month >= F.trunc(F.lit(first).cast("date"), "month")) & (month <= F.lit(beyond).cast("date")))


def from_frames(frames: Mapping[str, DataFrame]) -> Tables:
    return Tables(lambda n: frames[n], frames.keys())


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the benchmark tables at ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
