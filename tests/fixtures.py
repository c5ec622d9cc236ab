"""Small hand-built rental tables for report tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import SparkSession

from tablero.sources import SCHEMAS, from_frames


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(x) -> Decimal:
    return None if x is None else Decimal(str(x))


def make_tables(spark: SparkSession, rows: dict[str, list[dict]]):
    """All 48 tables; the ones without rows are empty with their schema."""
    frames = {}
    for name, ddl in SCHEMAS.items():
        data = rows.get(name, [])
        df = spark.createDataFrame([], ddl)
        if data:
            cols = df.columns
            df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in data], ddl)
        frames[name] = df
    return from_frames(frames)
