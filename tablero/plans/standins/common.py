"""Shared pieces of the stand-in queries.

The stand-ins run each operator of the reports over the benchmark tables,
read whole: ``events`` plays the home status log, ``customer`` the users,
``supplier`` the owners, ``part`` the homes, ``orders`` the rents,
``lineitem`` the rental months / payments, ``nation``/``region`` the
agencies and countries. NULLs are introduced with ``nullif`` where an
operator's NULL semantics are the point. Every query is registered with its
DuckDB oracle next to it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ
from tablero.functions import label_map
from tablero.sources import driver_table

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# The report clock for queries over orders/lineitem, and over events.
AS_OF = dt.datetime(1998, 6, 15)
EVENTS_AS_OF = dt.datetime(2024, 1, 31)
TZ = DEFAULT_TZ

# Event type -> home status in the status-log stand-in.
STATUS_OF_EVENT = {
    "view": "published",
    "signup": "in_progress",
    "click": "pending_approval",
    "error": "canceled",
    "purchase": "rented",
}


def query(name: str, sql: str | None):
    """Register a stand-in query and its oracle SQL (None: rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return driver_table(spark, sf_dir, name)


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a home status log."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("home_id"), F.col("event_id").alias("log_id"),
                    F.col("ts").alias("created_at"),
                    label_map("event_type", STATUS_OF_EVENT).alias("status"),
                    F.floor("value").cast("bigint").alias("changed_by_id"),
                    F.col("props").alias("reason"), F.col("value"))


def _case_sql(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


STATUS_LOG_SQL = (
    "status_log AS (SELECT user_id AS home_id, event_id AS log_id, ts AS created_at, "
    f"{_case_sql('event_type', STATUS_OF_EVENT)} AS status, "
    "CAST(floor(value) AS BIGINT) AS changed_by_id, props AS reason, value FROM events)")


def loc(x: str) -> str:
    """DuckDB: UTC wall clock -> local wall clock."""
    return f"(({x}) AT TIME ZONE 'UTC') AT TIME ZONE '{TZ}'"


def initcap(x: str) -> str:
    """DuckDB: INITCAP breaking words at any non-alphanumeric character."""
    return (f"CASE WHEN ({x}) IS NOT NULL THEN array_to_string(list_transform("
            f"regexp_extract_all({x}, '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)'), "
            f"lambda w: upper(w[1]) || lower(w[2:])), '') END")


def months(a: str, b: str) -> str:
    """DuckDB: month boundaries crossed from a to b."""
    return f"((year({b}) * 12 + month({b})) - (year({a}) * 12 + month({a})))"


def round_div_sql(num_cents: str, den: str) -> str:
    """DuckDB: ROUND(num / den, 2) with exact HALF_UP decimal semantics,
    from the numerator in integer cents (DuckDB divides decimals as doubles)."""
    return (f"CASE WHEN ({den}) = 0 THEN NULL ELSE "
            f"CAST(sign({num_cents}) * sign({den}) * ((2 * abs({num_cents}) + abs({den})) // (2 * abs({den}))) "
            f"AS DECIMAL(38,0)) / 100.0 END")


def ts_lit(x: dt.datetime) -> str:
    return f"TIMESTAMP '{x.isoformat(sep=' ')}'"
