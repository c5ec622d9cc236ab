"""Helpers shared by the report builders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablero.operators import hot_keys, spread_join
from tablero.sources.sinks import with_position
from tablero.sources.staging import Staging


def labelled(df: DataFrame, labels: Sequence[tuple[str, str]]) -> DataFrame:
    """Final projection: internal column -> output label, in report order."""
    return df.select(*[F.col(src).alias(label) for src, label in labels])


@dataclass(frozen=True)
class Numbered:
    """For ``ordered``: write the report in its order to ``path`` and return it
    read back, with each row's place in that order in a last column."""

    path: str
    name: str = "position"


# Fixed value: how many of a report's columns order rows that are equal in its sort keys.
TIE_COLUMNS = 3


def staged(staging: Staging | None, df: DataFrame, name: str, done: Sequence[str] = ()) -> DataFrame:
    """``df``, for a report with ``staging`` written there and read again, after
    which the tables ``done`` are deleted: at any time the disk holds the shuffles
    of one part of the report, and what the parts before have written."""
    return df if staging is None else staging.cut(df, name, done)


def sort_then_label(df: DataFrame, labels: Sequence[tuple[str, str]], order: Sequence[Column] | None,
                    ordered: bool | Numbered, staging: Staging | None = None, done: Sequence[str] = ()) -> DataFrame:
    """Apply the report's final ORDER BY (range-partitioned global sort) when
    ``ordered``; sort keys may be columns that are not projected.

    Rows equal in the sort keys go by the report's first columns, so that many
    rows of one sort value (NULL, for instance) are cut into several ranges.

    ``Numbered``: rows equal in the sort keys are ordered by the report's
    columns in turn (NULLs last), so that places do not depend on the run.

    With ``staging`` the rows are written before they are sorted (``staged``)."""
    if ordered and order:
        df = staged(staging, df, "rows", done)
    if isinstance(ordered, Numbered) and order:
        df = with_position(df, [*order, *[F.col(src).asc_nulls_last() for src, _ in labels]], ordered.path, ordered.name)
        if staging is not None:
            staging.drop("rows")
        return labelled(df, [*labels, (ordered.name, ordered.name)])
    if ordered and order:
        df = df.orderBy(*order, *[F.col(src).asc_nulls_last() for src, _ in labels[:TIE_COLUMNS]])
    return labelled(df, labels)


def alias_cols(df: DataFrame, prefix: str, cols: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Select columns of ``df`` renamed with ``prefix`` (a role of a table)."""
    if not isinstance(cols, Mapping):
        cols = {c: c for c in cols}
    return df.select(*[F.col(src).alias(f"{prefix}{out}") for out, src in cols.items()])


def as_of_value(as_of: dt.datetime | str | None) -> dt.datetime:
    if as_of is None:
        raise ValueError("as_of is required: reports never read the clock")
    return dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def time_bucket(ts: str, unit: str = "day"):
    """Bucket column for the split windows (``with_previous``/``number_rows``):
    the ``unit`` (hour, day, month) a timestamp falls in; monotone in time."""
    if unit == "day":
        return F.to_date(ts)
    return F.date_trunc(unit, F.col(ts))


def lookups(df: DataFrame, spread_by: Sequence, joins: Sequence[tuple], hot: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Left joins in turn, ``(left key, (dimension, right key), ...)`` each, with
    the rows whose key is NULL or hot dealt over several tasks (``spread_join``).
    ``hot`` maps the first right key of an entry to the hot keys there."""
    for left_key, *rights in joins:
        df = spread_join(df, left_key, rights, hot=(hot or {}).get(rights[0][1]), spread_by=spread_by)
    return df


def measured(df: DataFrame, keys: Mapping[str, str], rows: int | None) -> dict[str, DataFrame]:
    """For ``lookups``: per right key the values of ``df``'s foreign key that
    more than ``rows`` rows hold; none if ``rows`` is None. Each is one more
    narrow pass over that column, worth it where one value is known to be hot."""
    return {right: hot_keys(df, key, rows) for right, key in keys.items()} if rows else {}
