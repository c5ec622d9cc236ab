"""Date/time helpers with the warehouse dialect's semantics.

Differences are BIGINT, as the dialect's DATEDIFF returns.

All stored timestamps are UTC wall-clock values held as ``timestamp_ntz``.
Nothing here reads the clock: "now" is always an explicit ``as_of``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_local(ts: ColumnOrName, tz: str = DEFAULT_TZ) -> Column:
    """UTC wall clock -> local wall clock (DST history honoured).

    The dialect's two-argument CONVERT_TIMEZONE takes UTC as the source
    zone, so the source is pinned here rather than left to the session.
    """
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts).cast("timestamp_ntz"))


def as_of_lit(as_of: dt.datetime | str) -> Column:
    """The report's "now" as a timestamp_ntz literal (UTC wall clock).

    Built from text: a Python datetime literal would pass through the driver
    process's local zone, and the result would then depend on it."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def as_of_date(as_of: dt.datetime | str) -> Column:
    """CURRENT_DATE for a UTC session at ``as_of``."""
    return F.to_date(as_of_lit(as_of))


def month_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    """DATEDIFF(MONTH, start, end): month boundaries crossed, not elapsed
    months (Dec 31 -> Jan 1 is 1)."""
    s, e = _c(start), _c(end)
    return ((F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))).cast("bigint")


def year_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    """DATEDIFF(YEAR, start, end): year boundaries crossed."""
    return (F.year(_c(end)) - F.year(_c(start))).cast("bigint")


def day_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    """DATEDIFF(DAY, start, end): midnights crossed (end - start)."""
    return F.date_diff(F.to_date(_c(end)), F.to_date(_c(start))).cast("bigint")


def parse_month(month_name: ColumnOrName, year: ColumnOrName, day: int = 1) -> Column:
    """Date from an English month name (any case) and a year; NULL when the
    name is not a month."""
    text = F.concat(F.lit(f"{day}-"), _c(month_name), F.lit(" "), _c(year).cast("string"))
    return F.try_to_date(text, "d-MMMM yyyy")


def month_start(d: ColumnOrName) -> Column:
    """DATE_TRUNC('month', d) as a date."""
    return F.trunc(F.to_date(_c(d)), "MM")
