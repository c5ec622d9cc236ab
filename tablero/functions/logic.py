"""Predicates, flags and label maps with exact NULL semantics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_true(c: ColumnOrName) -> Column:
    """``x IS TRUE`` (never NULL)."""
    return _c(c).eqNullSafe(F.lit(True))


def is_false(c: ColumnOrName) -> Column:
    """``x IS FALSE`` (never NULL)."""
    return _c(c).eqNullSafe(F.lit(False))


def has_bit(c: ColumnOrName, n: int) -> Column:
    """``(x & (1 << n)) > 0``; NULL when x is NULL."""
    return _c(c).bitwiseAND(F.lit(1 << n)) > 0


def yes_no(cond: Column, yes: str = "Si", no: str = "No") -> Column:
    """CASE WHEN cond THEN 'Si' ELSE 'No' END (NULL condition -> 'No')."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def flag_int(cond: Column) -> Column:
    """CASE WHEN cond THEN 1 ELSE 0 END."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def not_in(c: ColumnOrName, values: Sequence) -> Column:
    """``x NOT IN (...)`` / ``x != ALL(ARRAY[...])``: NULL (row dropped in a
    filter) when x is NULL."""
    return ~_c(c).isin(list(values))


def label_map(c: ColumnOrName, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Searched CASE mapping equal values to labels; no match -> ``default``
    (NULL when not given)."""
    col = _c(c)
    out = None
    for key, label in mapping.items():
        out = F.when(col == F.lit(key), F.lit(label)) if out is None else out.when(col == F.lit(key), F.lit(label))
    if default is not None:
        out = out.otherwise(default)
    return out


def first_match(*branches: tuple[Column, Column], default: Column | None = None) -> Column:
    """Ordered CASE ladder from (condition, value) pairs."""
    out = None
    for cond, value in branches:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if default is not None:
        out = out.otherwise(default)
    return out


# Spanish month names keyed by the lower-case English name, as
# the payments report labels a rental month ("enero/2021").
SPANISH_MONTHS = {
    "january": "enero",
    "february": "febrero",
    "march": "marzo",
    "april": "abril",
    "may": "mayo",
    "june": "junio",
    "july": "julio",
    "august": "agosto",
    "september": "septiembre",
    "october": "octubre",
    "november": "noviembre",
    "december": "diciembre",
}


def month_label(month: ColumnOrName, year: ColumnOrName) -> Column:
    """"<spanish month>/<year>"; unknown month names pass through as
    "<month>/<year>"; NULL year -> NULL."""
    m = _c(month)
    name = label_map(m, SPANISH_MONTHS, default=m)
    return F.concat(name, F.lit("/"), _c(year).cast("string"))
