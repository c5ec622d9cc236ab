"""Internal helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def colname(c: ColumnOrName) -> Column:
    """A column by its exact name (dots and spaces taken literally); a Column
    is returned as is."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


col = colname


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def order_key(order: Sequence[ColumnOrName]) -> Column:
    """Struct that sorts like ``ORDER BY o1, o2, ...`` where a NULL sorts as
    the largest value (the dialect's ASC NULLS LAST / DESC NULLS FIRST).

    Each value is preceded by its NULL flag so that ``max``/``min``/
    ``array_sort`` over the struct never depend on how NULL fields compare.
    """
    fields = []
    for i, o in enumerate(order):
        c = col(o)
        fields.append(c.isNull().alias(f"n{i}"))
        fields.append(c.alias(f"v{i}"))
    return F.struct(*fields)


def null_safe_keys(df, cols: Sequence[str], prefix: str):
    """Non-null stand-ins for possibly-NULL key columns.

    Each key becomes (value or a type default, is-NULL flag): grouping,
    partitioning and plain equi-joins on these pairs treat NULL as one key,
    as ``<=>`` does, but unlike ``<=>`` they let a join reuse the hash
    partitioning of a window or aggregate on the same columns instead of
    shuffling the large side again. Returns (frame, key column names).
    """
    from pyspark.sql import types as T
    names = []
    for i, c in enumerate(cols):
        dt = df.schema[c].dataType
        if isinstance(dt, (T.NumericType,)):
            default = F.lit(0).cast(dt)
        elif isinstance(dt, T.StringType):
            default = F.lit("")
        elif isinstance(dt, T.BooleanType):
            default = F.lit(False)
        elif isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            default = F.lit("1970-01-01").cast(dt)
        else:
            raise TypeError(f"unsupported key type {dt} for {c}")
        v, n = f"{prefix}v{i}", f"{prefix}n{i}"
        df = df.withColumn(v, F.coalesce(colname(c), default)).withColumn(n, colname(c).isNull())
        names += [n, v]
    return df, names
