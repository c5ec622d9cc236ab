"""One row per key: latest / first / any-one.

Implemented as aggregates (``max_by``/``min_by`` over a struct order key),
not as ``row_number() = 1`` windows: the aggregate is combined map-side, so a
key holding a third of all rows still leaves each map task with at most one
candidate per key and no task ever sorts the hot key's rows.

Ordering semantics are the warehouse dialect's: NULL order values count as
the largest, so "latest" (DESC) prefers a NULL and "first" (ASC) avoids it.
Ties are broken by ``tie_break`` columns, which should end in a unique key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablero.operators._cols import ColumnOrName, as_list, col, colname, null_safe_keys, order_key


def _payload(df: DataFrame, keys: list[str], columns) -> list[str]:
    if columns is None:
        return [c for c in df.columns if c not in keys]
    return as_list(columns)


def _pick(df: DataFrame, keys, order, tie_break, columns, largest: bool) -> DataFrame:
    keys = as_list(keys)
    payload = _payload(df, keys, columns)
    okey = order_key(as_list(order) + as_list(tie_break))
    row = F.struct(*[colname(c) for c in payload])
    agg = F.max_by(row, okey) if largest else F.min_by(row, okey)
    return (df.groupBy(*[colname(k) for k in keys]).agg(agg.alias("_picked"))
              .select(*[colname(k) for k in keys], *[F.col("_picked").getField(c).alias(c) for c in payload]))


def latest_per_key(df: DataFrame, keys, order, tie_break=(), columns=None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC, tie DESC) = 1``."""
    return _pick(df, keys, order, tie_break, columns, largest=True)


def first_per_key(df: DataFrame, keys, order, tie_break=(), columns=None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order ASC, tie ASC) = 1``."""
    return _pick(df, keys, order, tie_break, columns, largest=False)


def any_one_per_key(df: DataFrame, keys, columns=None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys) = 1`` made deterministic: the
    row whose projected columns sort first (NULLs last)."""
    keys = as_list(keys)
    payload = _payload(df, keys, columns)
    return _pick(df, keys, payload, (), payload, largest=False)


def first_and_last(df: DataFrame, keys, order, tie_break=(), columns=None,
                   first_prefix: str = "first_", last_prefix: str = "last_") -> DataFrame:
    """First and latest row per key from a single aggregation (one shuffle)."""
    keys = as_list(keys)
    payload = _payload(df, keys, columns)
    okey = order_key(as_list(order) + as_list(tie_break))
    row = F.struct(*[colname(c) for c in payload])
    out = df.groupBy(*[colname(k) for k in keys]).agg(F.min_by(row, okey).alias("_first"),
                                                   F.max_by(row, okey).alias("_last"))
    return out.select(*[colname(k) for k in keys],
                      *[F.col("_first").getField(c).alias(first_prefix + c) for c in payload],
                      *[F.col("_last").getField(c).alias(last_prefix + c) for c in payload])


def number_rows(df: DataFrame, keys, order: Sequence[ColumnOrName], tie_break=(),
                name: str = "row_number", bucket: ColumnOrName | None = None,
                descending: bool = False) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order ASC NULLS LAST, tie)``
    (``descending``: DESC NULLS FIRST), as BIGINT.

    With ``bucket`` (a column, or several compared in turn, monotone in
    ``order``, e.g. the day of the order timestamp) rows are numbered inside (key, bucket) and shifted by the
    row counts of the key's earlier buckets, so a hot key is spread over as
    many tasks as it has buckets. Without it this is a plain window.
    """
    keys = as_list(keys)
    full = as_list(order) + as_list(tie_break)
    specs = [col(o).desc_nulls_first() if descending else col(o).asc_nulls_last() for o in full]
    if bucket is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*specs)).cast("bigint"))
    buckets = [col(b) for b in as_list(bucket)]
    d = df.select("*", *[b.alias(f"_nr_bucket{i}") for i, b in enumerate(buckets)])
    d, kcols = null_safe_keys(d, keys, "_nr_k")
    d, bcols = null_safe_keys(d, [f"_nr_bucket{i}" for i in range(len(buckets))], "_nr_b")
    inner = d.withColumn("_nr_in", F.row_number().over(Window.partitionBy(*kcols, *bcols).orderBy(*specs)))
    # bucket sizes counted from the input, combined map-side
    counts = d.groupBy(*kcols, *bcols).agg(F.count(F.lit(1)).alias("_nr_n"))
    # bucket order: NULL flag then value, both reversed for DESC NULLS FIRST
    b_specs = [F.col(c).desc() if descending else F.col(c).asc() for c in bcols]
    lead, zero = bcols[:2], F.lit(0)
    if len(buckets) > 1:
        # two levels: inside each leading bucket, then over the leading buckets'
        # totals, so no window runs over all buckets of a key
        totals = counts.groupBy(*kcols, *lead).agg(F.sum("_nr_n").alias("_nr_t"))
        over = Window.partitionBy(*kcols).orderBy(*b_specs[:2]).rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select(*kcols, *lead, F.coalesce(F.sum("_nr_t").over(over), zero).alias("_nr_before"))
        wb = Window.partitionBy(*kcols, *lead).orderBy(*b_specs[2:]).rowsBetween(Window.unboundedPreceding, -1)
        offsets = (counts.join(totals, on=kcols + lead)
                   .select(*kcols, *bcols, (F.col("_nr_before") + F.coalesce(F.sum("_nr_n").over(wb), zero)).alias("_nr_off")))
    else:
        wb = Window.partitionBy(*kcols).orderBy(*b_specs).rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(*kcols, *bcols, F.coalesce(F.sum("_nr_n").over(wb), zero).alias("_nr_off"))
    joined = inner.join(offsets, on=kcols + bcols, how="left")
    return joined.select(*[colname(c) for c in df.columns],
                         (F.col("_nr_in") + F.col("_nr_off")).cast("bigint").alias(name))


def transition_summary(df: DataFrame, keys, order, specs, tie_break=(), extra=None) -> DataFrame:
    """Several conditional first/latest picks per key from ONE aggregation.

    ``specs`` maps a name to ``(condition, "first" | "last", columns)`` or
    ``(condition, which, columns, order)`` to order that pick differently; the
    output has ``<name>_<column>`` for each, taken from the first (or latest)
    row of the key where the condition holds (NULL when none does). Rows
    failing a condition get a NULL ordering for that pick, which
    ``min_by``/``max_by`` skip. ``extra`` adds named aggregate columns to the
    same aggregation. One shuffle serves every pick, instead of one filtered
    window (and one scan of the log) per pick.
    """
    keys = as_list(keys)
    aggs, outs = [], []
    for name, spec in specs.items():
        cond, which, columns = spec[:3]
        pick_order = spec[3] if len(spec) > 3 else order
        okey = order_key(as_list(pick_order) + as_list(tie_break))
        columns = as_list(columns)
        row = F.struct(*[colname(c) for c in columns])
        masked = F.when(cond, okey)
        agg = F.min_by(row, masked) if which == "first" else F.max_by(row, masked)
        aggs.append(agg.alias(f"_ts_{name}"))
        outs += [F.col(f"_ts_{name}").getField(c).alias(f"{name}_{c}") for c in columns]
    for name, agg in (extra or {}).items():
        aggs.append(agg.alias(name))
        outs.append(F.col(name))
    return df.groupBy(*[colname(k) for k in keys]).agg(*aggs).select(*[colname(k) for k in keys], *outs)
