"""Status-log operators: previous value (LAG), transitions, re-entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablero.functions.time import month_boundaries, year_boundaries
from tablero.operators._cols import ColumnOrName, as_list, col, colname, null_safe_keys


def with_previous(df: DataFrame, keys, order: Sequence[ColumnOrName], cols: Sequence[str],
                  prefix: str = "previous_", tie_break=(),
                  bucket: ColumnOrName | None = None) -> DataFrame:
    """Add ``LAG(c, 1) OVER (PARTITION BY keys ORDER BY order, tie)`` for each
    ``c`` in ``cols`` as ``prefix + c`` (order ASC, NULLs last).

    ``bucket`` splits hot keys: give a column (or several, compared in turn)
    monotone in ``order`` (for a log, the day of its timestamp). The LAG is
    then taken inside each (key, bucket). A bucket's first row takes the last
    row of the key's previous non-empty bucket in a second window, where only
    the first and last rows of the buckets meet per key and all other rows
    stay with their bucket. A key with a third of all rows then occupies as
    many tasks as it has buckets instead of one; the input is read once and
    shuffled twice. The bucket must hold many rows: buckets of about one row
    cost the second shuffle and protect nothing.
    """
    keys = as_list(keys)
    cols = list(cols)
    full_order = as_list(order) + as_list(tie_break)
    specs = [col(o).asc_nulls_last() for o in full_order]
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*specs)
        return df.select("*", *[F.lag(colname(c), 1).over(w).alias(prefix + c) for c in cols])

    buckets = [col(b) for b in as_list(bucket)]
    d = df.select("*", *[b.alias(f"_wp_bucket{i}") for i, b in enumerate(buckets)])
    d, kcols = null_safe_keys(d, keys, "_wp_k")
    d, bcols = null_safe_keys(d, [f"_wp_bucket{i}" for i in range(len(buckets))], "_wp_b")
    w_in = Window.partitionBy(*kcols, *bcols).orderBy(*specs)
    inner = d.select("*", F.row_number().over(w_in).alias("_wp_rn"),
                     F.lead(F.lit(1), 1).over(w_in).isNull().alias("_wp_last"),
                     *[F.lag(colname(c), 1).over(w_in).alias(f"_wp_lag{i}") for i, c in enumerate(cols)])
    edge = (F.col("_wp_rn") == 1) | F.col("_wp_last")
    inner = inner.withColumn("_wp_edge", edge)
    own = [F.when(~F.col("_wp_edge"), F.col(c)) for c in bcols]
    # bucket order: the NULL flag first (FALSE < TRUE puts a NULL bucket last), then the value
    w_key = Window.partitionBy(*kcols, "_wp_edge", *own).orderBy(*[F.col(c).asc() for c in bcols], *specs)
    return inner.select(
        *[colname(c) for c in df.columns],
        *[F.when(F.col("_wp_rn") == 1, F.lag(colname(c), 1).over(w_key))
           .otherwise(F.col(f"_wp_lag{i}")).alias(prefix + c) for i, c in enumerate(cols)])


def entered(state: ColumnOrName, previous: ColumnOrName, states: Sequence[str],
            first_row_counts: bool = True) -> Column:
    """Row enters one of ``states``.

    ``first_row_counts=True``: ``(prev IS NULL OR prev != state) AND state IN states``.
    ``False``: ``state != prev AND state IN states`` (a first row, whose
    previous state is NULL, does not count — three-valued logic).
    """
    s, p = col(state), col(previous)
    changed = (p.isNull() | (p != s)) if first_row_counts else (s != p)
    return changed & s.isin(list(states))


def moved(state: ColumnOrName, previous: ColumnOrName, from_states: Sequence[str],
          to_states: Sequence[str]) -> Column:
    """``prev IN from_states AND state IN to_states``."""
    return col(previous).isin(list(from_states)) & col(state).isin(list(to_states))


def transitions(log: DataFrame, keys, order, state: str, predicate, tie_break=(),
                bucket: ColumnOrName | None = None, prefix: str = "previous_",
                extra_previous: Sequence[str] = ()) -> DataFrame:
    """Rows of ``log`` where ``predicate(state_col, previous_state_col)`` holds."""
    withp = with_previous(log, keys, order, [state, *extra_previous], prefix=prefix,
                          tie_break=tie_break, bucket=bucket)
    return withp.filter(predicate(F.col(state), F.col(prefix + state)))


def boundary_gap_months(previous: ColumnOrName, current: ColumnOrName) -> Column:
    """``DATEDIFF(YEAR, p, c) * 12 + DATEDIFF(MONTH, p, c)`` exactly as the
    reactivation rule writes it (the month term already counts the years, so
    years are counted twice)."""
    return year_boundaries(previous, current) * 12 + month_boundaries(previous, current)


def reactivations(events: DataFrame, keys, ts: str, min_gap: int = 2, tie_break=(),
                  bucket: ColumnOrName | None = None, prefix: str = "previous_") -> DataFrame:
    """Events preceded, within the same key, by an event at least ``min_gap``
    (boundary-counted, see ``boundary_gap_months``) earlier."""
    withp = with_previous(events, keys, [ts], [ts], prefix=prefix, tie_break=tie_break, bucket=bucket)
    return withp.filter(boundary_gap_months(F.col(prefix + ts), F.col(ts)) >= min_gap)


def with_last_match(df: DataFrame, keys, order: Sequence[ColumnOrName], state: str, match, carried: Sequence[str],
                    previous: Sequence[str] = (), tie_break=(), bucket: ColumnOrName | None = None,
                    prefix: str = "previous_", name: str = "matches", match_prefix: str = "last_match_") -> DataFrame:
    """The LAG of ``with_previous`` and, in the same pass, what the key's last
    *matching* row before each matching row held.

    Adds ``prefix + c`` for ``state`` and each of ``previous`` (LAG), the
    boolean ``name`` = ``match(state, previous state)`` and, on rows where it
    holds, ``match_prefix + c`` for each of ``carried`` from the last earlier
    row of the key where it held (NULL on other rows and before the first).

    With ``bucket`` (as in ``with_previous``) the scan is segmented: inside each
    (key, bucket) the last match is carried from row to row; of a bucket only
    its first row, its last row (with the bucket's last match) and its first
    match go on to the second window, where they meet the edges of the key's
    other buckets. The first row's own match is only known there, because its
    previous state comes from the bucket before.
    """
    keys, previous = as_list(keys), [state, *previous]
    specs = [col(o).asc_nulls_last() for o in as_list(order) + as_list(tie_break)]
    row = F.struct(*[colname(c) for c in carried])

    def earlier(value: Column, window) -> Column:
        return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))

    def result(d: DataFrame, lags: Sequence[Column], matches: Column, before: Column) -> DataFrame:
        return d.select(*[colname(c) for c in df.columns], *[x.alias(prefix + c) for c, x in zip(previous, lags)],
                        F.coalesce(matches, F.lit(False)).alias(name),
                        *[F.when(matches, before.getField(c)).alias(match_prefix + c) for c in carried])

    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*specs)
        d = df.select("*", *[F.lag(colname(c), 1).over(w).alias(f"_wl_lag{i}") for i, c in enumerate(previous)])
        d = d.withColumn("_wl_match", match(colname(state), F.col("_wl_lag0")))
        d = d.withColumn("_wl_before", earlier(F.when(F.col("_wl_match"), row), w))
        return result(d, [F.col(f"_wl_lag{i}") for i in range(len(previous))], F.col("_wl_match"), F.col("_wl_before"))

    buckets = [col(b) for b in as_list(bucket)]
    d = df.select("*", *[b.alias(f"_wl_bucket{i}") for i, b in enumerate(buckets)])
    d, kcols = null_safe_keys(d, keys, "_wl_k")
    d, bcols = null_safe_keys(d, [f"_wl_bucket{i}" for i in range(len(buckets))], "_wl_b")
    w_in = Window.partitionBy(*kcols, *bcols).orderBy(*specs)
    d = d.select("*", F.row_number().over(w_in).alias("_wl_rn"), F.lead(F.lit(1), 1).over(w_in).isNull().alias("_wl_last"),
                 *[F.lag(colname(c), 1).over(w_in).alias(f"_wl_lag{i}") for i, c in enumerate(previous)])
    first = F.col("_wl_rn") == 1
    d = d.withColumn("_wl_inner", F.when(~first, match(colname(state), F.col("_wl_lag0"))))
    own = F.when(F.col("_wl_inner"), row)
    d = d.withColumn("_wl_before", earlier(own, w_in))
    d = d.withColumn("_wl_edge", first | F.col("_wl_last") | (F.coalesce("_wl_inner", F.lit(False)) & F.col("_wl_before").isNull()))

    # rows that are no edges stay with their bucket, as in with_previous
    # (as columns: both windows below then share one shuffle)
    d = d.select("*", *[F.when(~F.col("_wl_edge"), F.col(c)).alias(f"_wl_stay{i}") for i, c in enumerate(bcols)])
    w_key = Window.partitionBy(*kcols, "_wl_edge", *[f"_wl_stay{i}" for i in range(len(bcols))]).orderBy(*[F.col(c).asc() for c in bcols], *specs)
    lags = [F.when(first, F.lag(colname(c), 1).over(w_key)).otherwise(F.col(f"_wl_lag{i}")) for i, c in enumerate(previous)]
    d = d.select("*", *[x.alias(f"_wl_prev{i}") for i, x in enumerate(lags)])
    d = d.withColumn("_wl_match", F.when(first, match(colname(state), F.col("_wl_prev0"))).otherwise(F.col("_wl_inner")))
    own = F.when(F.col("_wl_match"), row)
    seen = F.coalesce(own, F.when(F.col("_wl_last"), F.col("_wl_before")))  # up to and with this edge
    d = d.withColumn("_wl_carried", F.coalesce(F.col("_wl_before"), earlier(seen, w_key)))
    return result(d, [F.col(f"_wl_prev{i}") for i in range(len(previous))], F.col("_wl_match"), F.col("_wl_carried"))
