"""Grouped aggregates: conditional counts, sums, ordered string lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablero.operators._cols import ColumnOrName, as_list, col, order_key


def count_when(df: DataFrame, keys, conditions: Mapping[str, Column], total: str | None = "n",
               else_zero: bool = True) -> DataFrame:
    """``COUNT(*)`` plus ``SUM(CASE WHEN cond THEN 1 [ELSE 0] END)`` per key.

    ``else_zero=False`` is the no-ELSE form wrapped in COALESCE(..., 0); both
    give 0 for a group with no match, only the ELSE-less form is written
    that way in some reports."""
    keys = as_list(keys)
    aggs = [F.count(F.lit(1)).alias(total)] if total else []
    for name, cond in conditions.items():
        if else_zero:
            aggs.append(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).alias(name))
        else:
            aggs.append(F.coalesce(F.sum(F.when(cond, F.lit(1))), F.lit(0)).alias(name))
    return df.groupBy(*keys).agg(*aggs)


def list_join(df: DataFrame, keys, item: ColumnOrName, order_by: Sequence[ColumnOrName] = (),
              sep: str = ", ", name: str = "items", bucket: ColumnOrName | None = None) -> DataFrame:
    """``LISTAGG(item, sep) WITHIN GROUP (ORDER BY order_by)`` per key.

    NULL items are skipped; a group with no non-NULL item gives NULL.
    ``order_by`` sorts ASC with NULLs last and defaults to the item itself.
    The list is gathered per key (partially per map task, then merged), so
    its memory is that of the output string.

    ``bucket`` (a column, or several compared in turn, monotone in
    ``order_by``) is for keys with very many items: items are gathered, sorted
    and joined inside (key, bucket) first, and a key only puts the finished
    strings of its buckets together, in bucket order. No task sorts a whole
    group, and what meets per key is text, not items with their sort keys.
    """
    keys = as_list(keys)
    it = col(item)
    okey = order_key(as_list(order_by) or [it])

    def joined(d: DataFrame, by: list, order: Column, value: Column) -> DataFrame:
        gathered = F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("k"), value.alias("v"))))
        whole = F.array_join(F.transform(F.array_sort("_lj"), lambda x: x["v"]), sep)
        return d.groupBy(*by).agg(gathered.alias("_lj")).withColumn(name, F.when(F.size("_lj") > 0, whole)).drop("_lj")

    if bucket is None:
        return joined(df, keys, okey, it)
    marks = [f"_lj_b{i}" for i in range(len(as_list(bucket)))]
    d = df.select("*", *[col(b).alias(m) for b, m in zip(as_list(bucket), marks)])
    return joined(joined(d, [*keys, *marks], okey, it), keys, order_key(marks), F.col(name))


def sum_by(df: DataFrame, keys, values: Mapping[str, ColumnOrName]) -> DataFrame:
    """``SUM(v)`` per key for each output name -> column."""
    return df.groupBy(*as_list(keys)).agg(*[F.sum(col(v)).alias(n) for n, v in values.items()])


def sibling_sums(children: Mapping[str, DataFrame], key: str, value: str) -> DataFrame:
    """``SUM(value)`` of each child as if all were left-joined to the record
    ``key`` side by side: a child's sum counts once per combination of the
    other children's rows (a missing child being one NULL row). One row per
    record that has any child, ``<name>_total`` per child.

    The children are read as one tagged union and grouped once; a child's sum
    is weighted by the others' row counts, so no row product is built. The rows
    are dealt by record as they are: a record has a few, and a row is narrower
    than the sums and counts of all children that would stand for it.
    """
    tagged = None
    for i, child in enumerate(children.values()):
        rows = child.select(col(key).alias("_record"), F.lit(i).cast("tinyint").alias("_child"), col(value).alias("_value"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    per = tagged.repartition("_record").groupBy("_record").agg(
        *[F.sum(F.when(F.col("_child") == i, F.col("_value"))).alias(f"_sum_{n}") for i, n in enumerate(children)],
        *[F.greatest(F.count(F.when(F.col("_child") == i, 1)), F.lit(1)).alias(f"_rows_{n}") for i, n in enumerate(children)])

    def weighted(name: str) -> Column:
        total = F.col(f"_sum_{name}")
        for other in children:
            if other != name:
                total = total * F.col(f"_rows_{other}")
        return total
    return per.select(F.col("_record").alias(key), *[weighted(n).alias(f"{n}_total") for n in children])
