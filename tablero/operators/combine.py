"""Joins and reshaping: lookups, role slots, ancestor roll-ups, populations.

No join here forces a strategy: sizes are known only at run time, so the
choice between broadcast and shuffle joins is left to AQE, which broadcasts
a side only when its measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablero.operators._cols import ColumnOrName, as_list, col


def hot_keys(df: DataFrame, key: ColumnOrName, rows: int) -> DataFrame:
    """The keys (``hot_key``) that more than ``rows`` rows of ``df`` hold: at
    most ``count(df) / rows`` of them. Counted map-side over one narrow column."""
    per = df.select(col(key).alias("hot_key")).filter(F.col("hot_key").isNotNull()).groupBy("hot_key").agg(F.count(F.lit(1)).alias("_hk_n"))
    return per.filter(F.col("_hk_n") > rows).select("hot_key")


def spread_join(left: DataFrame, left_key: ColumnOrName, rights: Sequence[tuple[DataFrame, ColumnOrName]], salts: int = 16,
                hot: DataFrame | None = None, spread_by: Sequence[ColumnOrName] = ()) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` for each ``(right,
    right_key)`` of ``rights``, without a task that gets all rows of one key.

    A NULL key matches nothing, yet a plain join sends all such rows to one
    task: here they are dealt over ``salts`` tasks by a hash of ``spread_by``
    (columns that tell rows apart; default: all). The keys of ``hot`` (from
    ``hot_keys``; broadcast, its size is bounded there) are dealt the same way,
    and their rows of the right sides copied to each of the tasks.

    The salt is a second equi-join key, so each join stays one join, all of
    them share one shuffle of ``left``, and ``left`` is read once; a union of
    the keyed and the NULL rows would evaluate everything below ``left`` twice,
    and once more for every further key.
    """
    spread = [col(c) for c in spread_by] or [F.col("`" + c.replace("`", "``") + "`") for c in left.columns]
    k, dealt = col(left_key), F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    many = None if hot is None else F.broadcast(hot.select("hot_key", F.lit(True).alias("_sj_hot")))
    if many is None:
        out = left.withColumn("_sj_salt", F.when(k.isNull(), dealt).otherwise(0))
    else:
        out = left.join(many, k == F.col("hot_key"), "left").withColumn(
            "_sj_salt", F.when(k.isNull() | F.col("_sj_hot"), dealt).otherwise(0)).drop("hot_key", "_sj_hot")
    for right, right_key in rights:
        if many is None:
            # always 0, but no literal: a literal would be folded out of the join's keys
            copies = right.withColumn("_sj_copy", F.pmod(F.xxhash64(col(right_key)), F.lit(1)).cast("int"))
        else:
            every = F.when(F.col("_sj_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
            copies = right.join(many, col(right_key) == F.col("hot_key"), "left").withColumn("_sj_copy", F.explode(every)).drop("hot_key", "_sj_hot")
        out = out.join(copies, (k == col(right_key)) & (F.col("_sj_salt") == F.col("_sj_copy")), "left").drop("_sj_copy")
    return out.drop("_sj_salt")


def lookup(df: DataFrame, dim: DataFrame, left_on: ColumnOrName, right_on: str,
           columns: Mapping[str, str], how: str = "left", salts: int = 0, hot: DataFrame | None = None,
           spread_by: Sequence[ColumnOrName] = ()) -> DataFrame:
    """Left join ``dim`` on ``left_on = dim.right_on`` adding ``columns``
    (output name -> dim column). Several roles of one dimension are several
    calls with different output names.

    ``salts`` (left joins only) deals the rows with a NULL key, and those with a
    key of ``hot``, over that many tasks: see ``spread_join``."""
    tag = "_lk_key"
    right = dim.select(F.col(right_on).alias(tag), *[F.col(src).alias(out) for out, src in columns.items()])
    if salts:
        if how != "left":
            raise ValueError("salts need a left join")
        return spread_join(df, left_on, [(right, tag)], salts, hot, spread_by).drop(tag)
    return df.join(right, col(left_on) == F.col(tag), how).drop(tag)


def role_pivot(df: DataFrame, keys, role: ColumnOrName, slots: Mapping[str, Column | str],
               values: Sequence[str]) -> DataFrame:
    """Rows per (key, role) turned into one row per key with a column group
    per slot: ``<slot>_<value>``.

    ``slots`` maps a slot name to a role value or to a predicate on the role.
    One aggregation replaces one filtered self-join per slot. Exact when each
    slot matches at most one row per key (pre-aggregate or pick one row per
    (key, role) first); otherwise use ``slot_join``, which keeps the fan-out.
    """
    keys = as_list(keys)
    r = col(role)
    aggs = []
    for slot, match in slots.items():
        cond = match if isinstance(match, Column) else (r == F.lit(match))
        aggs.append(F.max(F.when(cond, F.struct(*[F.col(v) for v in values]))).alias("_s_" + slot))
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *[F.col("_s_" + s).getField(v).alias(f"{s}_{v}")
                               for s in slots for v in values])


def slot_join(df: DataFrame, left_key: ColumnOrName, rows: DataFrame, right_key: str,
              predicate: Column, columns: Mapping[str, str]) -> DataFrame:
    """``LEFT JOIN rows ON rows.key = df.key AND predicate(rows)``: the
    faithful form of a role slot, keeping one output row per matching row."""
    tag = "_sj_key"
    right = rows.filter(predicate).select(F.col(right_key).alias(tag),
                                          *[F.col(src).alias(out) for out, src in columns.items()])
    return df.join(right, col(left_key) == F.col(tag), "left").drop(tag)


def slot_product(df: DataFrame, key: str, slots: Mapping[str, Column], values: Sequence[str]) -> DataFrame:
    """What successive ``LEFT JOIN df ON key AND predicate`` add to a row with
    that key, from a single read of ``df``: one row per key and combination of
    one row of each slot, ``<slot>_<value>`` columns, NULL for a slot without
    rows. Join it on ``key`` once.

    ``slots`` are predicates that exclude each other. The rows of a key are
    numbered per slot; row ``i`` of a slot is then repeated at the places
    where a product counter has ``i`` as that slot's digit, and one grouping by
    (key, place) puts the combinations together. The rows of a key meet in one
    sorted (spilling) window; rows with a NULL key or in no slot are dropped.
    """
    names = list(slots)
    slot = F.coalesce(*[F.when(p, F.lit(i)) for i, p in enumerate(slots.values())])
    d = df.select(col(key).alias("_sp_key"), F.struct(*[col(v).alias(v) for v in values]).alias("_sp_row"), slot.alias("_sp_slot"))
    d = d.filter(F.col("_sp_key").isNotNull() & F.col("_sp_slot").isNotNull())
    whole = Window.partitionBy("_sp_key")
    d = d.select("*", *[F.greatest(F.count(F.when(F.col("_sp_slot") == i, 1)).over(whole), F.lit(1)).alias(f"_sp_n{i}")
                        for i in range(len(names))])
    at = F.row_number().over(Window.partitionBy("_sp_key", "_sp_slot").orderBy("_sp_row")) - 1
    d = d.withColumn("_sp_at", at.cast("bigint"))
    sizes = [F.col(f"_sp_n{i}") for i in range(len(names))]
    product = lambda xs: reduce(lambda a, b: a * b, xs, F.lit(1).cast("bigint"))
    pick = lambda xs: F.element_at(F.array(*xs), F.col("_sp_slot") + 1)
    d = d.select("_sp_key", "_sp_slot", "_sp_row", "_sp_at", pick(sizes).alias("_sp_size"), product(sizes).alias("_sp_all"),
                 pick([product(sizes[:i]) for i in range(len(names))]).alias("_sp_stride"))
    d = d.withColumn("_sp_rest", F.explode(F.expr("sequence(0L, _sp_all div _sp_size - 1)")))
    place = F.expr("_sp_rest % _sp_stride + _sp_stride * (_sp_at + _sp_size * (_sp_rest div _sp_stride))")
    rows = d.groupBy("_sp_key", place.alias("_sp_place")).agg(
        *[F.max(F.when(F.col("_sp_slot") == i, F.col("_sp_row"))).alias(f"_sp_{n}") for i, n in enumerate(names)])
    return rows.select(F.col("_sp_key").alias(key), *[F.col(f"_sp_{n}").getField(v).alias(f"{n}_{v}") for n in names for v in values])


def rollup_ancestors(values: DataFrame, key: str, value: str, hierarchy: DataFrame,
                     node: str, parent: str, depth: int | None = 2, name: str | None = None, cut=None) -> DataFrame:
    """For each key of ``values``: value(key) + value(parent) + value(grandparent)...
    up to ``depth`` ancestors, missing terms counting 0.

    ``values`` must be one row per key; ``hierarchy`` one row per node.
    Each level is one equi-join of narrow (key, value) / (node, parent) frames.

    ``depth=None`` takes all ancestors, by doubling: after round ``i`` every
    node holds the sum of its next ``2**i`` ancestors and a pointer to the last
    of them, so a chain of ``d`` rents takes ``log2(d)`` rounds of one self-join,
    not ``d`` joins. Each round's frame is handed to ``cut`` (write and read
    again, or a checkpoint; ``DataFrame.checkpoint`` by default), and the rounds
    end when no pointer is left. A chain that runs into a cycle has no end: its
    keys have a NULL total. They are known after ``log2(nodes) + 1`` rounds.
    """
    name = name or value
    links = hierarchy.select(F.col(node).alias("_ra_node"), F.col(parent).alias("_ra_parent"))
    vals = values.select(F.col(key).alias("_ra_vkey"), F.col(value).alias("_ra_val"))
    if depth is None:
        return _all_ancestors(values, key, value, links, vals, name, cut or (lambda d: d.checkpoint()))
    cur = values.select(F.col(key).alias(key), F.col(key).alias("_ra_at"),
                        F.coalesce(F.col(value), F.lit(0)).alias("_ra_total"))
    for _ in range(depth):
        cur = (cur.join(links, F.col("_ra_at") == F.col("_ra_node"), "left")
                  .join(vals, F.col("_ra_parent") == F.col("_ra_vkey"), "left")
                  .select(key, F.col("_ra_parent").alias("_ra_at"),
                          (F.col("_ra_total") + F.coalesce(F.col("_ra_val"), F.lit(0))).alias("_ra_total")))
    return cur.select(key, F.col("_ra_total").alias(name))


def _all_ancestors(values: DataFrame, key: str, value: str, links: DataFrame, vals: DataFrame, name: str, cut) -> DataFrame:
    """``rollup_ancestors`` without a bound on the depth."""
    total = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,2)")
    # the sum takes the ancestors from the parent up to and with the pointer
    now = (links.filter(F.col("_ra_node").isNotNull() & F.col("_ra_parent").isNotNull())
                .join(vals, F.col("_ra_parent") == F.col("_ra_vkey"), "left")
                .select("_ra_node", total("_ra_val").alias("_ra_sum"), F.col("_ra_parent").alias("_ra_to")))
    now = cut(now)
    rounds = max(1, now.count()).bit_length() + 1
    for _ in range(rounds):
        beyond = now.select(F.col("_ra_node").alias("_ra_key"), F.col("_ra_sum").alias("_ra_more"), F.col("_ra_to").alias("_ra_next"))
        # more pointers are NULL with every round
        step = spread_join(now, "_ra_to", [(beyond, "_ra_key")], spread_by=["_ra_node"]).select(
            "_ra_node", (F.col("_ra_sum") + F.coalesce("_ra_more", F.lit(0))).cast("decimal(38,2)").alias("_ra_sum"), F.col("_ra_next").alias("_ra_to"))
        now = cut(step)
        if now.filter(F.col("_ra_to").isNotNull()).isEmpty():
            break
    sums = now.select("_ra_node", "_ra_sum", F.col("_ra_to").isNotNull().alias("_ra_endless"))
    own = values.join(sums, F.col(key) == F.col("_ra_node"), "left")
    return own.select(key, F.when(~F.coalesce("_ra_endless", F.lit(False)), total(value) + F.coalesce("_ra_sum", F.lit(0))).alias(name))


def population(*sources: tuple[DataFrame, str], name: str = "id") -> DataFrame:
    """``SELECT DISTINCT x FROM (SELECT a FROM t1 UNION ALL SELECT b FROM t2 ...)``.

    Each source is deduplicated map-side before the single shuffle."""
    parts = [df.select(F.col(c).alias(name)) for df, c in sources]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def members(df: DataFrame, on: ColumnOrName, pop: DataFrame, pop_col: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``pop`` (inner join with a distinct set
    is a semi join: no duplication, no columns added). With a filtered ``pop``
    the session's runtime Bloom filter (see ``configure``) already drops most
    non-members at the scan of ``df``; the join then decides exactly."""
    return df.join(pop.select(F.col(pop_col).alias("_mb_key")), col(on) == F.col("_mb_key"), "left_semi")
