"""Mixing sources to target weights by prefix sums over hash-random keys.

Each row has a key that its id alone decides. Rows are sorted by key inside
their source: ranges of the key space form buckets, bucket sums are added up
per source, and a row's place is its bucket's offset plus the running sum
inside the bucket. A source's budget is cut at exactly that word: whole epochs
first, then the rows before the cut, the last of them in part.

No window runs over a whole source: a bucket holds about ``bucket_rows`` rows,
and offsets are summed over buckets. Targets take one row per source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablero.llm._common import WORD, fresh, others


def n_words(text) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, source: str, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """One row per source (null included, last) from rows (source, source_size):
    weights in turn by code point, ``share`` of all sizes handed out by weight,
    no source above ``epochs`` times its size, what is above handed on.

    In order of size per weight, the level at which the sources from here on
    share what the earlier ones leave is largest at the first that it does not
    fill; every source gets the smaller of its limit and weight times level."""
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long"))
    rows = rows.withColumn("most", F.col("source_size") * F.lit(epochs))
    before = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col(source).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return rows.select(source, "source_size", F.least("most", F.col("weight") * F.col("level")).alias("target"))


def mix(rows: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "size", salt: str = "mix",
        bucket_rows: int = 5000, **shares) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` (of the row's source) and
    ``taken``: how much of the row's ``size`` the mix takes, repeats counted.

    Rows of equal id (null included) are ordered by size; rows equal in both
    have one order up to their exchange. A row of size 0 takes nothing. Columns
    called like the three, in any case, are replaced; others travel along.
    """
    own = others(rows.columns, "source_size", "target", "taken")
    name = {c: fresh(rows.columns, c) for c in ("key", "bucket", "is_null", "named", "offset", "before", "total", "goal")}
    key, bucket, is_null, named = (F.col(name[c]) for c in ("key", "bucket", "is_null", "named"))
    keyed = rows.withColumns({
        name["key"]: F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(salt))),
        name["is_null"]: F.col(source).isNull(), name["named"]: F.coalesce(F.col(source).cast("string"), F.lit(""))})
    per_source = keyed.groupBy(source, name["is_null"], name["named"]).agg(F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("rows"))
    n = per_source.agg(F.sum("rows")).first()[0] or 0
    digits = min(12, max(0, math.ceil(math.log(max(n, 1) / bucket_rows, 16))))
    keyed = keyed.withColumn(name["bucket"], F.substring(name["key"], 1, digits) if digits else F.lit(""))
    goal = targets(per_source.select(source, "source_size"), source, **shares)
    goal = goal.select(F.col(source).isNull().alias(name["is_null"]), F.coalesce(F.col(source).cast("string"), F.lit("")).alias(name["named"]),
                       F.col("source_size").alias(name["total"]), F.col("target").alias(name["goal"]))
    sums = keyed.groupBy(name["is_null"], name["named"], name["bucket"]).agg(F.sum(size).alias("n"))
    earlier = Window.partitionBy(is_null, named).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(is_null, named, bucket, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(name["offset"]))
    offsets = offsets.join(goal, [name["is_null"], name["named"]])
    inside = Window.partitionBy(is_null, named, bucket).orderBy(key, F.col(doc_id), F.col(size)).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.join(offsets, [name["is_null"], name["named"], name["bucket"]]).withColumn(
        name["before"], F.col(name["offset"]) + F.coalesce(F.sum(size).over(inside), F.lit(0)))
    total, aim = F.col(name["total"]), F.round(F.col(name["goal"])).cast("long")
    whole = F.when(total > 0, F.floor(aim / F.greatest(total, F.lit(1)))).otherwise(0)
    rest = aim - whole * total - F.col(name["before"])
    part = F.greatest(F.lit(0), F.least(F.col(size), rest))
    return placed.select(*own, total.alias("source_size"), F.col(name["goal"]).alias("target"), (whole * F.col(size) + part).cast("long").alias("taken"))
