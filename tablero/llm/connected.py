"""Connected components of an edge table by alternating large and small stars.

Each round is two groupings with map-side minima and two equi-joins, written
to the shared folder. No component is gathered anywhere: a node only learns
the smallest neighbour it has seen, so a component of any size is spread over
its nodes' partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablero.llm._common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): for each node of an edge (a, b), two columns of one ordered
    type, the smallest node that it is linked with. Self-links and repeated
    links change nothing; null ends are no nodes."""
    now = scratch.cut(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges0")
    seen, step = None, 0
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, step = mark, step + 1
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large = scratch.cut(large, f"large{step}")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = scratch.cut(small.select("e.*").filter("a != b").distinct(), f"edges{step}")
        scratch.drop(f"large{step}")
        scratch.drop(f"edges{step - 1}")
