"""Source divergence audit: how far the term shares of each source of a
language lie from those of its other sources and of the whole language.

Each task adds up, per language, source and term, the occurrences and the
documents of its texts; Spark sums those. A term is kept if enough documents of
its language hold it. Only the sums above zero are rows from there on; what an
absent term adds to a pair is known from the two groups alone.

Shares are whole numbers: ``p = 1 + floor(scale * (count + prior) / (N + prior * V))``
over the V kept terms of the language, N the group's count of them. All
arithmetic is in longs, and in decimals where the product may pass 64 bits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablero.llm._common import Scratch, slices, texts_of

#: Bytes of a UTF-8 text as a term keeps them: A-Z in lower case, what ends a term as a space.
LETTERS = bytes(k + 32 if 65 <= k <= 90 else k if 97 <= k <= 122 or k >= 128 else 32 for k in range(256))
#: Terms that a task holds before it passes its sums on.
HELD = 200_000
#: One document, above any number of occurrences, so that one number holds both sums.
ONE = 1 << 48


def tally(batches: Iterator[pa.RecordBatch], held: int = HELD) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, term, count, docs) from rows (lang, source, text): a
    task's sums, in parts of about ``held`` terms."""
    sums: dict[tuple, dict[bytes, int]] = {}

    def told() -> Iterator[pa.RecordBatch]:
        for (lang, source), own in sums.items():
            n = len(own)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(list(own), pa.binary()),
                     pa.array([v % ONE for v in own.values()], pa.int64()), pa.array([v // ONE for v in own.values()], pa.int64())],
                    ["lang", "source", "term", "count", "docs"])
        sums.clear()

    size = 0
    for batch in batches:
        for part in slices(batch, "text"):
            for lang, source, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts_of(part.column(2))):
                own = sums.setdefault((lang, source), {})
                size -= len(own)
                for term, n in Counter(text.translate(LETTERS).split()).items():
                    own[term] = own.get(term, 0) + n + ONE
                size += len(own)
                if size > held:
                    yield from told()
                    size = 0
    yield from told()


def _share(count: str, total: str, kept: str, scale: int, prior: int) -> Column:
    return F.expr(f"1 + (CAST({scale} AS DECIMAL(19,0)) * CAST({count} + {prior} AS DECIMAL(19,0))) div (CAST({total} AS DECIMAL(19,0)) + {prior} * {kept})")


def counts(docs: DataFrame, scratch: Scratch, text: str, lang: str, source: str, min_docs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, source, at, count) of each group's kept terms above zero,
    (at, lang, term) of the vocabulary, and (lang, source) of all groups."""
    name = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang, source)]
    own = docs.select(name[0].alias("lang"), name[1].alias("source"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    groups = scratch.cut(own.select("lang", "source").distinct(), "groups")
    parts = own.mapInArrow(tally, "lang string, source string, term binary, count long, docs long")
    # dealt by language and term, so that both groupings take one shuffle; a term's list has one entry for each source
    sums = parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    kept = sums.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "count")).alias("sums")).filter(F.col("docs") >= min_docs)
    kept = scratch.cut(kept.select(F.monotonically_increasing_id().alias("at"), "lang", F.col("term").cast("string").alias("term"), "sums"), "vocabulary")
    return kept.select("lang", "at", F.inline("sums")).select("lang", "source", "at", "count"), kept.select("at", "lang", "term"), groups


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 30, top: int = 50,
               scale: int = 10**9, prior: int = 5) -> DataFrame:
    """Rows ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair``: one row for every other source of the group's language, with
    the sum of the absolute differences of their shares over all kept terms.
    Part ``term``: the ``top`` terms that the group has more of than its
    language as a whole, with the difference of the shares. Ranks go by value
    descending, then item ascending.

    Null texts, languages and sources count as empty; rows that repeat count
    each; a language without kept terms has pairs of value 0; an empty table
    gives none. Other columns are not read."""
    scratch = Scratch(docs.sparkSession, "divergence")
    sums, vocabulary, groups = counts(docs, scratch, text, lang, source, min_docs)
    kept = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    total = sums.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    sized = groups.join(kept, "lang", "left").join(total, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("v", F.lit(0)).cast("long").alias("v"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    zero = F.when(F.col("v") > 0, _share("0", "n", "v", scale, prior)).otherwise(0)
    sized = scratch.cut(sized.withColumn("z", zero.cast("long")), "sized")  # z: the share of a term that the group does not have
    cells = sums.join(sized, ["lang", "source"]).select("lang", "source", "at", "z", _share("count", "n", "v", scale, prior).cast("long").alias("p"))
    cells = scratch.cut(cells, "cells")

    a, b = sized.alias("a"), sized.alias("b")
    both_ways = (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source"))
    sides = [F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item")]
    # as if neither had any term
    base = a.join(b, both_ways).select(*sides, (F.col("a.v") * F.abs(F.col("a.z") - F.col("b.z"))).alias("value"))
    # what the terms of one change if the other has none of them; equal shares of a group are one row
    levels = cells.groupBy("lang", "source", "z", "p").agg(F.count(F.lit(1)).alias("terms")).alias("a")
    change = F.col("a.terms") * (F.abs(F.col("a.p") - F.col("b.z")) - F.abs(F.col("a.z") - F.col("b.z")))
    one = levels.join(b, both_ways).select(*sides, change.alias("value"))
    one = one.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    one = one.unionByName(one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    # what the terms of both change
    x, y = cells.alias("a"), cells.alias("b")
    met = x.join(y, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.at") == F.col("b.at")) & (F.col("a.source") < F.col("b.source")))
    change = (F.abs(F.col("a.p") - F.col("b.p")) - F.abs(F.col("a.p") - F.col("b.z")) - F.abs(F.col("a.z") - F.col("b.p"))
              + F.abs(F.col("a.z") - F.col("b.z")))
    met = met.select(*sides, change.alias("value")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    met = met.unionByName(met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = base.unionByName(one).unionByName(met).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    whole = sums.groupBy("lang", "at").agg(F.sum("count").alias("count"))
    of_lang = sized.groupBy("lang").agg(F.sum("n").alias("n"), F.first("v").alias("v"))
    whole = whole.join(of_lang, "lang").select("lang", "at", _share("count", "n", "v", scale, prior).cast("long").alias("q"))
    more = cells.join(whole, ["lang", "at"]).filter("p > q").join(vocabulary, ["lang", "at"])
    more = more.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked.unionByName(more.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
                              .filter(F.col("rank") <= top))
