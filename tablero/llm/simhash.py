"""Near-duplicates by 64-bit SimHash with a Gray-order hierarchical index.

Fingerprints that differ in at most ``radius`` bits are linked. The index is a
forest whose upper nodes are masked bit patterns: of ``radius + 2`` blocks of
the fingerprint, two fingerprints within the radius agree on two at least, so
each fingerprint joins the node of every pair of blocks and no link is lost.
Spark groups the members of a node; inside it they are sorted by Gray rank and
factored further: a node holds the bits on which all its members agree, a child
only those that its parent does not hold. A query adds up its differences on
the way down and leaves a whole group as soon as they exceed the radius.

Equal fingerprints are one member. A node with more members than ``group`` is
split exactly by further blocks of its open bits (one of ``radius + 1`` must
agree), down to 16 open bits, where a node has 65,536 members at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tablero.llm._common import Scratch, fresh, others, text_key
from tablero.llm.connected import components


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned fingerprint of a text: A-Z lower-cased, words apart by ASCII
    white space, shingles of ``shingle`` words with repeats (all words, if there
    are fewer); a bit is 1 if over half the shingles' XXH64 have it. No words: 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    ends = ends[-n:]
    ones = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 17):
        spans = zip(starts[a : min(n, a + (1 << 17))].tolist(), ends[a : a + (1 << 17)].tolist())
        h = np.array([xxhash.xxh64_intdigest(joined[s:e], seed) for s, e in spans], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint(text, shingle: int = 3, seed: int = 42) -> F.Column:
    """The fingerprint as a signed 64-bit column (the same bits)."""

    @pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([simhash(t, shingle, seed) for t in texts], np.uint64).view(np.int64))
    return of(text)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(bits: list[int], n: int) -> list[int]:
    """``bits`` cut into n blocks of about one size, each as a mask."""
    cuts = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of a bit pattern in the Gray sequence."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


def link_groups(fps: np.ndarray, group: np.ndarray, radius: int, fan: int = 8) -> np.ndarray:
    """For each fingerprint (uint64, apart within a group; groups consecutive),
    the index of the first member of its group that it is linked with, directly
    or over others."""
    n = len(fps)
    by = np.lexsort((gray_rank(fps), group))
    fps, group = fps[by], group[by]
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(first, n))
    of = np.repeat(np.arange(len(first)), size)
    widths = [1]
    while widths[-1] < size.max():
        widths.append(widths[-1] * fan)
    levels = []  # from the members up: start, agreed bits, their pattern, first child
    for width in widths:
        per = -(-size // width)
        begin = np.concatenate(([0], np.cumsum(per)))
        start = np.repeat(first, per) + (np.arange(begin[-1]) - np.repeat(begin[:-1], per)) * width
        common, any_ = np.bitwise_and.reduceat(fps, start), np.bitwise_or.reduceat(fps, start)
        levels.append({"begin": begin, "per": per, "end": np.minimum(start + width, np.repeat(first + size, per)),
                       "agreed": ~(common ^ any_), "pattern": common, "group": np.repeat(np.arange(len(first)), per),
                       "place": np.arange(begin[-1]) - np.repeat(begin[:-1], per)})
    enters = np.searchsorted(widths, size)[of]  # the level at which a group is one node
    label = np.arange(n)
    cost = np.cumsum(size[of])
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(cost, (cost[a - 1] if a else 0) + (1 << 20), side="right")))
        query = node = np.zeros(0, np.int64)
        held, differ = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for depth in range(len(widths) - 1, -1, -1):
            level = levels[depth]
            if len(query):  # to the children of the nodes above
                above = levels[depth + 1]
                g, place = above["group"][node], above["place"][node] * fan
                count = np.minimum(fan, level["per"][g] - place)
                at = np.repeat(level["begin"][g] + place - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                query, held, differ, node = np.repeat(query, count), np.repeat(held, count), np.repeat(differ, count), at
            new = a + np.flatnonzero(enters[a:b] == depth)
            query, node = np.concatenate((query, new)), np.concatenate((node, level["begin"][of[new]]))
            held, differ = np.concatenate((held, np.zeros(len(new), np.uint64))), np.concatenate((differ, np.zeros(len(new), np.int64)))
            own = level["agreed"][node]
            differ = differ + np.bitwise_count((fps[query] ^ level["pattern"][node]) & own & ~held)
            keep = (differ <= radius) & (level["end"][node] > query + 1)  # later members only
            query, node, held, differ = query[keep], node[keep], own[keep], differ[keep]
        keep = node > query
        _union(label, query[keep], node[keep])
        a = b
    out = np.empty(n, np.int64)
    out[by] = by[label]
    return out


def _union(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Merge the classes of x[i] and y[i]; labels are each class's first index."""
    while True:
        a, b = label[x], label[y]
        apart = a != b
        if not apart.any():
            return
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            jump = label[label]
            if (jump == label).all():
                break
            label[:] = jump


def _search(radius: int, most: int = 1 << 16):
    """Rows (mask, pattern, fp) sorted by node: gives each fingerprint's link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def links(t: np.ndarray) -> pa.RecordBatch:
            group = np.cumsum(np.concatenate(([True], (t[0, 1:] != t[0, :-1]) | (t[1, 1:] != t[1, :-1]))))
            root = link_groups(t[2].view(np.uint64), group, radius)
            far = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(t[2, far]), pa.array(t[2, root[far]])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([batch.column(i).to_numpy() for i in range(3)]))
            rows += batch.num_rows
            if rows >= most:
                t = np.concatenate(held, axis=1)
                change = np.flatnonzero((t[0, 1:] != t[0, :-1]) | (t[1, 1:] != t[1, :-1]))
                held, rows = [t], t.shape[1]
                if len(change):  # the last node may go on in the next batch
                    cut = change[-1] + 1
                    yield links(t[:, :cut])
                    held, rows = [t[:, cut:]], t.shape[1] - cut
        if rows:
            yield links(np.concatenate(held, axis=1))
    return run


def linked(fps: DataFrame, radius: int, scratch: Scratch, group: int = 4096) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` (signed long) that
    join every pair within ``radius`` bits, directly or over others."""
    masks = {x | y for x, y in combinations(_blocks(list(range(64)), radius + 2), 2)}
    nodes = fps.select("fp", F.explode(F.array(*(F.lit(_signed(m)) for m in sorted(masks)))).alias("mask"))
    found, step = None, 0
    while True:
        nodes = nodes.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = scratch.cut(nodes.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), f"nodes{step}")
        bounded = min(m.bit_count() for m in masks) >= 48
        fits = nodes.join(sizes if bounded else sizes.filter(F.col("n") <= group), ["mask", "pattern"]).select("mask", "pattern", "fp")
        links = fits.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern").mapInArrow(_search(radius), "a long, b long")
        found = links if found is None else found.unionByName(links)
        large = sizes.filter(F.col("n") > group)
        if bounded or large.isEmpty():
            return found.distinct()
        below = {m: [m | part for part in _blocks([b for b in range(64) if not m >> b & 1], radius + 1)] for m in masks}
        masks = {m for lower in below.values() for m in lower}
        to = F.create_map(*(x for m, lower in sorted(below.items()) for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(v)) for v in lower)))))
        nodes = nodes.join(large, ["mask", "pattern"]).select("fp", F.explode(F.element_at(to, F.col("mask"))).alias("mask")).distinct()
        nodes, step = scratch.cut(nodes, f"lower{step}"), step + 1


def clusters(fps: DataFrame, radius: int, scratch: Scratch, **how) -> DataFrame:
    """(fp, root) for each distinct fingerprint: the smallest one it is linked with."""
    distinct = scratch.cut(fps.select("fp").distinct(), "distinct")
    roots = components(linked(distinct, radius, scratch, **how), scratch)
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, **how) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (signed long) and
    ``component_id``, the smallest id that it is linked with (null ids count
    only where a component has no other). Null texts and texts without words
    have the fingerprint zero and link with each other."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.cut(docs.select(F.col(doc_id).alias("id"), fingerprint(F.col(text), shingle).alias("fp")), "rows")
    least = rows.groupBy("fp").agg(F.min("id").alias("least"))
    of = clusters(rows, radius, scratch, **how).join(least, "fp")
    smallest = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = scratch.cut(of.join(smallest, "root").select("fp", "component_id"), "components")  # the join below may then split frequent prints
    return rows.join(of, "fp").select(F.col("id").alias(doc_id), F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, **how) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (null first),
    then the smallest text digest; of rows equal in both, any one."""
    scratch = Scratch(docs.sparkSession, "simhash")
    key = fresh(docs.columns, "tk")
    rows = scratch.cut(docs.select(F.col(doc_id).alias("id"), text_key(F.col(text)).alias("tk"),
                                   fingerprint(F.col(text), shingle).alias("fp")), "rows")
    least = rows.groupBy("fp", "id", "tk").agg(F.count(F.lit(1)).alias("n")).groupBy("fp").agg(F.min(F.struct("id", "tk", "n")).alias("least"))
    picks = clusters(rows, radius, scratch, **how).join(least, "fp").groupBy("root").agg(F.min("least").alias("pick"))
    picks = scratch.cut(picks.select("pick.*"), "picks")

    def chosen(p: DataFrame) -> DataFrame:
        own = docs.withColumn(key, text_key(F.col(text))).alias("d")
        return own.join(p.alias("p"), F.col(f"d.{key}").eqNullSafe(F.col("p.tk")) & F.col(f"d.`{doc_id}`").eqNullSafe(F.col("p.id")), "left_semi")
    kept = chosen(picks.filter("n = 1"))
    if not picks.filter("n > 1").isEmpty():
        kept = kept.unionByName(chosen(picks.filter("n > 1")).dropDuplicates([doc_id, key]))
    return kept.select(*others(docs.columns))
