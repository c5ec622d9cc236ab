"""Removal of long repeated byte strings with a run-length index.

A byte is removed when a string of ``length`` bytes that covers it starts
anywhere else as well, in the same document or another one. The work is
split so that equal strings meet without moving the corpus:

1. Every window of ``length`` bytes names one *anchor*: the ``anchor``-byte
   string with the smallest hash inside it. Equal windows name equal anchors.
   The windows of one anchor occurrence are consecutive; the text that they
   cover is its *context*.
2. Anchors seen once in the corpus end here. Contexts that are equal as a
   whole are counted by digest; all their windows are repeated.
3. The other contexts of an anchor are indexed together, in blocks of whole
   anchor groups: suffix order, run-compressed Burrows-Wheeler transform, and
   text positions sampled at both ends of each run. Between two samples the
   length of the match with the neighbouring suffix falls by one per byte, so
   the samples alone give the matching statistics of every byte against the
   rest of the block, streamed in text order. Matches of ``length`` are marked.
4. An anchor group too large for a block is split exactly, by cutting the
   window ranges into ever narrower bins, counted from the anchor, and grouping
   by the bytes that all windows of a bin share, until the groups fit. A bin of
   one window needs no index.

Null texts count as empty; texts shorter than ``length`` are never touched;
rows with equal texts are separate occurrences and have equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablero.llm._common import Scratch, fresh, others, slices, text_key, texts_of

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOW = np.uint64(1023)


def _digest(b: bytes) -> bytes:
    return hashlib.blake2b(b, digest_size=16).digest()


def window_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k-byte string (polynomial, then mixed)."""
    n = len(data)
    up, down = np.full(n, _BASE), np.full(n, _BASE_INVERSE)
    up[:1] = down[:1] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down, out=sums[1:])
    h = (sums[k:] - sums[:-k]) * up[: n - k + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def find_anchors(texts: list[bytes], length: int, k: int):
    """Runs of windows that name the same anchor, over texts of ``length`` bytes
    or more: (anchor hash, index of the text, place of the anchor, first start, last
    start), places counted in the joined texts."""
    w = length - k + 1
    assert 1 < w <= 512, "the anchor must be shorter than the match, by 511 bytes at most"
    data = np.frombuffer(b"".join(texts), np.uint8)
    h = window_hashes(data, k)
    m = len(h)
    rows = -(-m // w)
    padded = np.full(rows * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:m] = h & ~_LOW
    padded = padded.reshape(rows, w) | np.arange(w, dtype=np.uint64)  # the smallest hash, and where in its row
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = m - w + 1
    start = np.arange(n)
    left, right = behind[:n], ahead[w - 1 : w - 1 + n]
    take_left = (left & ~_LOW) <= (right & ~_LOW)  # of equal hashes the leftmost, so the bytes alone decide
    at = np.where(take_left, start, start + w - 1) // w * w + (np.where(take_left, left, right) & _LOW).astype(np.int64)
    ends = np.cumsum([len(t) for t in texts])
    text = np.searchsorted(ends, start, side="right")
    whole = np.flatnonzero(start + length <= ends[text])
    at, text = at[whole], text[whole]
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1]))))
    last = np.concatenate((first[1:] - 1, [len(whole) - 1]))
    return h[at[first]].view(np.int64), text[first], at[first], whole[first], whole[last]


ANCHORS = "g long, cx binary, tk binary, at int, lo int, hi int"
_ANCHORS = pa.schema([("g", pa.int64()), ("cx", pa.binary()), ("tk", pa.binary()), ("at", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])


def _anchor_rows(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts, keys = [], []
                for t, key in zip(texts_of(part.column(0)), part.column(1).to_pylist()):
                    if len(t) >= length and key not in seen:
                        seen.add(key)
                        texts.append(t)
                        keys.append(key)
                if not texts:
                    continue
                g, text, at, lo, hi = find_anchors(texts, length, k)
                joined = b"".join(texts)
                begin = np.cumsum([0, *(len(t) for t in texts)])[text]
                cx = [_digest(joined[a : b + length]) for a, b in zip(lo.tolist(), hi.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g), pa.array(cx, pa.binary()), pa.array([keys[i] for i in text.tolist()], pa.binary()),
                     *(pa.array((x - begin).astype(np.int32)) for x in (at, lo, hi))], schema=_ANCHORS)
    return run


def suffix_order(t: np.ndarray) -> np.ndarray:
    """Suffix array of symbols 0..256 by prefix doubling; only suffixes that are
    still equal are sorted again."""
    n = len(t)
    padded = np.zeros(n + 7, np.uint64)
    padded[:n] = t + np.int16(1)  # the end is below every symbol
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = (key << np.uint64(9)) | padded[j : j + n]
    order = np.argsort(key)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # the end sorts before every symbol

    def head(keys: np.ndarray) -> np.ndarray:
        return np.concatenate(([True], keys[1:] != keys[:-1]))

    new = head(key[order])
    slot = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(new, slot, 0))
    step = 7
    open_ = slot[~(new & np.concatenate((new[1:], [True])))]  # rows whose group has other rows
    while len(open_):
        if step >= n:  # only a suffix that runs out can be left; its end decides
            step = n
        suffix = order[open_]
        group = rank[suffix]
        after = rank[np.minimum(suffix + step, n)] + 1
        by = np.argsort((group << np.int64(32)) | after, kind="stable")
        suffix, group, after = suffix[by], group[by], after[by]
        order[open_] = suffix
        new = head((group << np.int64(32)) | after)
        rank[suffix] = np.maximum.accumulate(np.where(new, open_, 0))
        open_ = open_[~(new & np.concatenate((new[1:], [True])))]
        step *= 2
    return order


def common_prefixes(t: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes a and b, for each pair."""
    n, width = len(t), 16
    end = np.concatenate((t, np.full(width, -1, t.dtype)))
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    span = np.arange(width)
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        differ = end[np.minimum(x, n)[:, None] + span] != end[np.minimum(y, n)[:, None] + span]
        differ |= (np.maximum(x, y)[:, None] + span) >= n
        got = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        out[live] += got
        live = live[got == width]
    return out


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of a text with the text
    positions at both ends of each run, and their match lengths with the
    suffix before (at a run's head) or after it (at a run's end)."""

    def __init__(self, t: np.ndarray):
        order = suffix_order(t)
        bwt = np.where(order > 0, t[order - 1], -1)
        change = bwt[1:] != bwt[:-1]
        heads, ends = np.flatnonzero(change) + 1, np.flatnonzero(change)
        shared = common_prefixes(t, order[heads], order[ends])
        self.n, self.symbols = len(t), bwt[np.concatenate(([0], heads))]
        self.starts = np.concatenate(([0], heads))
        self.before = self._sampled(order[heads], shared, order[0])
        self.after = self._sampled(order[ends], shared, order[-1])

    @staticmethod
    def _sampled(position: np.ndarray, length: np.ndarray, outer: int):
        """The outermost suffix has no neighbour on that side: a match of none."""
        position, length = np.append(position, outer), np.append(length, 0)
        by = np.argsort(position)
        return position[by], length[by]

    def matching_statistics(self) -> np.ndarray:
        """For each position, how far its suffix agrees with any other one."""
        at, best = np.arange(self.n), np.zeros(self.n, np.int64)
        for position, length in (self.before, self.after):
            near = np.searchsorted(position, at, side="right") - 1
            known = near >= 0
            reach = np.where(known, length[near] - (at - position[near]), 0)
            best = np.maximum(best, reach)
        return best


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context, the starts of its ``length``-byte strings that start
    anywhere else in the contexts as well."""
    parts, begins, n = [], [], 0
    for c in contexts:
        begins.append(n)
        parts += [np.frombuffer(c, np.uint8).astype(np.int16) + 1, np.zeros(1, np.int16)]
        n += len(c) + 1
    long = RunIndex(np.concatenate(parts)).matching_statistics() >= length
    return [np.flatnonzero(long[b : b + len(c) - length + 1]) for b, c in zip(begins, contexts)]


MARKS = "tk binary, lo int, hi int"
_MARKS = pa.schema([("tk", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32())])


def _index_blocks(length: int, block: int):
    """Rows sorted by (g, cx): whole anchor groups are gathered up to ``block``
    bytes and indexed; gives runs of repeated starts (lo, hi inclusive)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def marks():
            keys, los, his = [], [], []
            for (tk, lo, _), starts in zip(held, repeated_starts([h[2] for h in held], length)):
                if len(starts):
                    cut = np.flatnonzero(np.diff(starts) > 1)
                    for a, b in zip(starts[np.concatenate(([0], cut + 1))].tolist(), starts[np.append(cut, len(starts) - 1)].tolist()):
                        keys.append(tk)
                        los.append(lo + a)
                        his.append(lo + b)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(los, pa.int32()), pa.array(his, pa.int32())], schema=_MARKS)

        for batch in batches:
            for g, cx, tk, lo, piece in zip(*(batch.column(c).to_pylist() for c in ("g", "cx", "tk", "lo", "piece"))):
                if (g, cx) == last:  # the same context from another copy of its text
                    continue
                if held and size >= block and g != last[0]:
                    yield marks()
                    held, size = [], 0
                held.append((tk, lo, piece))
                size += len(piece)
                last = (g, cx)
        if held:
            yield marks()
    return run


PIECES = "g long, cx binary, tk binary, at int, lo int, hi int, n long, piece binary"
_PIECES = pa.schema([("g", pa.int64()), ("cx", pa.binary()), ("tk", pa.binary()), ("at", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()),
                     ("n", pa.int64()), ("piece", pa.binary())])


def _cut_pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                rows = [[] for _ in _PIECES]
                for t, tk, wanted in zip(texts_of(part.column(0)), part.column(1).to_pylist(), part.column(2).to_pylist()):
                    for r in wanted:
                        for to, v in zip(rows, (r["g"], r["cx"], tk, r["at"], r["lo"], r["hi"], r["n"], t[r["lo"] : r["hi"] + length])):
                            to.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, _PIECES)], schema=_PIECES)
    return run


def _split(length: int, w: int, width: int):
    """Each range of starts cut into bins of ``width`` starts, counted from the
    anchor, and grouped by the bytes that all windows of a bin share. In a bin
    of one window those are the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[] for _ in _PIECES]
            for g, tk, at, lo, hi, piece in zip(*(batch.column(c).to_pylist() for c in ("g", "tk", "at", "lo", "hi", "piece"))):
                zero = at - w + 1  # the first start whose window can name this anchor
                for bin_ in range((lo - zero) // width, (hi - zero) // width + 1):
                    first = zero + bin_ * width
                    a, b = max(lo, first), min(hi, first + width - 1)
                    sub = piece[a - lo : b - lo + length]
                    core = piece[first + width - 1 - lo : first + length - lo]
                    key = hashlib.blake2b(core, digest_size=8, key=b"%d %d" % (g, bin_)).digest()
                    for to, v in zip(rows, (int.from_bytes(key, "little", signed=True), _digest(sub), tk, at, a, b, 0, sub)):
                        to.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, _PIECES)], schema=_PIECES)
    return run


SPANS = "tk binary, spans array<struct<start:int,end:int>>, kept binary"
_SPANS = pa.schema([("tk", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary())])


def _cut_spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                spans, kept = [], []
                for t, marks in zip(texts_of(part.column(1)), part.column(2).to_pylist()):
                    runs: list[dict] = []
                    for lo, hi in sorted((m["lo"], m["hi"] + length) for m in marks):
                        if runs and lo <= runs[-1]["end"]:
                            runs[-1]["end"] = max(hi, runs[-1]["end"])
                        else:
                            runs.append({"start": lo, "end": hi})
                    at = [0, *(x for r in runs for x in (r["start"], r["end"])), len(t)]
                    spans.append(runs)
                    kept.append(b"".join(t[a:b] for a, b in zip(at[::2], at[1::2])))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, _SPANS.field(1).type), pa.array(kept, pa.binary())], schema=_SPANS)
    return run


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies of a text that meet in a task go on as one."""
    seen: set[bytes] = set()
    for batch in batches:
        first = []
        for key in batch.column(1).to_pylist():
            first.append(key not in seen)
            seen.add(key)
        yield batch.filter(pa.array(first, pa.bool_()))


def repeated_spans(docs: DataFrame, text: str = "text", length: int = 400, anchor: int | None = None, group: int = 2048,
                   block: int = 1 << 19) -> DataFrame:
    """(tk, spans, kept) of each distinct text that loses bytes: its 128-bit key
    (``text_key``), the removed byte spans (end exclusive, ascending, apart) and
    the bytes that stay.

    ``anchor``: bytes of an anchor, about a third of ``length`` if not given.
    ``group``: contexts of one anchor that a block may index; larger groups are
    split first. ``block``: bytes of text gathered into one index at least.
    """
    spark = docs.sparkSession
    k = anchor or max(1, length // 3, length - 511)
    scratch = Scratch(spark, "repeats")
    texts = docs.select(F.col(text).alias("text"), text_key(F.col(text)).alias("tk"))
    size = F.octet_length(F.coalesce(F.col("text"), F.lit("")))

    anchors = scratch.cut(texts.filter(size >= length).mapInArrow(_anchor_rows(length, k), ANCHORS), "anchors")
    place = F.xxhash64("tk", "lo")
    seen_twice = anchors.groupBy("g").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a < b").select("g")
    seen_twice = scratch.cut(seen_twice, "seen_twice")  # so that the join below may split a frequent anchor
    shared = scratch.cut(anchors.join(seen_twice, "g", "left_semi"), "shared")
    scratch.drop("anchors")

    contexts = shared.groupBy("g", "cx").agg(F.min(place).alias("a"), F.max(place).alias("b"),
                                             F.min_by(F.struct("tk", "at", "lo", "hi"), place).alias("at"))
    contexts = scratch.cut(contexts, "contexts")
    several = contexts.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    wanted = (contexts.join(several, "g").select("at.tk", F.struct("g", "cx", "at.at", "at.lo", "at.hi", "n").alias("w"))
              .groupBy("tk").agg(F.collect_list("w").alias("wanted")))  # at most a text's own anchors
    keys = shared.select("tk").distinct().join(wanted, "tk", "left")
    found = texts.filter(size >= length).join(keys, "tk").select("text", "tk", "wanted")
    affected = scratch.cut(found.mapInArrow(_once, found.schema), "affected")
    pieces = affected.filter("wanted is not null").mapInArrow(_cut_pieces(length), PIECES)

    def indexed(p: DataFrame) -> DataFrame:
        return p.repartition("g").sortWithinPartitions("g", "cx").mapInArrow(_index_blocks(length, block), MARKS)

    # written, so that a small table is broadcast before the rows of a frequent context are shuffled to one task, a large one split
    twice = scratch.cut(contexts.filter("a < b").select("g", "cx"), "twice")
    marks = [shared.join(twice, ["g", "cx"]).select("tk", "lo", "hi"),
             indexed(pieces.filter(F.col("n") <= group))]
    w = length - k + 1
    hot, level, width = pieces.filter(F.col("n") > group), 0, w
    if not several.filter(F.col("n") > group).isEmpty():
        while True:
            width = -(-width // 2)
            halves = scratch.cut(hot.mapInArrow(_split(length, w, width), PIECES), f"halves{level}")
            same = halves.groupBy("g", "cx").agg(F.min(place).alias("a"), F.max(place).alias("b"),
                                                 F.min_by(F.struct("tk", "at", "lo", "hi", "piece"), place).alias("at"))
            same = scratch.cut(same, f"same{level}")
            twice = scratch.cut(same.filter("a < b").select("g", "cx"), f"twice{level}")
            marks.append(halves.join(twice, ["g", "cx"]).select("tk", "lo", "hi"))
            count = same.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            rest = scratch.cut(same.join(count, "g").select("g", "cx", "at.tk", "at.at", "at.lo", "at.hi", "n", "at.piece"), f"rest{level}")
            marks.append(indexed(rest.filter(F.col("n") <= group)))
            hot, level = rest.filter(F.col("n") > group), level + 1
            if hot.isEmpty():
                break
    all_marks = marks[0]
    for m in marks[1:]:
        all_marks = all_marks.unionByName(m)
    per_text = all_marks.groupBy("tk").agg(F.collect_set(F.struct("lo", "hi")).alias("marks"))  # within the text's length
    cut = affected.select("tk", "text").join(per_text, "tk").select("tk", "text", "marks").mapInArrow(_cut_spans(length), SPANS)
    copies = texts.filter(size >= length).groupBy("tk").agg(F.count(F.lit(1)).alias("rows"), F.first(size).cast("int").alias("n")).filter("rows > 1")
    whole = copies.select("tk", F.array(F.struct(F.lit(0).alias("start"), F.col("n").alias("end"))).alias("spans"), F.lit(b"").alias("kept"))
    # written, so that a join with the documents may split the rows of a frequent text
    return scratch.cut(cut.dropDuplicates(["tk"]).join(copies.select("tk"), "tk", "left_anti").unionByName(whole), "spans")


def removed_bytes(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])


def remove_repeats(docs: DataFrame, text: str = "text", length: int = 400, **how) -> DataFrame:
    """``docs`` with the columns ``n_bytes``, ``n_removed``, ``spans`` and ``kept``
    (binary: a cut may fall inside a character) in place of the text. Columns of
    these names, in any case, are replaced; others travel along."""
    key = fresh(docs.columns, "tk")
    found = repeated_spans(docs, text, length, **how).select(F.col("tk").alias(key), F.struct("spans", "kept").alias(fresh(docs.columns, "cut")))
    cut = found.columns[1]
    value = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn(key, text_key(F.col(text))).join(found, key, "left")
    spans = F.coalesce(F.col(f"{cut}.spans"), F.array().cast("array<struct<start:int,end:int>>"))
    own = others(docs.columns, text, "n_bytes", "n_removed", "spans", "kept")
    return out.select(*own, F.octet_length(value).cast("long").alias("n_bytes"), removed_bytes(spans).alias("n_removed"),
                      spans.alias("spans"), F.coalesce(F.col(f"{cut}.kept"), F.encode(value, "utf-8")).alias("kept"))
