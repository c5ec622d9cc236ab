"""Benchmark decontamination: SimHash over item-sized windows, multi-index
Hamming blocks, and an exact weighted similarity. DataFrame operations only.

Texts are words of letters and digits in lower case; shingles are ``shingle``
words, of a shorter item all its words. Windows are as long as an item. A
window that does not start with a shingle of an item is never more like it than
the next window, which drops that shingle and takes one more, so only windows
that start with an item's shingle, and the last one of a text, are looked at;
and only those that hold enough shingles of items to reach the similarity (8 of
9 for 0.8), counted in the sorted places of such shingles. They are
fingerprinted, each once per text. Fingerprints of windows and items are cut into ``blocks`` blocks; within
``radius`` bits one block differs in ``radius // blocks`` bits at most, so
items are entered under every such variant of each block and equal blocks find
all pairs within the radius. Each pair found is verified by the weighted Jaccard
similarity of its shingle counts.

Null texts count as empty; items without words find nothing; rows with equal
texts are worked on once and reported each. Inside, an item is known by a digest
of its words: item ids may be null or repeated, and are joined on at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablero.llm._common import Scratch, fresh, text_key

#: Rows of item shingles (16 bytes and an id each) up to which they are broadcast to the scan.
MOST_BROADCAST = 1 << 20


def words(text: Column) -> Column:
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(split, lambda w: w != "")


def _hashes(w: Column, k: int) -> Column:
    """Hashes of the k-word shingles of an array of words."""
    starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.xxhash64(x, *(F.get(w, i + j) for j in range(1, k))))


def _shingles(w: Column, k: Column) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - k + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.array_join(F.slice(w, i, k), " "))


def _fingerprints(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash of each key from rows (keys, s, c): a bit is 1 if over half the weight has it."""
    h = F.xxhash64("s")
    sums = [F.sum(F.getbit(h, F.lit(b)).cast("long") * F.col("c")).alias(f"b{b}") for b in range(64)]
    counted = shingles.groupBy(*keys).agg(F.sum("c").alias("weight"), *sums)
    bits = [F.shiftleft((2 * F.col(f"b{b}") > F.col("weight")).cast("long"), b) for b in range(64)]
    fp = bits[0]
    for b in bits[1:]:
        fp = fp.bitwiseOR(b)
    return counted.select(*keys, "weight", fp.alias("fp"))


def _blocks(fp: Column, blocks: int) -> tuple[Column, int]:
    """The blocks of a fingerprint as an array of (place, value), and a block's bits."""
    width = 64 // blocks
    return F.array(*(F.struct(F.lit(b).alias("place"), F.shiftrightunsigned(fp, b * width).bitwiseAND((1 << width) - 1).alias("value"))
                     for b in range(blocks))), width


def _item_key(w: Column) -> Column:
    """128-bit digest of an array of words; no word holds a space."""
    return text_key(F.array_join(w, " "))


def _windows(texts: DataFrame, item: DataFrame, lengths: list[int], similarity: float) -> DataFrame:
    """(tk, n, start) of the windows that may reach ``similarity`` with an item
    of ``n`` words; of any item's best windows at least one is among them.

    ``texts`` (tk, w) are split and hashed once for all shingle lengths."""
    if not lengths:
        return texts.select("tk", F.lit(0).alias("n"), F.lit(0).alias("start")).limit(0)
    known = item.select("k", "n", F.explode(F.concat(*(F.when(F.col("k") == k, _hashes(F.col("w"), k)).otherwise(F.array().cast("array<bigint>"))
                                                       for k in lengths))).alias("h"))
    known = known.groupBy("k", "h").agg(F.collect_set("n").alias("ns"))  # at most the items' different lengths
    if known.count() <= MOST_BROADCAST:
        known = F.broadcast(known)

    def placed(k: int) -> Column:
        return F.transform(_hashes(F.col("w"), k), lambda h, i: F.struct(F.lit(k).alias("k"), i.alias("pos"), h.alias("h")))
    places = F.concat(*map(placed, lengths))
    hits = texts.select("tk", F.size("w").alias("total"), F.inline(places)).join(known, ["k", "h"])
    hits = hits.select("tk", "total", "k", F.explode("ns").alias("n"), "pos")
    # places of shingles that items of n words have: no more than the text has words
    held = hits.groupBy("tk", "n", "k").agg(F.first("total").alias("total"), F.array_sort(F.collect_set("pos")).alias("at"))
    last, size = F.col("total") - F.col("n"), F.size("at")
    theirs, ours = F.col("n") - F.col("k") + 1, F.least("n", "total") - F.col("k") + 1
    held = held.withColumn("least", F.ceil(F.lit(similarity / (1 + similarity)) * (theirs + ours) - 1e-9).cast("int"))
    held = held.withColumns({"last": last, "span": theirs - 1}).filter(size >= F.col("least"))
    inside = F.filter("at", lambda p, i: (p <= F.col("last")) & (F.get("at", i + F.col("least") - 1) <= p + F.col("span")))
    at_end = F.when(F.get("at", size - F.col("least")) >= F.col("last"), F.array("last")).otherwise(F.array().cast("array<int>"))
    starts = F.when(F.col("last") < 0, F.array(F.lit(0))).otherwise(F.array_union(inside, at_end))
    return held.select("tk", "n", F.explode(starts).alias("start"))


def _alike(docs: DataFrame, items: DataFrame, text: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = 19,
           blocks: int = 4) -> DataFrame:
    """One row for each text key of ``docs`` and item key alike: ``tk``, ``item``,
    ``similarity``, ``start_word`` and ``n_words``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    item = items.select(words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    item = item.withColumns({"item": _item_key(F.col("w")), "n": F.size("w"), "k": F.least(F.size("w"), F.lit(shingle))})
    item = scratch.cut(item.dropDuplicates(["item"]), "items")
    lengths = sorted(r.k for r in item.select("k").distinct().collect())  # at most ``shingle`` numbers
    raw = docs.select(text_key(F.col(text)).alias("tk"), F.col(text).alias("raw"))
    texts = raw.select("tk", words(F.col("raw")).alias("w"))

    wins = scratch.cut(_windows(texts, item, lengths, similarity).groupBy("tk").agg(
        F.collect_list(F.struct("n", "start")).alias("wins")), "windows")  # within a text's length

    cut = raw.join(wins, "tk").select("tk", words(F.col("raw")).alias("w"), F.explode("wins").alias("win"))
    cut = cut.select("tk", "win.n", "win.start", F.slice("w", F.col("win.start") + 1, F.col("win.n")).alias("w"))
    cut = scratch.cut(cut, "window_words").dropDuplicates(["tk", "n", "start"])  # written first, so that the join may split frequent texts
    key = ["tk", "n", "start"]
    own = cut.select(*key, F.explode(_shingles(F.col("w"), F.least(F.col("n"), F.lit(shingle)))).alias("s"))
    own = scratch.cut(own.groupBy(*key, "s").agg(F.count(F.lit(1)).alias("c")), "window_shingles")
    theirs = item.select("item", "n", F.explode(_shingles(F.col("w"), F.col("k"))).alias("s"))
    theirs = scratch.cut(theirs.groupBy("item", "n", "s").agg(F.count(F.lit(1)).alias("c")), "item_shingles")

    prints = scratch.cut(_fingerprints(own, key), "prints")
    of_items = _fingerprints(theirs, ["item", "n"])
    mine, width = _blocks(F.col("fp"), blocks)
    near = F.filter(F.sequence(F.lit(0), F.lit((1 << width) - 1)), lambda x: F.bit_count(x) <= radius // blocks)
    # thousands of variants for each item: shared out before they are made
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entered = of_items.repartition(many, "item").select("item", "n", F.col("fp").alias("item_fp"), F.explode(mine).alias("b"))
    entered = entered.select("item", "n", "item_fp", "b.place", "b.value", F.explode(near).alias("flip"))
    entered = entered.select("item", "n", "item_fp", "place", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    probes = prints.select(*key, "fp", F.explode(mine).alias("b")).select(*key, "fp", "b.place", "b.value")
    # the variants are many more rows than Spark expects of the items: never broadcast
    pairs = probes.join(entered.hint("merge"), ["n", "place", "value"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    pairs = pairs.select(*key, "item").distinct()

    shared = (pairs.join(own, key).join(theirs.select("item", "s", F.col("c").alias("d")), ["item", "s"])
              .groupBy(*key, "item").agg(F.sum(F.least("c", "d")).alias("both")))
    weight = theirs.groupBy("item").agg(F.sum("c").alias("item_weight"))
    alike = shared.join(prints.select(*key, "weight"), key).join(weight, "item").withColumn(
        "similarity", F.col("both") / (F.col("weight") + F.col("item_weight") - F.col("both"))).filter(F.col("similarity") >= similarity)
    best = alike.groupBy("tk", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n")).alias("best"))
    return scratch.cut(best.select("tk", "item", "best.similarity", (-F.col("best.back")).cast("long").alias("start_word"),
                                   F.col("best.n").cast("long").alias("n_words")), "best")


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
          shingle: int = 5, similarity: float = 0.8, radius: int = 19, blocks: int = 4) -> DataFrame:
    """One row for each row of ``docs`` and item alike: the ids, ``similarity``
    and ``start_word`` and ``n_words`` of the window most alike (of ties the
    first). ``blocks`` must divide 64.

    Rows of ``items`` with equal id (null included) and equal words are one
    item; other words under the same id are another item and give their own row."""
    best = _alike(docs, items, text, shingle, similarity, radius, blocks)
    ids = items.select(F.col(item_id).alias("id"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    ids = ids.select("id", _item_key(F.col("w")).alias("item")).distinct()
    rows = docs.select(F.col(doc_id).alias("doc"), text_key(F.col(text)).alias("tk"))
    return rows.join(best.join(ids, "item"), "tk").select(F.col("doc").alias(doc_id), F.col("id").alias(item_id),
                                                          "similarity", "start_word", "n_words", "tk")


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` without the rows whose text holds an item."""
    key = fresh(docs.columns, "tk")
    found = _alike(docs, items, text, **how).select(F.col("tk").alias(key)).distinct()
    return docs.withColumn(key, text_key(F.col(text))).join(found, key, "left_anti").drop(key)
