"""Chat formatting of reply trees. DataFrame operations only.

Paths from each leaf to its root come from self-joins with doubled strides:
after step k a leaf holds its first ``2**k`` ancestors, and the table of
``2**k``-fold parents, joined with itself, gives the next. Branches are ranked
by score within their conversation: where only the best are asked for, the
scores are summed by the same doubling first, one row for each node and round,
and only the chosen leaves are walked. Each chosen path is written as one string
with a loss mask.

The template: ``<s>[INST]role\\ntext[/INST]`` for a turn, ``<s>text</s>`` for
one of the assistant, whose text alone is under the mask. A control string
inside a text or role gets one backslash more after its first character, so
none is left, and reading back takes one away; a role's backslashes and line
ends are written as two characters.

Null texts and roles count as empty. A row whose parent is null or missing is
a root. Rows on a cycle of parents are on no path. Node ids must be apart
within a conversation; a null conversation id is a conversation of its own. A
row whose node id is null is a leaf below its parent, each such row for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablero.llm._common import Scratch

_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
_MORE = r"$1\\$2$3"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
_LESS = "$1$2$3"
_TURN = r"(?s)<s>\[INST\].*?\[/INST\]|<s>.*?</s>"
_TURN_HEAD, _TURN_END, _OWN_HEAD, _OWN_END = "<s>[INST]", "[/INST]", "<s>", "</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, _MORE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, _LESS)


def _role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _read_role(role: Column) -> Column:
    """Between two-backslash pairs a backslash and an n are a line end."""
    parts = F.transform(F.split(unescape(role), r"\\\\", -1), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def _parents(nodes: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(conv, node, parent) of the rows whose parent is there, written, and the
    number of nodes of the largest conversation."""
    known = nodes.select("conv", F.col("node").alias("parent"))
    up = nodes.select("conv", "node", "parent").join(known, ["conv", "parent"], "left_semi").select("conv", "node", "parent")
    return scratch.cut(up, "up0"), nodes.groupBy("conv").count().agg(F.max("count")).first()[0] or 0


def _leaves(nodes: DataFrame, up: DataFrame) -> DataFrame:
    return nodes.select("conv", "node").join(up.select("conv", F.col("parent").alias("node")), ["conv", "node"], "left_anti")


def _doubled(jump: DataFrame, scratch: Scratch, stride: int) -> DataFrame:
    """Parents ``2 * stride`` up from those ``stride`` up."""
    far = jump.select("conv", F.col("node").alias("parent"), F.col("parent").alias("far"))
    return scratch.cut(jump.join(far, ["conv", "parent"]).select("conv", "node", F.col("far").alias("parent")), f"up{stride * 2}")


def paths(nodes: DataFrame, scratch: Scratch, leaves: DataFrame | None = None) -> DataFrame:
    """(conv, leaf, node, back) of every root-to-leaf path, ``back`` steps from
    the leaf, from rows (conv, node, parent); conv must not be null. With
    ``leaves`` (conv, node) only their paths."""
    ids = nodes.select("conv", "node")
    up, longest = _parents(nodes, scratch)
    leaves = _leaves(nodes, up) if leaves is None else leaves
    out = leaves.select("conv", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back"))
    stride, jump = 1, up
    while stride < longest and not jump.isEmpty():
        more = out.join(jump, ["conv", "node"]).select("conv", "leaf", F.col("parent").alias("node"), (F.col("back") + stride).alias("back"))
        out = scratch.cut(out.unionByName(more), f"paths{stride}")
        jump = _doubled(jump, scratch, stride)
        stride *= 2
    roots = ids.join(up.select("conv", "node"), ["conv", "node"], "left_anti")
    whole = out.join(roots, ["conv", "node"], "left_semi").select("conv", "leaf")  # others end in a cycle
    return out.join(whole, ["conv", "leaf"], "left_semi")


def branch_scores(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, leaf, score) of every branch that has a root, without its rows:
    after round k a node holds the sum of the scores of itself and its next
    ``2**k - 1`` ancestors and a pointer to the one above, so that n nodes write
    n rows a round. Rows on or below a cycle keep a pointer and fall out."""
    up, longest = _parents(nodes, scratch)
    now = nodes.select("conv", "node", "score").join(up, ["conv", "node"], "left")
    now, stride = scratch.cut(now, "sums1"), 1
    while stride < longest and not now.filter("parent is not null").isEmpty():
        above = now.select("conv", F.col("node").alias("parent"), F.col("score").alias("more"), F.col("parent").alias("next"))
        done = now.filter("parent is null")
        step = now.join(above, ["conv", "parent"]).select("conv", "node", (F.col("score") + F.col("more")).alias("score"), F.col("next").alias("parent"))
        stride *= 2
        now = scratch.cut(done.unionByName(step), f"sums{stride}")
    ends = now.filter("parent is null").select("conv", "node", "score")
    return ends.join(_leaves(nodes, up), ["conv", "node"], "left_semi").select("conv", F.col("node").alias("leaf"), "score")


def written(turns: Column) -> Column:
    """The string of an array of turns (role, text)."""
    return F.array_join(F.transform(turns, _written), "")


def _written(t: Column) -> Column:
    own = F.concat(F.lit(_OWN_HEAD), escape(t["text"]), F.lit(_OWN_END))
    other = F.concat(F.lit(_TURN_HEAD), _role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(_TURN_END))
    return F.when(t["role"] == "assistant", own).otherwise(other)


def loss_mask(turns: Column) -> Column:
    """Spans (start, end) of the assistant's texts in the written string, in code points."""
    sizes = F.transform(turns, lambda t: F.struct((t["role"] == "assistant").alias("own"), F.length(_written(t)).alias("size")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        span = F.struct((state["at"] + len(_OWN_HEAD)).alias("start"), (state["at"] + t["size"] - len(_OWN_END)).alias("end"))
        return F.struct((state["at"] + t["size"]).alias("at"), F.when(t["own"], F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))
    return F.aggregate(sizes, zero, add)["spans"]


def read_turns(formatted: Column) -> Column:
    """The array of turns (role, text) of a written string."""
    def one(x: Column) -> Column:
        inner = F.substring(x, len(_TURN_HEAD) + 1, F.length(x) - len(_TURN_HEAD) - len(_TURN_END))
        role = F.substring_index(inner, "\n", 1)
        other = F.struct(_read_role(role).alias("role"), unescape(F.substring(inner, F.length(role) + 2, F.length(inner))).alias("text"))
        own = F.struct(F.lit("assistant").alias("role"),
                       unescape(F.substring(x, len(_OWN_HEAD) + 1, F.length(x) - len(_OWN_HEAD) - len(_OWN_END))).alias("text"))
        return F.when(F.startswith(x, F.lit(_TURN_HEAD)), other).otherwise(own)
    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), one)


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def format_trees(rows: DataFrame, conv: str = "conv_id", node: str = "node", parent: str = "parent", role: str = "role", text: str = "text",
                 score: str | None = None, top: int | None = 1) -> DataFrame:
    """(conv, leaf, rank, formatted, loss_mask) of the ``top`` branches of each
    conversation (None: all). A branch's score is the sum over its rows (null
    as 0; without ``score`` the number of rows); of ties the smaller leaf, null
    last (of null leaves, the row of smaller digest)."""
    scratch = Scratch(rows.sparkSession, "chat")
    none = F.col(conv).isNull()
    value = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(1.0)
    # rows without an id are told apart by their content, then by a number drawn once: the table is written
    own = F.when(F.col(node).isNull(), F.concat(F.sha2(F.to_json(F.struct(F.col(parent).alias("parent"), F.col(role).alias("role"), F.col(text).alias("text"),
                                                                          value.alias("score"))), 256), F.expr("uuid()"))).otherwise(F.lit(""))
    no = F.lit(False)
    id_, above = F.coalesce(F.col(node), F.when(no, F.col(parent))), F.coalesce(F.when(no, F.col(node)), F.col(parent))  # of one type
    kept = scratch.cut(rows.select(F.struct(none.alias("none"), F.when(none, 0).otherwise(F.col(conv)).alias("id")).alias("conv"),
                                   F.struct(own.alias("own"), id_.alias("id")).alias("node"),
                                   F.when(F.col(parent).isNotNull(), F.struct(F.lit("").alias("own"), above.alias("id"))).alias("parent"), value.alias("score"),
                                   F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")), "nodes")
    nodes = kept.select("conv", "node", "parent", "score")
    rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.col("score").desc(), "leaf"))
    if top is None:  # every path is written, so its rows give its score
        found = paths(nodes, scratch)
        branch = found.join(kept.select("conv", "node", "score"), ["conv", "node"]).groupBy("conv", "leaf").agg(F.sum("score").alias("score"))
        chosen = branch.select("conv", "leaf", rank.alias("rank"))
    else:  # ranked first, so that only the chosen branches are walked
        ranked = branch_scores(nodes, Scratch(rows.sparkSession, "chat-scores")).select("conv", "leaf", rank.alias("rank"))
        chosen = scratch.cut(ranked.filter(F.col("rank") <= top), "chosen")
        found = paths(nodes, scratch, chosen.select("conv", F.col("leaf").alias("node")))
    turns = (found.join(chosen, ["conv", "leaf"]).join(kept.select("conv", "node", "role", "text"), ["conv", "node"])
             .groupBy("conv", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("at"), "role", "text"))).alias("turns")))
    leaf = F.col("leaf.id").cast(rows.select(F.col(node)).schema[0].dataType).alias("leaf")
    return turns.select(F.when(~F.col("conv.none"), F.col("conv.id")).alias(conv), leaf, F.col("rank").cast("long").alias("rank"),
                        written(F.col("turns")).alias("formatted"), loss_mask(F.col("turns")).alias("loss_mask"))
