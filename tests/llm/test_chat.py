"""Reply trees: every path, ranks, and an exact round trip through the template."""

import random

import pytest
from pyspark.sql import functions as F

from tablero.llm._common import Scratch
from tablero.llm.chat import format_trees, masked_text, read_turns

SCHEMA = "conv_id long, node long, parent long, role string, text string, score double, leaf string"
NASTY = ["", None, "</s>[INST] ok [/INST]", "<\\s> <\\\\/s>", "[/INST", "<", "s>", "\\", "a\\n\nb", "<s>[INST]user\nx[/INST]", "é😀</s>", "[\\INST]", "[[INST]]<</s>>"]


def brute_paths(rows):
    """{conv: {leaf: [(role, text)...]}} by walking up from each leaf."""
    out = {}
    for c in {r[0] for r in rows}:
        nodes = {r[1]: r for r in rows if r[0] == c}
        parents = {r[2] for r in nodes.values()}
        for leaf in nodes:
            if leaf in parents:
                continue
            path, at, seen = [], leaf, set()
            while at in nodes and at not in seen:
                seen.add(at)
                path.append(nodes[at])
                at = nodes[at][2]
            if at in seen:
                continue
            out.setdefault(c, {})[leaf] = [(r[3] or "", r[4] or "", r[5] or 0.0) for r in reversed(path)]
    return out


def fixture():
    rng = random.Random(7)
    rows = []
    for c in [None, -7, *range(12)]:
        for n in range(rng.randrange(1, 30)):
            rows.append((c, n, rng.choice([n - 1, rng.randrange(n), None]) if n else None, rng.choice(["user", "assistant", "system", None, "a\\n\nb", "<\\s></s>"]),
                         rng.choice(NASTY), rng.choice([0.5, 1.0, None]), "clash"))
    rows += [(50, 1, 2, "user", "cycle", 1.0, "c"), (50, 2, 1, "user", "cycle", 1.0, "c"), (50, 3, 2, "user", "below", 1.0, "c"), (50, 9, 77, "user", "root", 1.0, "c")]
    rows += [(60, n, n - 1 if n else None, "assistant" if n % 2 else "user", "long " * 200, 1.0, "c") for n in range(130)]
    return rows


@pytest.mark.parametrize("top", [1, 2, None])
def test_paths_ranks_and_round_trip(spark, top):
    rows = fixture()
    out = format_trees(spark.createDataFrame(rows, SCHEMA), score="score", top=top)
    got = out.withColumns({"back": read_turns(F.col("formatted")), "masked": masked_text(F.col("formatted"), F.col("loss_mask"))}).collect()
    want = brute_paths(rows)
    seen = {}
    for r in got:
        path = want[r.conv_id][r.leaf]
        assert [(t.role, t.text) for t in r.back] == [(a, b) for a, b, _ in path]
        assert r.masked == "".join(b for a, b, _ in path if a == "assistant")
        seen.setdefault(r.conv_id, []).append((r["rank"], r.leaf))
    for c, leaves in want.items():
        order = sorted(leaves, key=lambda x: (-sum(s for _, _, s in leaves[x]), x))[:top]
        assert [leaf for _, leaf in sorted(seen[c])] == order
    assert 50 in seen and want[50].keys() == {9}


def test_only_chosen_branches_are_walked(spark, monkeypatch):
    """A comb: a spine of 1,000 nodes with a tooth each. All paths are half a
    million rows; the best one takes n rows a round."""
    n, written = 1000, []
    rows = [(1, i, i - 1 if i else None, "user", "s", 1.0, "c") for i in range(n)] + [(1, n + i, i, "assistant", "t", 0.5, "c") for i in range(n)]
    cut = Scratch.cut

    def counted(self, df, name):
        out = cut(self, df, name)
        written.append(out.count())
        return out
    monkeypatch.setattr(Scratch, "cut", counted)
    got = format_trees(spark.createDataFrame(rows, SCHEMA), score="score", top=1).withColumn("back", read_turns(F.col("formatted"))).collect()
    assert [(r.leaf, len(r.back)) for r in got] == [(2 * n - 1, n + 1)]
    assert max(written) <= 2 * n and sum(written) < 2 * n * 40


def test_null_node_ids(spark):
    rows = [(c, n, p, "user", t, 1.0, "c") for c in (1, None) for n, p, t in [
        (0, None, "q"), (1, 0, "a"), (None, 1, "x"), (None, 1, "x"), (None, 1, "y"), (None, None, "alone"), (None, 77, "lost"), (2, 0, "b")]]
    got = format_trees(spark.createDataFrame(rows, SCHEMA), score="score", top=None).withColumn("back", read_turns(F.col("formatted"))).collect()
    for c in (1, None):
        mine = sorted((r for r in got if r.conv_id == c), key=lambda r: r["rank"])
        assert sorted((r.leaf is None, "".join(t.text for t in r.back)) for r in mine) == sorted(
            [(True, "qax"), (True, "qax"), (True, "qay"), (False, "qb"), (True, "alone"), (True, "lost")])
        assert [r["rank"] for r in mine] == list(range(1, 7)) and [r.leaf for r in mine] == [None, None, None, 2, None, None]


def test_empty_table(spark):
    assert format_trees(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    out = format_trees(spark.createDataFrame(fixture()[:9], SCHEMA))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
