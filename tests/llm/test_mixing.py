"""Mixing: water-filled targets, exact budgets, any bucket count."""

import random
from collections import defaultdict

import pytest

from tablero.llm.mixing import mix, n_words, targets


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Hand the excess on by weight until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, full = {}, set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        out = {s: most * sizes[s] for s in full} | {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if out[s] > most * sizes[s]}
        if not above:
            return out
        full |= above


def fixture():
    rng = random.Random(1)
    rows = [(rng.randrange(400), rng.choice(["a", "a", "a", "b", "É", "z", None, "Z"]), rng.choice([0, 1, 5, 40])) for _ in range(600)]
    return rows + rows[:5] + [(None, "a", 7), (None, "a", 7), (3, "one", 900), (4, "none", 0)]


def test_targets(spark):
    sizes = defaultdict(int)
    for _, s, n in fixture():
        sizes[s] += n
    got = {r.source: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), "source").collect()}
    assert got == pytest.approx(brute_targets(sizes))


@pytest.mark.parametrize("bucket_rows", [20000, 3])
def test_mix(spark, bucket_rows):
    rows = fixture()
    df = spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "doc_id long, source string, size long, key string, target double").repartition(5)
    out = mix(df, bucket_rows=bucket_rows)
    assert out.columns == ["doc_id", "source", "size", "key", "source_size", "target", "taken"]
    got = out.collect()
    assert sorted((r.doc_id or -1, r.source or "", r.size) for r in got) == sorted((d or -1, s or "", n) for d, s, n in rows)
    taken, sizes = defaultdict(int), defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        sizes[r.source] += r["size"]
        assert 0 <= r.taken <= 2 * r["size"]
    want = brute_targets(sizes)
    for s, n in sizes.items():
        assert taken[s] == round(want[s])
    again = mix(df.repartition(3), bucket_rows=50).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_words_and_empty_table(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " a\tb\x0bc d "), (4, "w " * 50000)], "doc_id long, text string")
    assert [r.n for r in df.select(n_words("text").alias("n")).collect()] == [0, 0, 3, 50000]
    assert mix(spark.createDataFrame([], "doc_id long, source string, size long")).count() == 0
    zero = mix(spark.createDataFrame([(1, None, 0)], "doc_id long, source string, size long")).collect()
    assert [(r.source_size, r.target, r.taken) for r in zero] == [(0, 0.0, 0)]
