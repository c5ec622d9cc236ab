"""Gray-order index and near-duplicate components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tablero.llm._common import Scratch
from tablero.llm.queries import op2_gray_simhash
from tablero.llm.simhash import clusters, gray_rank, keep_one, link_groups, near_duplicates, simhash

SCHEMA = "doc_id long, text string, fp string, node int"


def plain(text, k=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace(
        "\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius=3):
    """prints: list of (id, fingerprint); the smallest id by component, per row."""
    distinct = sorted({f for _, f in prints})
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    arr = np.array(distinct, np.uint64)
    for i, f in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= radius):
            root[find(distinct[i + 1 + j])] = find(f)
    least = {}
    for d, f in prints:
        least[find(f)] = min(least.get(find(f), d), d)
    return [least[find(f)] for _, f in prints]


def test_fingerprint_is_spark_xxhash(spark):
    text = "One two\tTHREE  four\x0bÉtÉ five"
    assert simhash(text) == plain(text)
    assert simhash(None) == simhash(" \n") == 0
    assert simhash("A b") == xxhash.xxh64_intdigest(b"a b", 42)
    assert spark.range(1).select(F.xxhash64(F.lit("a b"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b", 42)


def test_gray_rank():
    code = [i ^ (i >> 1) for i in range(64)]
    assert gray_rank(np.array(code, np.uint64)).tolist() == list(range(64))


def near_prints(rng, centres=12, each=30, spread=8):
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            f = c
            for b in rng.sample(range(64), rng.randrange(spread)):
                f ^= 1 << b
            out.add(f)
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 3, 5])
def test_link_groups(radius):
    rng = random.Random(radius)
    fps = near_prints(rng)
    group = np.sort(np.array([rng.randrange(3) for _ in fps]))
    got = link_groups(np.array(fps, np.uint64), group, radius)
    for g in range(3):
        own = np.flatnonzero(group == g)
        want = brute_components([(int(i), fps[i]) for i in own], radius)
        seen = {}
        for i, w in zip(own, want):
            assert seen.setdefault(w, got[i]) == got[i]
        assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("group", [4096, 20])
def test_clusters_with_large_nodes(spark, group):
    rng = random.Random(4)
    fps = near_prints(rng, centres=4, each=40)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.fp: r.root for r in clusters(df, 3, Scratch(spark, "test"), group=group).collect()}
    want = brute_components([(s, f) for s, f in zip(signed, fps)])
    assert [got[s] for s in signed] == want


def fixture_rows():
    rng = random.Random(9)
    rows = [None, "", " \t", "one", "one two", "word " * 5000]
    base = [f"w{rng.randrange(200)}" for _ in range(150)]
    for _ in range(20):
        t = list(base)
        t[rng.randrange(150)] = "changed"
        rows.append(" ".join(t))
    rows += [rows[-1], " ".join(f"x{rng.randrange(300)}" for _ in range(80))]
    return [(i + 5, t, "clash", 1) for i, t in enumerate(rows)] + [(7, rows[-1], "clash", 1), (7, rows[-1], "clash", 1), (None, "one", "clash", 1)]


def test_fixture(spark):
    rows = fixture_rows()
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    keyed = [(r[0] if r[0] is not None else 10**9, plain(r[1])) for r in rows]
    want = sorted((r[0] or 0, f, c) for r, (_, f), c in zip(rows, keyed, brute_components(keyed)))
    assert sorted((r.doc_id or 0, r.fingerprint % (1 << 64), r.component_id) for r in got) == want


def test_keep_one(spark):
    rows = fixture_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    keyed = [(i, plain(r[1])) for i, r in enumerate(rows)]
    groups = {}
    for r, c in zip(rows, brute_components(keyed)):
        groups.setdefault(c, []).append(r[0])
    want = sorted(min(ids, key=lambda d: (d is not None, d)) or 0 for ids in groups.values())
    assert sorted(r.doc_id or 0 for r in kept.collect()) == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(empty).count() == 0
    assert keep_one(empty).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in op2_gray_simhash(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    keyed = [(r.doc_id, plain(r.text)) for r in rows]
    assert got == {d: (f, c) for (d, f), c in zip(keyed, brute_components(keyed))}
    assert len({c for _, c in got.values()}) < len(rows)
