"""Run-length index removal of repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tablero.llm.queries import op1_run_length_dedup
from tablero.llm.repeats import RunIndex, remove_repeats, repeated_starts, suffix_order

SCHEMA = "doc_id long, text string, tk string, spans int"


def brute(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((edges == 1).sum()), kept))
    return out


def test_suffix_order_and_statistics():
    rng = random.Random(5)
    for _ in range(40):
        t = np.array([rng.randrange(3) for _ in range(rng.randrange(1, 60))], np.int16)
        raw = t.tolist()
        assert suffix_order(t).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        got = RunIndex(t).matching_statistics()

        def shared(i, j):
            n = 0
            while max(i, j) + n < len(raw) and raw[i + n] == raw[j + n]:
                n += 1
            return n
        assert got.tolist() == [max((shared(i, j) for j in range(len(raw)) if j != i), default=0) for i in range(len(raw))]


@pytest.mark.parametrize("length", [3, 20])
def test_repeated_starts(length):
    rng = random.Random(length)
    for _ in range(40):
        base = bytes(rng.choice(b"ab\x00\xff") for _ in range(80))
        contexts = []
        for _ in range(rng.randrange(1, 8)):
            a = rng.randrange(40)
            t = bytearray(base[a:a + rng.randrange(length, 41)])
            if rng.random() < 0.6:
                t[rng.randrange(len(t))] = ord("c")
            contexts.append(bytes(t))
        seen = Counter(t[i:i + length] for t in contexts for i in range(len(t) - length + 1))
        assert [x.tolist() for x in repeated_starts(contexts, length)] == [
            [i for i in range(len(t) - length + 1) if seen[t[i:i + length]] > 1] for t in contexts]


def fixture_rows():
    rng = random.Random(11)

    def noise(n):
        return "".join(rng.choice("abcdefgh éß") for _ in range(n))
    passage = noise(70)
    rows = [None, "", "x", passage, passage, "a" * 300, noise(400)]
    rows += [noise(rng.randrange(50)) + passage[rng.randrange(20):rng.randrange(50, 70)] + noise(rng.randrange(50)) for _ in range(120)]
    rows += [rows[-1], rows[-1], passage + "z" + passage, "ab" * 100, noise(3000) * 2]
    return [(i, t, "clash", 7) for i, t in enumerate(rows)] + [(3, passage, "clash", 7)]


@pytest.mark.parametrize("group", [2048, 5])
def test_fixture_with_nulls_ties_and_split_groups(spark, group):
    rows = fixture_rows()
    df = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), length=40, anchor=12, group=group, block=2000)
    assert df.columns == ["doc_id", "tk", "n_bytes", "n_removed", "spans", "kept"]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in df.collect())
    want = brute([(r[1] or "").encode() for r in rows], 40)
    assert got == sorted((r[0], *w) for r, w in zip(rows, want))


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op1_run_length_dedup(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    removed = 0
    for r, (n, gone, runs, kept) in zip(rows, brute([(r.text or "").encode() for r in rows], 400)):
        g = got[r.doc_id]
        assert (g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) == (n, gone, runs, hashlib.sha256(kept).hexdigest())
        removed += gone
    assert removed > 0
