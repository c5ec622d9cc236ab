"""Benchmark decontamination against every item-sized window."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tablero.llm.decontam import _windows, leaks, without_leaks
from tablero.llm.decontam import words as word_list
from tablero.llm.queries import op5_hamming_decontamination

SCHEMA = "doc_id long, text string, tk string, n int"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def counts(w, k):
    return Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(docs, items, k=5, similarity=0.8):
    coded = [(i, words(t)) for i, t in items if words(t)]
    out = {}
    for d, t in docs:
        w = words(t)
        for i, item in coded:
            n, kk = len(item), min(k, len(item))
            theirs = counts(item, kk)
            have = {s for j in range(len(w) - kk + 1) for s in [tuple(w[j:j + kk])] if s in theirs}
            if not have:
                continue
            best = 0
            for a in range(max(1, len(w) - n + 1)):
                own = counts(w[a:a + n], kk)
                both = sum((own & theirs).values())
                best = max(best, both / (own.total() + theirs.total() - both))
            if best >= similarity:
                out[d, i] = round(best, 6)
    return out


def fixture():
    rng = random.Random(2)

    def prose(n):
        return " ".join(rng.choice("the of and to in that is was for on with as by at from it an be this".split()) + str(rng.randrange(30)) for _ in range(n))
    items = [(i, prose(rng.randrange(12, 60))) for i in range(12)] + [(20, "Two words!"), (21, None), (22, " .. "), (22, prose(30))]
    docs = [(0, None), (1, ""), (2, prose(400)), (3, "so: two, WORDS " + prose(10)), (4, items[0][1]), (4, items[0][1])]
    for j in range(40):
        i, t = items[j % 12]
        w = t.split()
        for _ in range(j % 4):
            w[rng.randrange(len(w))] = "other"
        cut = " ".join(w) if j % 5 else " ".join(w[1:])
        docs.append((10 + j, prose(rng.randrange(40)) + "\n" + cut.upper() + "%%% " + prose(rng.randrange(40))))
    docs.append((99, items[1][1] + " " + items[1][1] + " " + prose(20000)))
    return docs, items


def test_fixture(spark):
    docs, items = fixture()
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], SCHEMA)
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, h int")
    rows = leaks(df, bench).collect()
    want = brute(docs, items)
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in rows}
    assert {k: v for k, v in got.items() if k[1] != 22} == {k: v for k, v in want.items() if k[1] != 22}
    assert (3, 20) in got and sum(r.doc_id == 4 and r.item_id == 0 for r in rows) == 2
    kept = without_leaks(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_best_window_starts_inside_a_run(spark):
    """Repeated words: the best window starts at neither the first nor the last of a run of shared shingles."""
    item = "one zero zero zero one zero one zero zero one zero zero zero zero"
    text = "zero one zero one zero zero zero one zero one zero zero one zero zero one zero zero two zero two two two two"
    df = spark.createDataFrame([(1, text, "c", 0), (2, "x " + item + " y", "c", 0)], SCHEMA)
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in leaks(df, spark.createDataFrame([(0, item)], "item_id long, text string")).collect()}
    assert got == brute([(1, text), (2, item)], [(0, item)]) and set(got) == {(1, 0), (2, 0)}


def test_windows_lose_no_item(spark):
    """Small vocabularies: of every item that a text reaches, one of the best windows is among those looked at."""
    rng = random.Random(21)
    items, texts = [], []
    for _ in range(60):
        vocabulary = "zero one two three four five".split()[: rng.randrange(2, 6)]
        item = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 22))]
        items.append(item)
        for _ in range(6):
            w = list(item)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            pad = [[rng.choice(vocabulary) for _ in range(rng.randrange(0, 9))] for _ in range(2)]
            texts.append(pad[0] + w[rng.randrange(0, 2):len(w) - rng.randrange(0, 2)] + pad[1])
    docs = spark.createDataFrame([(str(i), " ".join(w)) for i, w in enumerate(texts)], "tk string, t string").select("tk", word_list(F.col("t")).alias("w"))
    of = spark.createDataFrame([(w, len(w), min(5, len(w))) for w in items], "w array<string>, n int, k int")
    starts = {}
    for r in _windows(docs, of, [3, 4, 5], 0.8).collect():
        starts.setdefault((int(r.tk), r.n), set()).add(r.start)
    reached = 0
    for i, w in enumerate(texts):
        for item in items:
            n, k = len(item), min(5, len(item))
            theirs = counts(item, k)

            def like(a):
                own = counts(w[a:a + n], k)
                both = sum((own & theirs).values())
                return both / (own.total() + theirs.total() - both)
            best = max(like(a) for a in range(max(1, len(w) - n + 1)))
            if best >= 0.8 and len(w) >= k:
                reached += 1
                assert best == max(map(like, starts.get((i, n), {-1}))), (w, item)
    assert reached > 300


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "c", 1)], SCHEMA)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert leaks(docs, bench).count() == 0
    assert without_leaks(docs, bench).count() == 1
    assert leaks(docs.limit(0), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


def test_repeated_and_null_item_ids(spark):
    rng = random.Random(5)
    a, b, c, d, e = (" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(500)}" for _ in range(n)) for n in (30, 30, 45, 25, 40))
    items = [(0, a), (0, b), (0, c), (0, c), (None, d), (None, e), (7, a)]
    docs = [(k, f"before that {t} and after", "clash", 1) for k, t in enumerate([a, b, c, d, e])] + [(9, "nothing of these " * 20, "clash", 1)]
    df = spark.createDataFrame(docs, SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r.doc_id, r.item_id, r.similarity, r.start_word, r.n_words) for r in leaks(df, bench).collect()]
    want = [(0, 0, 1.0, 2, 30), (0, 7, 1.0, 2, 30), (1, 0, 1.0, 2, 30), (2, 0, 1.0, 2, 45), (3, None, 1.0, 2, 25), (4, None, 1.0, 2, 40)]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert [r.doc_id for r in without_leaks(df, bench.select("text")).collect()] == [9]


def test_query_against_every_window(spark):
    sf = "/root/testdata/sf0.01"
    def table(name, key):
        return [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(key, "text").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in op5_hamming_decontamination(spark, sf).collect()}
    want = brute(table("documents", "doc_id"), table("benchmark", "item_id"))
    assert got == want and len(want) > 10
