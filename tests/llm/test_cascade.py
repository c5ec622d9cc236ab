"""Short-circuit cascade: counts by brute force, order-free verdicts."""

import itertools
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tablero.llm.cascade import RULES, Page, plan, verdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [s for s in text.split("\n") if WORD.search(s)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(s in lines[:i] for i, s in enumerate(lines)), len(covered), failed)


def fixture():
    rng = random.Random(6)
    vocabulary = ["été", "of", "the", "Ab", "x#", "long-word", "\u2003wide"]
    texts = [None, "", "\n\n", "one", "a " * 30000, "Ha " * 40, "WORD! " * 3 + "OTHER " * 30]
    for n in range(60):
        words = [rng.choice(vocabulary) + str(rng.randrange(rng.choice((2, 400)))) for _ in range(rng.randrange(90))]
        texts.append("".join(w + rng.choice(" \n\t\x0b ") for w in words))
    block = " ".join(f"w{i}" for i in range(40))
    texts += [block + "\n" + block + " tail", block + " " + block[:60], "same line here\n" * 9 + block]
    return texts


def test_counts_and_verdicts(spark):
    texts = fixture()
    docs = spark.createDataFrame([(i, t, "clash", 0) for i, t in enumerate(texts)] * 2, "doc_id long, text string, v string, kept int")
    order = plan(docs)
    assert sorted(order) == sorted(RULES)
    rows = docs.select("doc_id", verdict(F.col("text"), order).alias("v")).select("doc_id", "v.*").collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        t = texts[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t)
        rejects = {name for name, rule in RULES.items() if rule(Page((t or "").encode()))}
        assert r.kept == (not r.base_failed and not rejects)
        assert r.rejected_by == ("base" if r.base_failed else next((o for o in order if o in rejects), None))


def test_any_order_keeps_the_same(spark):
    docs = spark.createDataFrame([(t,) for t in fixture()], "text string")
    kept = {tuple(docs.select(verdict(F.col("text"), list(o)).alias("v")).select("v.kept").toPandas()["kept"])
            for o in list(itertools.permutations(RULES))[::40]}
    assert len(kept) == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "text string")
    assert docs.select(verdict(F.col("text"), plan(docs)).alias("v")).count() == 0


def test_repeats_survive_hash_ties(monkeypatch):
    """Equal hashes are only candidates: windows are compared word by word."""
    monkeypatch.setattr("tablero.llm.cascade._MIX", 0)
    for text in fixture()[7:]:
        assert Page(text.encode()).n_repeat_words == brute(text)[4]
