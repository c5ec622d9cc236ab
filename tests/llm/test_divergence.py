"""Source divergence against dense exact arithmetic."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tablero.llm.divergence import divergence

SCHEMA = "doc_id long, text string, lang string, source string, p int, at string, value long"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, min_docs, top, scale=10**9, prior=5):
    docs = [(terms(t), lang or "", source or "") for t, lang, source in docs]
    held, count, langs = Counter(), defaultdict(Counter), defaultdict(set)
    for w, lang, source in docs:
        langs[lang].add(source)
        held.update((lang, t) for t in set(w))
        count[lang, source].update(w)
        count[lang, None].update(w)
    out = []
    for lang, sources in langs.items():
        kept = [t for (of, t), n in held.items() if of == lang and n >= min_docs]
        share = {}
        for s in (*sources, None):
            total = sum(count[lang, s][t] for t in kept)
            share[s] = {t: 1 + scale * (count[lang, s][t] + prior) // (total + prior * len(kept)) for t in kept}
        for s in sources:
            pairs = [(-sum(abs(share[s][t] - share[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            more = [(share[None][t] - share[s][t], t.encode(), t) for t in kept if count[lang, s][t] and share[s][t] > share[None][t]]
            for part, rows in (("pair", sorted(pairs)), ("term", sorted(more)[:top])):
                out += [(lang, s, part, item, -v, k + 1) for k, (v, _, item) in enumerate(rows)]
    return sorted(out)


def fixture():
    rng = random.Random(12)
    words = ["alpha", "Beta", "ÉTÉ", "été", "straße", "日本", "o", "x-ray", "l'eau", "d_e", "q1w2"] + [f"w{chr(97 + i)}" for i in range(20)]
    docs = []
    for _ in range(160):
        lang, source = rng.choice(["en", "en", "fr", None, "e n"]), rng.choice(["s1", "s1", "s1", "s2", "É", None, "zz"])
        docs.append((" ".join(rng.choice(words[: rng.randrange(3, len(words))]) for _ in range(rng.randrange(0, 40))), lang, source))
    docs += [(None, "en", "only null"), ("", "xx", "a"), ("lone words here", "xx", "b"), (None, "xx", None), (" 123 ", None, None)]
    return docs + docs[:4] + [("alpha " * 30_000 + "été", "fr", "s2")]


@pytest.mark.parametrize("min_docs,top", [(3, 50), (1, 4), (30, 50)])
def test_fixture(spark, min_docs, top):
    docs = fixture()
    df = spark.createDataFrame([(k, *d, 1, "clash", 2) for k, d in enumerate(docs)], SCHEMA).repartition(4)
    out = divergence(df, min_docs=min_docs, top=top)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in out.collect()) == brute(docs, min_docs, top)


def test_large_counts_need_no_rounding(spark):
    """Products beyond 64 bits: a scale of 10**17."""
    docs = fixture()
    df = spark.createDataFrame([(k, *d, 1, "clash", 2) for k, d in enumerate(docs)], SCHEMA)
    got = divergence(df, min_docs=2, scale=10**17, prior=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, 2, 50, 10**17, 3)


def test_empty_tables_and_languages_without_terms(spark):
    assert divergence(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = divergence(spark.createDataFrame([(1, None, None, None, 0, "", 0), (2, "a b", None, "t", 0, "", 0)], SCHEMA)).collect()
    assert sorted(tuple(r) for r in rows) == [("", "", "pair", "t", 0, 1), ("", "t", "pair", "", 0, 1)]


def test_names_with_dots(spark):
    df = spark.createDataFrame([("a b", "en", "s"), ("a c", "en", "t")], "`the.text` string, `the.lang` string, source string")
    assert divergence(df, "the.text", "the.lang", min_docs=1).count() == 2 + 2


def test_a_task_passes_its_sums_on_in_parts():
    """No task holds, and no driver gets, the whole vocabulary."""
    import pyarrow as pa

    from tablero.llm.divergence import tally
    docs = [(lang or "", source or "", text) for text, lang, source in fixture()]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*docs[k:k + 50])], ["lang", "source", "text"]) for k in range(0, len(docs), 50)]
    parts = list(tally(iter(batches), held=40))
    assert len(parts) > 20
    count, held = Counter(), Counter()
    for part in parts:
        assert part.num_rows <= 40 + 31
        for lang, source, term, n, d in zip(*[c.to_pylist() for c in part.columns]):
            count[lang, source, term.decode()] += n
            held[lang, source, term.decode()] += d
    want, there = Counter(), Counter()
    for lang, source, text in docs:
        want.update((lang, source, w) for w in terms(text))
        there.update((lang, source, w) for w in set(terms(text)))
    assert (count, held) == (want, there)
