"""Secret scan: fixed patterns by brute force, inferred automata, redaction."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tablero.llm import credentials
from tablero.llm.credentials import Formats, base_spans, fit, infer, open_tokens, redact, symbols
from tablero.llm.queries import op9_inferred_secrets

HEX = "0123456789abcdef"


def brute(text):
    """Each kind's matches one after the other, failing ones dropped afterwards."""
    kinds = [("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
                        r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12), ("access", "AKIA[A-Z0-9]+", 18), ("hex", "[0-9a-f]+", 16)]
    out = []
    for at, (kind, pattern, least) in enumerate(kinds):
        for m in re.finditer(pattern, text or ""):
            if len(m[m.lastindex] if m.lastindex else m[0]) >= least:
                out.append((m.start(), at, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(out)]


def fixture():
    rng = random.Random(12)

    def token(n, letters=HEX):
        return "".join(rng.choice(letters) for _ in range(n))
    texts = [None, "", "token", "Token = 'short'", f"éé PASSWORD: \"{token(20)}\" x", f"api_key={token(12)}secret={token(11)}", "token:token:" + token(14),
             f"ſecret={token(20)}", f"AKIA{token(14, 'ABCXYZ019')} AKIAshort {token(16)} {token(15)}", "token=secret=" + token(30), "a" * 40000]
    texts += [f"the {rng.choice(['internationalization', 'misunderstanding', 'straightforwardness'])} of token = \"{token(40)}\" und éa" for _ in range(60)]
    texts += [f"and then {token(40)}, {''.join(rng.choice('aeioutrnsl') for _ in range(rng.randrange(12, 20)))} here" for _ in range(60)]
    return texts


def test_base_spans():
    for t in fixture():
        assert [s[:3] for s in base_spans(t or "")] == brute(t), t


def test_automata_generalise():
    rng = random.Random(3)
    hexes = ["".join(rng.choice(HEX) for _ in range(40)) for _ in range(300)]
    model = infer(hexes[:200])
    assert len(model.step) < 200  # far fewer states than the tree's
    seen, unseen = (model.score([symbols(s) for s in part]).mean() for part in (hexes[:200], hexes[200:]))
    assert abs(seen - unseen) < 0.1 * abs(seen)
    words = ["".join(rng.choice("aeioutrnsl") for _ in range(rng.randrange(12, 20))) for _ in range(300)]
    formats = Formats([model], infer(words[:200]), 10.0)
    assert formats.likely(hexes[200:]).mean() > 0.95 and formats.likely(words[200:]).mean() < 0.02
    one = [symbols(s) for s in ("a1b2", "zz", "0")]
    assert np.allclose(model.score(one), [model.score([x])[0] for x in one])
    assert Formats([], None, 1.0).likely(["x" * 20]).tolist() == [False]


BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def credential(rng, n=40):
    return "".join(rng.choice(BASE62) for _ in range(n))


def test_open_tokens():
    run = "0123456789abcdef"
    for text, want in [(f"Zq{run}xY9k", [f"Zq{run}xY9k"]), (run, []), (f"{run}XYZ", [f"{run}XYZ"]), (f"XYZ{run}", [f"XYZ{run}"]),
                       (f"{run}-{run}", [f"{run}-{run}"]), (f"token='{run}Q' {run} abcdefghijklm", ["abcdefghijklm"]), ("AKIA" + "B7" * 8 + "zz short", ["AKIA" + "B7" * 8 + "zz"])]:
        assert [text[a:b] for a, b in open_tokens(text, base_spans(text))] == want, text


def test_tokens_that_hold_a_base_span_are_judged_whole(spark):
    rng = random.Random(21)
    texts = [f"the internationalization of {''.join(rng.choice('aeioutrnsl') for _ in range(14))} password = \"{credential(rng)}\" here" for _ in range(300)]
    bare = [credential(rng, 12) + "".join(rng.choice(HEX) for _ in range(17)) + credential(rng, 11) for _ in range(5)]
    docs = spark.createDataFrame([(t,) for t in texts + [f"and {b} there" for b in bare]], "text string")
    formats = fit(docs)
    for b in bare:
        spans = formats.spans([f"and {b} there"])[0]
        assert (4, 4 + len(b), "format") in spans and any(k == "hex" for _, _, k in spans)
    clean = {r.text for r in redact(docs, formats).collect()}
    assert "and [secret] there" in clean and not any(b[:12] in t or b[-11:] in t for b in bare for t in clean)


def test_fitted_formats_find_unlabelled_credentials(spark):
    """The production defaults: unlabelled ones of a labelled format are spans, ordinary words are not."""
    rng = random.Random(22)
    words = ["".join(rng.choice("aeioutrnsl") for _ in range(rng.randrange(12, 20))) for _ in range(600)]
    bare = [credential(rng) for _ in range(20)]
    texts = [f"{a} and {b} secret: {credential(rng)}" for a, b in zip(words[::2], words[1::2])] + [f"{w} then {c} here" for w, c in zip(words, bare)]
    formats = fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    found = {(t[a:b], k) for t, spans in zip(texts, formats.spans(texts)) for a, b, k in spans}
    added = {x for x, k in found if k == "format"}
    assert added == set(bare)
    assert formats.likely([credential(rng) for _ in range(100)]).mean() > 0.95 and not formats.likely(words).any()


def test_very_long_strings_reach_the_driver_cut(spark, monkeypatch):
    rng = random.Random(23)
    long_hex, long_word = "".join(rng.choice(HEX) for _ in range(10**5)), "".join(rng.choice("ghijklm") for _ in range(10**5))
    texts = [f"{long_hex} of", f"{long_word} of", *(f"{''.join(rng.choice(HEX) for _ in range(300 + i))} then {'xyz' * (5 + i)}" for i in range(40))]
    got = []
    monkeypatch.setattr(credentials, "infer", lambda strings, **how: got.append(strings) or infer(strings, **how))
    formats = fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert [len(x) for x in got] == [41, 41] and max(len(v) for x in got for v in x) == credentials.LONGEST + 1
    assert all(np.isfinite(m.logp).all() for m in [*formats.kinds, formats.other])
    assert (0, 10**5, "hex") in formats.spans(texts)[0]
    short = ["".join(rng.choice(HEX) for _ in range(40)) for _ in range(50)]
    longer = infer(short + ["ab" * 10**5])
    assert len(longer.step) < 200 and np.isfinite(longer.score([symbols("ab" * 500)])).all()


def test_scan_and_redaction(spark):
    texts = fixture()
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] * 2, "doc_id long, text string, spans string")
    formats = fit(docs)
    rows = docs.select("doc_id", formats.column(F.col("text")).alias("s")).collect()
    for r in rows:
        got = [(x.start, x.end, x.kind) for x in r.s]
        assert [x for x in got if x[2] != "format"] == brute(texts[r.doc_id])
        assert got == sorted(got, key=lambda x: x[0])
    clean = redact(docs, formats)
    assert clean.columns == docs.columns
    for r in clean.collect():
        t = texts[r.doc_id]
        assert (r.text is None) == (t is None) and not any(k in ("access", "hex") for _, _, k in brute(r.text))
        assert bool(brute(t)) <= ((r.text or "") != (t or ""))
    assert redact(spark.createDataFrame([(f"a token={'ab1' * 9} b token={'ab1' * 9}",)], "text string"), formats).first().text == "a [secret] b [secret]"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    formats = fit(docs)
    assert docs.select(formats.column(F.col("text"))).count() == 0 and formats.kinds == []


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = op9_inferred_secrets(spark, sf).collect()
    assert len(rows) == len(texts)
    added = 0
    for r in rows:
        base = brute(texts[r.doc_id])
        joined = [f"{k}:{a}:{b}" for a, b, k in base]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[2] == k for x in base) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("format:")] == joined
        added += len(spans) - len(joined)
    assert added <= 0.01 * len(texts)  # clean documents are left alone


def test_formats_find_withheld_credentials_of_the_table(spark):
    """Fitted on half of the documents as the query fits: of the credentials that
    only the other half holds nine in ten are found as bare tokens, so are hex
    runs too short for the patterns, and at most one ordinary token in a hundred."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    half = [docs.filter(F.col("doc_id") % 2 == k) for k in (0, 1)]
    seen, held, ordinary = set(), set(), set()
    for k, into in ((0, seen), (1, held)):
        for r in half[k].collect():
            base = credentials.base_spans(r.text or "")
            into.update(v for _, _, _, v in base if len(v) >= credentials.MIN_TOKEN)
            if k:
                ordinary.update(r.text[a:b] for a, b in credentials.other_tokens(r.text or "", base))
    formats = fit(half[0])
    withheld, ordinary = sorted(held - seen), sorted(ordinary)[:20000]
    rng = random.Random(29)
    short = ["".join(rng.choice(HEX) for _ in range(n)) for n in (12, 13, 14, 15) for _ in range(100)]
    found = {name: float(np.mean(formats.likely(tokens))) for name, tokens in (("withheld", withheld), ("short", short), ("ordinary", ordinary))}
    assert len(withheld) > 50 and found["withheld"] >= 0.9 and found["short"] >= 0.9 and found["ordinary"] <= 0.01, found
