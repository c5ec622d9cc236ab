"""Secret scan: fixed patterns, and formats inferred from what they find.

The credentials that the patterns label, and ordinary long tokens beside them,
are samples of formats. From each sample a prefix tree over character classes
is built, and states whose next symbols could come from one distribution (a
Hoeffding test, on all their descendants too) are merged into a probabilistic
automaton. Every token of ``MIN_TOKEN`` characters or more that is not under
the patterns' spans from end to end is then scored: where a credential's
automaton beats the ordinary one by ``ratio`` nats, the whole token is a span
of kind ``format``.

Null texts count as empty. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tablero.llm._common import Scratch, texts_of

KINDS = ("assign", "access", "hex")
MIN_TOKEN = 12
#: Characters of a sampled string that the fit counts. The scan has no such limit.
LONGEST = 256
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_TOKEN)


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, credential) of the fixed patterns, by start, then kind."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), m.end(), "assign", m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    for kind, pattern in (("access", _ACCESS), ("hex", _HEX)):
        found += [(m.start(), m.end(), kind, m[0]) for m in pattern.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def other_tokens(text: str, base: list[tuple[int, int, str, str]]) -> list[tuple[int, int]]:
    """Tokens that touch no base span."""
    out, k = [], 0
    ends = np.maximum.accumulate([s[1] for s in base]).tolist()
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while k < len(base) and ends[k] <= a:
            k += 1
        if k == len(base) or base[k][0] >= b:
            out.append((a, b))
    return out


def open_tokens(text: str, base: list[tuple[int, int, str, str]]) -> list[tuple[int, int]]:
    """Tokens of which a character at least is under no base span."""
    out, k = [], 0
    runs: list[list[int]] = []  # base spans, those that touch as one
    for a, b, *_ in base:
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while k < len(runs) and runs[k][1] <= a:
            k += 1
        if k == len(runs) or a < runs[k][0] or runs[k][1] < b:
            out.append((a, b))
    return out


# Character classes: digits, hex letters and other letters by case, and each mark by itself; others share one.
_CLASSES = ["0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", *"+/_.=-"]
N_SYMBOLS = len(_CLASSES) + 1
_CODE = np.full(128, len(_CLASSES), np.int8)
for _i, _c in enumerate(_CLASSES):
    _CODE[[ord(_x) for _x in _c]] = _i


def symbols(token: str) -> np.ndarray:
    raw = np.frombuffer(token.encode("ascii", "replace"), np.uint8)
    return _CODE[np.minimum(raw, 127)]


@dataclass
class Automaton:
    """Transitions and log probabilities by state and symbol; state 0 starts.
    The last column of ``logp`` is the end of the string. A symbol that a state
    has not seen leads nowhere: state 0 again, at the smoothed probability."""

    step: np.ndarray
    logp: np.ndarray

    def score(self, coded: list[np.ndarray]) -> np.ndarray:
        """Log likelihood of each string, all advanced one symbol at a time."""
        order = np.argsort([-len(c) for c in coded], kind="stable")
        lengths = np.array([len(coded[i]) for i in order])
        flat = np.concatenate([coded[i] for i in order])
        begin = np.cumsum(lengths) - lengths
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order))
        for j in range(lengths[0]):
            live = int(np.searchsorted(-lengths, -j, side="left"))  # the strings longer than j
            symbol = flat[begin[:live] + j]
            total[:live] += self.logp[state[:live], symbol]
            state[:live] = self.step[state[:live], symbol]
        total += self.logp[state, N_SYMBOLS]
        out = np.empty(len(order))
        out[order] = total
        return out


def infer(strings: list[str], alpha: float = 0.05, smooth: float = 1e-3) -> Automaton:
    """Merge statistically compatible states of the strings' prefix tree. A
    string above ``LONGEST`` characters counts with so many, and with no end."""
    kids: list[dict[int, int]] = [{}]
    count: list[np.ndarray] = [np.zeros(N_SYMBOLS + 1)]  # by symbol; the last: ends here
    for s in strings:
        q = 0
        for c in symbols(s[:LONGEST]).tolist():
            count[q][c] += 1
            if c not in kids[q]:
                kids[q][c] = len(kids)
                kids.append({})
                count.append(np.zeros(N_SYMBOLS + 1))
            q = kids[q][c]
        count[q][N_SYMBOLS] += len(s) <= LONGEST
    bound = np.sqrt(0.5 * np.log(2 / alpha))

    def alike(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            x, y = count[p].sum(), count[q].sum()
            if x and y and (np.abs(count[p] / x - count[q] / y) > bound * (x**-0.5 + y**-0.5)).any():
                return False
            todo += [(kids[p][c], kids[q][c]) for c in kids[p].keys() & kids[q].keys()]
        return True

    def fold(a: int, b: int) -> None:
        """Add the tree below b to state a."""
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            count[p] = count[p] + count[q]
            for c, child in kids[q].items():
                if c in kids[p]:
                    todo.append((kids[p][c], child))
                else:
                    kids[p][c] = child

    red, done = [0], {0}
    while True:
        blue = next(((q, c, k) for q in red for c, k in sorted(kids[q].items()) if k not in done), None)
        if blue is None:
            break
        q, c, k = blue
        into = next((r for r in red if alike(r, k)), None)
        if into is None:
            red.append(k)
            done.add(k)
        else:
            kids[q][c] = into
            fold(into, k)
    place = {q: i for i, q in enumerate(red)}
    step = np.zeros((len(red), N_SYMBOLS), np.int64)
    logp = np.empty((len(red), N_SYMBOLS + 1))
    for q, i in place.items():
        for c, k in kids[q].items():
            step[i, c] = place[k]
        logp[i] = np.log((count[q] + smooth) / (count[q].sum() + smooth * (N_SYMBOLS + 1)))
    return Automaton(step, logp)


def _samples(sample: int):
    """Labelled credentials, and of each document the ordinary token of least
    hash: of each kind a task's ``sample`` distinct strings of least hash, which
    hold all of the table's that come from the task. Of a string above
    ``LONGEST`` characters its start is kept, one character more than ``LONGEST``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, set[tuple[int, str]]] = {k: set() for k in (*KINDS, "other")}
        for batch in batches:
            for raw in texts_of(batch.column(0)):
                text = raw.decode()
                base = base_spans(text)
                for _, _, kind, value in base:
                    held[kind].add((xxhash.xxh64_intdigest(value, 7), value[:LONGEST + 1]))
                others = {text[a:b] for a, b in other_tokens(text, base)}
                if others:
                    h, least = min((xxhash.xxh64_intdigest(t, 7), t) for t in others)
                    held["other"].add((h, least[:LONGEST + 1]))
            for kind in held:
                held[kind] = set(sorted(held[kind])[:sample])
        rows = [(kind, value, h >> 1) for kind in held for h, value in sorted(held[kind])]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                                          pa.array([r[2] for r in rows], pa.int64())], names=["kind", "value", "h"])
    return run


@dataclass
class Formats:
    """One automaton for each kind of credential that was found, and one of
    ordinary tokens; without either of these no span is added."""

    kinds: list[Automaton]
    other: Automaton | None
    ratio: float

    def likely(self, tokens: list[str]) -> np.ndarray:
        if not tokens or not self.kinds or self.other is None:
            return np.zeros(len(tokens), bool)
        coded = [symbols(t) for t in tokens]
        best = np.max([k.score(coded) for k in self.kinds], axis=0)
        return best - self.other.score(coded) >= self.ratio

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """For each text its base and added spans, by start, then kind."""
        base = [base_spans(t) for t in texts]
        others = [open_tokens(t, b) for t, b in zip(texts, base)]
        likely = iter(self.likely([t[a:b] for t, o in zip(texts, others) for a, b in o]).tolist())
        rank = {k: i for i, k in enumerate((*KINDS, "format"))}
        return [sorted([(a, z, kind) for a, z, kind, _ in b] + [(a, z, "format") for a, z in o if next(likely)],
                       key=lambda s: (s[0], rank[s[2]])) for b, o in zip(base, others)]

    def column(self, text) -> F.Column:
        """array<struct<start,end,kind>> of a text column."""

        @pandas_udf("array<struct<start:int,end:int,kind:string>>")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                found = self.spans([t or "" for t in texts])
                yield pd.Series([[{"start": a, "end": b, "kind": k} for a, b, k in spans] for spans in found])
        return of(text)


def fit(docs: DataFrame, text: str = "text", sample: int = 500, ratio: float = 10.0) -> Formats:
    """Infer the formats from the credentials that the patterns label in all
    documents. Of each kind the ``sample`` distinct strings of least hash reach
    the driver, of ordinary tokens as many, of each its first ``LONGEST``
    characters; scoring is over whole tokens of any length."""
    found = docs.select(F.col(text).alias("text")).mapInArrow(_samples(sample), "kind string, value string, h long").distinct()
    found = Scratch(docs.sparkSession, "credentials").cut(found, "samples")
    values = {}
    for kind in (*KINDS, "other"):
        values[kind] = [r.value for r in found.filter(F.col("kind") == kind).orderBy("h", "value").limit(sample).collect()]
    # a credential may hold no symbol that its automaton has not seen; an ordinary token may
    return Formats([infer(values[k], smooth=1e-30) for k in KINDS if values.get(k)], infer(values["other"]) if values.get("other") else None, ratio)


def redact(docs: DataFrame, formats: Formats, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with each run of overlapping spans replaced by ``mark``."""

    @pandas_udf("string")
    def cleaned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for t, spans in zip(texts, formats.spans([t or "" for t in texts])):
                if spans:
                    parts, at = [], 0
                    for a, b, _ in spans:
                        if a >= at:
                            parts += [t[at:a], mark]
                        at = max(at, b)
                    t = "".join(parts) + t[at:]
                out.append(t)
            yield pd.Series(out, dtype=object)
    return docs.withColumn(text, cleaned(F.col(text)))
