"""Quality rules as a short-circuit cascade.

Every rule is first timed and counted on a sample; the rules then run in order
of rejections per second, and a document stops at the first rule that rejects
it. The order decides what a verdict costs, never what it is.

Words are apart by ASCII white space. Null texts have none.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tablero.llm._common import texts_of

SYMBOLS = b"#*$%&|<>"
_WIDE = bytes(range(128, 192))  # bytes that go on a character
_MIX = 0x9E3779B97F4A7C15  # spreads word numbers over 64 bits
_LETTERS = bytes(range(65, 91)), bytes(range(97, 123))


def _without(raw: bytes, these: bytes) -> int:
    return len(raw.translate(None, these))


class Page:
    """A text and what rules ask of it, each worked out once when first asked."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def word_chars(self) -> int:
        return _without(b"".join(self.words), _WIDE)

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - _without(self.raw, SYMBOLS)

    @cached_property
    def lines(self) -> list[bytes]:
        return [s for s in self.raw.split(b"\n") if s.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside 8-word windows that the text has twice or more."""
        words, width = self.words, 8
        n = len(words) - width + 1
        if n < 2:
            return 0
        ids: dict[bytes, int] = {}
        coded = np.array([ids.setdefault(w, len(ids)) for w in words], np.uint64)
        if len(ids) == len(words):
            return 0
        mixed = (coded + np.uint64(1)) * np.uint64(_MIX)
        mixed ^= mixed >> np.uint64(29)
        h = np.zeros(n, np.uint64)
        for j in range(width):
            h = h * np.uint64(0xD6E8FEB86659FD93) + mixed[j : j + n]
        order = np.argsort(h)
        same = h[order][1:] == h[order][:-1]
        maybe = np.unique(np.concatenate((order[1:][same], order[:-1][same]))).tolist()
        seen = Counter(tuple(words[i : i + width]) for i in maybe)  # equal hashes are only candidates
        covered = np.zeros(len(words) + 1, np.int64)
        for i in maybe:
            if seen[tuple(words[i : i + width])] > 1:
                covered[i] += 1
                covered[i + width] -= 1
        return int((np.cumsum(covered) > 0).sum())

    @cached_property
    def n_echoes(self) -> int:
        """Words equal to the word before them."""
        return sum(a == b for a, b in zip(self.words, self.words[1:]))

    @property
    def base_failed(self) -> bool:
        n = len(self.words)
        return n < 20 or 100 * self.n_repeat_words > 30 * n


def _shouting(p: Page) -> bool:
    upper, lower = (len(p.raw) - _without(p.raw, x) for x in _LETTERS)
    return upper > lower


#: Each rule rejects where it is true.
RULES: dict[str, Callable[[Page], bool]] = {
    "word_length": lambda p: not 2 * len(p.words) <= p.word_chars <= 15 * len(p.words),
    "symbols": lambda p: 10 * p.n_symbols > len(p.words),
    "duplicate_lines": lambda p: 2 * p.n_dup_lines > len(p.lines),
    "echoes": lambda p: 5 * p.n_echoes > len(p.words),
    "shouting": _shouting,
}


def _trial(rules: dict[str, Callable[[Page], bool]]):
    """(rule, seconds, rejected) over a partition; each rule pays for all it needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, rejected = Counter(), Counter()
        for batch in batches:
            for raw in texts_of(batch.column(0)):
                for name, rule in rules.items():
                    page, began = Page(raw), time.perf_counter()
                    rejected[name] += bool(rule(page))
                    cost[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array(list(rules)), pa.array([float(cost[r]) for r in rules]), pa.array([rejected[r] for r in rules], pa.int64())],
                                         names=["rule", "seconds", "rejected"])
    return run


def plan(docs: DataFrame, text: str = "text", rules: dict[str, Callable[[Page], bool]] | None = None, sample: int = 2000) -> list[str]:
    """The rules by rejections per second on a sample of about ``sample`` rows;
    one row per rule reaches the driver."""
    rules = rules or RULES
    rows = docs.count()
    some = docs.select(F.col(text).alias("text")).sample(min(1.0, sample / max(rows, 1)), seed=11)
    found = some.mapInArrow(_trial(rules), "rule string, seconds double, rejected long").groupBy("rule").agg(
        F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()
    rate = {r.rule: r.rejected / max(r.seconds, 1e-9) for r in found}
    return sorted(rules, key=lambda r: (-rate.get(r, 0), r))


VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "kept boolean, rejected_by string")


def verdict(text, order: list[str], rules: dict[str, Callable[[Page], bool]] | None = None) -> F.Column:
    """A struct of the base counts, whether the base rule fails, whether the text
    is kept, and the first rule in ``order`` that rejects it (``base`` goes first)."""
    rules = rules or RULES

    @pandas_udf(VERDICT)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                p = Page((t or "").encode())
                by = "base" if p.base_failed else next((r for r in order if rules[r](p)), None)
                rows.append((len(p.words), p.word_chars, p.n_symbols, p.n_dup_lines, p.n_repeat_words, p.base_failed, by is None, by))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in VERDICT.split(", ")])
    return of(text)
