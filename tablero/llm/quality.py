"""Quality classifier: regularised quadratic discriminant analysis over
transformed statistics of whole documents.

Each class has a Gaussian whose covariance is shrunk towards the pooled one
and towards a multiple of the identity. A score is the logistic function of
the difference of two log densities, each from a Mahalanobis distance through
the inverse of a Cholesky factor that is computed once, at fitting time.

Null texts count as empty; an empty text has statistics like any other and a
score. Without a labelled row of either class every score is the share of
label 1 among the labelled rows (0.5 without any).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b".,;:!?'\"()-"
_WIDE = bytes(range(128, 192))  # bytes that go on a character


def _share(part: float, whole: float) -> float:
    """A proportion on the log-odds scale, with half a case added on each side."""
    return float(np.log((part + 0.5) / (max(whole - part, 0) + 0.5)))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    count = Counter(words)
    chars = len(raw.translate(None, _WIDE))
    inside = sum(map(len, words))
    lines = [s for s in raw.split(b"\n") if s.strip()]

    def of(these: bytes) -> int:
        return len(raw) - len(raw.translate(None, these))
    repeated = sum(a == b for a, b in zip(words, words[1:]))
    return [
        np.log1p(chars),
        np.log1p(n),
        np.log((inside + 1) / (n + 1)),
        _share(of(SYMBOLS), chars),
        _share(of(_UPPER), chars),
        _share(of(_DIGITS), chars),
        _share(of(_MARKS), chars),
        _share(raw.count(b"!"), chars),
        _share(raw.count(b"."), n + raw.count(b".")),
        _share(len(count), n),
        _share(repeated, n),
        _share(max(count.values(), default=0), n),
        _share(len(lines) - len(set(lines)), len(lines)),
        np.log((n + 1) / (len(lines) + 1)),
    ]


N_STATISTICS = len(statistics(""))


def statistics_of(text) -> F.Column:
    """The statistics of a text column, as an array."""

    @pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(t) for t in texts])
    return of(text)


@dataclass
class Quadratic:
    """Fitted classes, label 0 first: means, inverse Cholesky factors of the
    shrunk covariances, and each class's constant (log prior less half the log
    determinant). ``share`` stands alone where a class had no row."""

    share: float
    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray | None = None
    whiten: np.ndarray | None = None
    constants: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        z = (x - self.center) / self.scale
        dense = [c - 0.5 * ((((z - m) @ w.T) ** 2).sum(axis=1)) for m, w, c in zip(self.means, self.whiten, self.constants)]
        return 1 / (1 + np.exp(-np.clip(dense[1] - dense[0], -500, 500)))

    def column(self, x) -> F.Column:
        """Scores of a column of statistics."""

        @pandas_udf("double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for rows in batches:
                yield pd.Series(self.scores(np.array(rows.tolist(), float).reshape(-1, N_STATISTICS)))
        return of(x)

    def text_column(self, text) -> F.Column:
        """Scores of a column of texts."""

        @pandas_udf("double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(self.scores(np.array([statistics(t) for t in texts], float).reshape(-1, N_STATISTICS)))
        return of(text)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, place, value) sums of one partition: 1, x, and x by x."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        labels = np.asarray(batch.column(0).to_pylist(), int)
        x = np.array(batch.column(1).to_pylist(), float).reshape(-1, N_STATISTICS)
        one = np.concatenate((np.ones((len(x), 1)), x), axis=1)
        for label in np.unique(labels):
            own = one[labels == label]
            sums[int(label)] = sums.get(int(label), 0) + own.T @ own
    for label, s in sums.items():
        flat = s.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), label)), pa.array(np.arange(len(flat))), pa.array(flat)],
                                         names=["label", "place", "value"])


def fit(rows: DataFrame, to_pooled: float = 0.1, to_identity: float = 0.01) -> Quadratic:
    """Fit on all ``rows`` (label 0 or 1, statistics x). Spark sums the moments;
    the driver receives two matrices of N_STATISTICS + 1 rows. ``to_pooled`` and
    ``to_identity`` are the shrinkage shares of a class's covariance."""
    side = N_STATISTICS + 1
    total = np.zeros((2, side * side))
    moments = rows.mapInArrow(_moments, "label long, place long, value double").groupBy("label", "place").agg(F.sum("value").alias("value"))
    for r in moments.collect():  # 2 * side * side numbers at most
        total[r.label, r.place] = r.value
    total = total.reshape(2, side, side)
    n = total[:, 0, 0]
    share = float(n[1] / n.sum()) if n.sum() else 0.5
    none = np.zeros(N_STATISTICS)
    if n.min() < 1:
        return Quadratic(share, none, none + 1)
    means = total[:, 0, 1:] / n[:, None]
    center = total[:, 0, 1:].sum(axis=0) / n.sum()
    spread = np.diagonal(total[:, 1:, 1:].sum(axis=0)) / n.sum() - center**2
    scale = np.sqrt(np.maximum(spread, 1e-12))
    scatter = np.array([(t[1:, 1:] - c * np.outer(m, m)) / np.outer(scale, scale) for t, c, m in zip(total, n, means)])
    pooled = scatter.sum(axis=0) / n.sum()
    z_means = (means - center) / scale
    whiten, constants = [], []
    for c, s in zip(n, scatter):
        cov = (1 - to_pooled) * s / c + to_pooled * pooled
        ridge = max(np.trace(cov) / N_STATISTICS, 1e-6)
        cov = (1 - to_identity) * cov + to_identity * ridge * np.eye(N_STATISTICS)
        low = np.linalg.cholesky(cov)
        whiten.append(np.linalg.inv(low))
        constants.append(np.log(c / n.sum()) - np.log(np.diagonal(low)).sum())
    return Quadratic(share, center, scale, z_means, np.array(whiten), np.array(constants))


def held_out(doc_id) -> F.Column:
    """Rows whose labels no fit may see: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def labelled(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """Training rows (label, x): the statistics of labelled documents outside the
    held-out part. Labels other than 0 and 1, and null ids, are no labels."""
    known = labels.filter(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("id"), F.col(label).cast("long").alias("label"))
    rows = stats.filter(~held_out(doc_id)).select(F.col(doc_id).alias("id"), "x")
    return rows.join(known, "id").select("label", "x")
