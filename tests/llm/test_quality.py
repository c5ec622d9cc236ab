"""Quadratic discriminant: densities, held-out accuracy, odd inputs."""

import zlib

import numpy as np

from tablero.llm.queries import op3_quadratic_quality
from tablero.llm.quality import N_STATISTICS, Quadratic, fit, labelled, statistics, statistics_of

SCHEMA = "doc_id long, text string, x string, label int"


def test_scores_are_gaussian_posteriors(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(400, N_STATISTICS)) @ rng.normal(size=(N_STATISTICS, N_STATISTICS))
    b = rng.normal(1, 2, size=(300, N_STATISTICS))
    rows = [(0, x.tolist()) for x in a] + [(1, x.tolist()) for x in b]
    model = fit(spark.createDataFrame(rows, "label long, x array<double>").repartition(4), to_pooled=0, to_identity=0)
    x = np.concatenate((a[:20], b[:20]))

    def density(x, own, share):
        m, c = own.mean(axis=0), np.cov(own.T, bias=True)
        d = x - m
        return np.log(share) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d)
    want = 1 / (1 + np.exp(density(x, a, 4 / 7) - density(x, b, 3 / 7)))
    assert np.allclose(model.scores(x), want, atol=1e-6)


def test_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None, "c", 0), (1, "", "c", 0), (None, "a b", "c", 0), (7, "word " * 30000, "c", 0)], SCHEMA)
    stats = docs.select("doc_id", statistics_of("text").alias("x"))
    assert [len(r.x) for r in stats.collect()] == [N_STATISTICS] * 4
    assert np.isfinite(statistics("")).all()
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = fit(labelled(stats, none))
    assert {r.s for r in stats.select(model.column("x").alias("s")).collect()} == {0.5}
    one = spark.createDataFrame([(7, 1), (7, 1), (None, 0), (7, None), (7, 7)], "doc_id long, quality int")
    assert fit(labelled(stats, one)).share == 1.0
    empty = docs.filter("false").select("doc_id", statistics_of("text").alias("x"))
    assert empty.select(model.column("x")).count() == 0
    assert isinstance(model, Quadratic)


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op3_quadratic_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good = [p for p, q in held if q == 1]
    bad = [p for p, q in held if q == 0]
    print("held out", len(held), "kept of good", np.mean(good), "kept of bad", np.mean(bad))
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_query_against_shrunk_covariances(spark):
    """The query's scores from the definition: production shrinkage, plain inverses."""
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()]
    x = {i: np.array(statistics(t)) for i, t in texts.items()}
    own = [np.array([x[i] for i, q in labels if q == label and i in x and zlib.crc32(str(i).encode()) % 3 != 1]) for label in (0, 1)]
    both = np.concatenate(own)
    center, scale = both.mean(axis=0), np.sqrt(np.maximum(both.var(axis=0), 1e-12))
    z = [(a - center) / scale for a in own]
    covs = [np.cov(a.T, bias=True) for a in z]
    pooled = sum(len(a) * c for a, c in zip(z, covs)) / len(both)

    def log_density(v, a, cov):
        cov = 0.9 * cov + 0.1 * pooled
        cov = 0.99 * cov + 0.01 * np.trace(cov) / N_STATISTICS * np.eye(N_STATISTICS)
        d = v - a.mean(axis=0)
        return np.log(len(a) / len(both)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * d @ np.linalg.inv(cov) @ d
    rows = op3_quadratic_quality(spark, sf).collect()
    assert len(rows) == len(texts) and min(map(len, own)) > 5
    for r in rows:
        v = (x[r.doc_id] - center) / scale
        want = 1 / (1 + np.exp(np.clip(log_density(v, z[0], covs[0]) - log_density(v, z[1], covs[1]), -500, 500)))
        assert abs(r.score - want) < 1e-6
        assert (r.predicted, r.held_out) == (int(r.score >= 0.5), zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
