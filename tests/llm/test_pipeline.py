"""Pipeline stages: each decision against brute force, odd inputs, columns kept."""

from collections import defaultdict

import pytest

import corpus_pipeline as pipeline
from tablero.llm.mixing import n_words
from tablero.llm.quality import fit, labelled, statistics_of

from .test_credentials import brute as secrets_of
from .test_decontam import brute as leaks_of
from .test_simhash import brute_components, plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(10**6 + i, t, None, None, None) for i, t in enumerate([None, "", None, "token = 'abcdefghijkl0123'", "w " * 20000])]
    odd = spark.createDataFrame(rows, base.schema)
    return base.unionByName(base.limit(3)).unionByName(odd).selectExpr("*", "'x' AS score", "1 AS size", "'t' AS tk", "0 AS taken_").cache()


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_names_and_registration():
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_duplicates", "benchmark", "secrets", "mix"]


@pytest.mark.parametrize("k", range(4))
def test_columns_and_empty_tables(spark, docs, k):
    out = pipeline.STAGES[k][1](spark, docs.limit(0), SF)
    assert out.schema.simpleString() == docs.schema.simpleString() and out.count() == 0


def test_quality(spark, docs):
    stats = docs.select("doc_id", statistics_of("text").alias("x"))
    model = fit(labelled(stats, spark.read.parquet(f"{SF}/labels.parquet")))
    good = {r.doc_id for r in stats.select("doc_id", model.column("x").alias("s")).collect() if r.s >= 0.5}
    out = pipeline.quality_classifier(spark, docs, SF)
    assert out.columns == docs.columns
    assert rows_of(out) == rows_of(docs.filter(docs.doc_id.isin(list(good))))
    assert 0 < len(good) < docs.count()


def test_near_duplicates(spark, docs):
    rows = docs.collect()
    least = brute_components([(r.doc_id, plain(r.text)) for r in rows])
    out = pipeline.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(least))


def test_benchmark(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _ in leaks_of([(r.doc_id, r.text) for r in docs.collect()], items)}
    out = pipeline.benchmark_passages(spark, docs, SF)
    assert out.columns == docs.columns and bad
    assert rows_of(out) == rows_of(docs.filter(~docs.doc_id.isin(list(bad))))


def test_secrets(spark, docs):
    out = pipeline.secrets(spark, docs, SF)
    assert out.schema.simpleString() == docs.schema.simpleString()
    before = {r.doc_id: r for r in docs.collect()}
    changed = 0
    for r in out.collect():
        old = before[r.doc_id]
        if secrets_of(old.text):
            assert not any(k in ("access", "hex") for _, _, k in secrets_of(r.text)) and r.n_chars == len(r.text)
            changed += 1
        elif r.text == old.text:
            assert r == old
    assert changed and out.count() == docs.count()


def test_mix(spark, docs):
    out = pipeline.mix_sources(spark, docs, SF)
    assert out.columns[:len(docs.columns)] == docs.columns and out.columns[len(docs.columns):] == ["size_", "source_size", "target", "taken"]
    taken, target = defaultdict(int), {}
    for r in out.collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 < r.taken <= 2 * r.size_
    assert all(taken[s] == round(target[s]) for s in target)
    words = docs.select(n_words("text").alias("n")).groupBy().sum().first()[0]
    assert sum(taken.values()) == pytest.approx(1.5 * words, abs=len(taken))


def test_mix_rows_must_be_weighted_by_taken(spark):
    docs = spark.createDataFrame([(i, "a" if i < 10 else "b", f"{i} " + "w " * (i % 7)) for i in range(200)], "doc_id long, source string, text string")
    rows = pipeline.mix_sources(spark, docs, SF).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    passes = {s: sum(len((r.text.split() * 2)[:r.taken]) for r in rows if r.source == s) for s in "ab"}
    assert passes == {r.source: round(r.target) for r in rows} and passes["a"] == 2 * sum(r["size"] for r in rows if r.source == "a")
    assert "weight rows by it" in " ".join(pipeline.mix_sources.__doc__.split())


def test_run_chains_the_stages(spark):
    out = pipeline.run(spark, SF)
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == len(set(ids)) > 50
    step = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipeline.STAGES:
        step = stage(spark, step, SF)
    assert rows_of(out) == rows_of(step)
