"""The corpus pipeline: quality classifier, near-duplicates, benchmark passages,
secrets, mixing.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the
columns of ``docs``; the last adds the mix's columns. ``run`` writes each
stage's rows to the shared folder and reads them again.

Null texts count as empty in every stage; extra columns travel along; an empty
table stays empty; rows equal in all columns are separate rows until the
near-duplicate stage, which keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablero.llm import credentials, decontam, mixing, quality, simhash
from tablero.llm._common import Scratch, fresh, read


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, fitted on the labelled ones among them outside
    the held-out part, gives a score of 0.5 or more."""
    stats = docs.select("doc_id", quality.statistics_of(F.col("text")).alias("x"))
    stats = Scratch(spark, "quality").cut(stats, "statistics")
    model = quality.fit(quality.labelled(stats, read(spark, sf_dir, "labels")))
    score = fresh(docs.columns, "score")
    return docs.withColumn(score, model.text_column(F.col("text"))).filter(F.col(score) >= 0.5).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontam.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets replaced by a mark; ``n_chars`` follows the text."""
    before, after = fresh(docs.columns, "before"), credentials.fit(docs)
    clean = credentials.redact(docs.withColumn(before, F.col("text")), after)
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col(before))
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the mix takes, with their size in words, their source's size
    and target, and how many words of theirs are taken (repeats counted).

    A row is not repeated or cut: one that is taken twice is one row, and one at
    the cut keeps its whole text. Only ``taken`` adds up to the target, so a
    reader must weight rows by it: ``floor(taken / size)`` whole passes over the
    text, then its first ``taken % size`` words."""
    size = fresh(docs.columns, "size")
    return mixing.mix(docs.withColumn(size, mixing.n_words("text")), size=size).filter("taken > 0")


STAGES = [
    ("quality", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark_passages),
    ("secrets", secrets),
    ("mix", mix_sources),
]

#: None: the stages train models, follow links and compare fingerprints; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = read(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.cut(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
