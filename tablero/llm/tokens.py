"""Token counts through a digest cache.

A count is stored under the digest of the content and the digest of the
tokenizer's version. Documents are reduced to digests, joined to the stored
counts, and only distinct contents that no earlier run has counted are
encoded, each once, and appended to the cache.

Null texts count as empty (no tokens). Rows with equal texts share one count.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from importlib.metadata import version

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablero.llm._common import Scratch, fresh, local_env, others, slices, text_key, texts_of

CACHE = "tokenizer string, content binary, n_tokens long"


@lru_cache(maxsize=2)
def _counter(vocabulary: bytes, library: str):
    """A function from a list of texts to their token counts: no begin, end or
    added tokens, no truncation, no padding."""
    local_env()
    if library == "sentencepiece":
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer
    model = Tokenizer.from_str(vocabulary.decode())
    model.no_truncation()
    model.no_padding()

    def whole(texts: list[str]) -> list[int]:
        return [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
    return _by_pieces(whole) if _splits_at_spaces(model) else whole


#: A space between two visible characters: no byte-level BPE token crosses it from the left.
_SPACE = re.compile("(?<=[!-~\u00c0-\u024f]) (?=[!-~\u00c0-\u024f])")


def _splits_at_spaces(model) -> bool:
    """The byte-level pre-tokenizer starts a new token at a space between two
    visible characters, unless a normalizer or an added token interferes."""
    rule = str(model.pre_tokenizer)
    added = model.get_added_tokens_decoder().values()
    return (model.normalizer is None and rule.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in rule
            and not any(a.lstrip or a.rstrip or a.single_word or " " in a.content for a in added))


def _by_pieces(whole, most: int = 1 << 20, longest: int = 64):
    """Counts of texts as sums over their pieces between such spaces, each piece
    encoded by the library once and remembered (``most`` of them)."""
    known: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        pieces = [_SPACE.split(t) for t in texts]
        missing = list(set().union(*(p[1:] for p in pieces)) - known.keys())
        known.update(zip(missing, whole([" " + p for p in missing])))
        first = whole([p[0] for p in pieces])
        out = [a + sum(map(known.__getitem__, p[1:])) for a, p in zip(first, pieces)]
        if len(known) > most:
            known.clear()
        else:
            for p in missing:
                if len(p) > longest:
                    del known[p]
        return out
    return count


def tokenizer_version(vocabulary: bytes, library: str) -> str:
    """Digest of what decides a count: the vocabulary file and the library's release."""
    return hashlib.sha256(vocabulary + f"\n{library} {version(library)}".encode()).hexdigest()


def _encode(vocabulary, library: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(vocabulary.value, library)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                n = count([t.decode() for t in texts_of(part.column(1))])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64())], names=["content", "n_tokens"])
    return run


def _stored(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """One row for each content counted so far; none before the first run."""
    try:
        spark.read.parquet(cache)
    except AnalysisException:
        return spark.createDataFrame([], "content binary, n_tokens long")
    rows = spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == tokenizer)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))  # two runs may have counted the same


def count_tokens(docs: DataFrame, vocabulary_path: str, cache: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_bytes`` and ``n_tokens`` (long).

    ``vocabulary_path``: a .json of ``tokenizers`` or a .model of
    ``sentencepiece`` on the driver; its bytes, some MB, travel as a broadcast.
    ``cache``: a folder that driver and executors share; new counts are
    appended to it before the result is returned. Columns called ``n_bytes`` or
    ``n_tokens``, in any case, are replaced; others travel along.
    """
    spark = docs.sparkSession
    library = "sentencepiece" if vocabulary_path.endswith(".model") else "tokenizers"
    with open(vocabulary_path, "rb") as f:
        vocabulary = f.read()
    tokenizer = tokenizer_version(vocabulary, library)
    value = F.coalesce(F.col(text), F.lit(""))
    key = fresh(docs.columns, "content")
    distinct = docs.select(text_key(F.col(text)).alias("content"), value.alias("text")).groupBy("content").agg(F.first("text").alias("text"))
    misses = distinct.join(_stored(spark, cache, tokenizer).select("content"), "content", "left_anti")
    counted = misses.mapInArrow(_encode(spark.sparkContext.broadcast(vocabulary), library), "content binary, n_tokens long")
    counted.select(F.lit(tokenizer).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(cache)
    # written once more, so that the join below may split the rows of a frequent text
    counts = Scratch(spark, "tokens").cut(_stored(spark, cache, tokenizer), "counts")
    n = fresh([*docs.columns, key], "n")
    own = others(docs.columns, text, "n_bytes", "n_tokens")
    rows = docs.select(*own, F.octet_length(value).cast("long").alias("n_bytes"), text_key(F.col(text)).alias(key))
    return rows.join(counts.select(F.col("content").alias(key), F.col("n_tokens").alias(n)), key, "left").select(
        *own, "n_bytes", F.col(n).alias("n_tokens"))
