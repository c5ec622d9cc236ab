"""Token counts: the library's own counts, distinct misses, a cache that fills."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablero.llm.queries import op4_digest_token_counts
from tablero.llm.tokens import _counter, count_tokens

SCHEMA = "doc_id long, text string, content string, n int"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_and_cache(spark, tmp_path, name):
    texts = [None, "", "Hello, world", "Hello, world", "a <|endoftext|> b", "<s> é 😀\n\n\t x", "word " * 20000]
    path, cache = public_tokenizers.path(name), str(tmp_path / "cache")
    if name.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(model.encode(t or "")) for t in texts]
    else:
        model = Tokenizer.from_file(path)
        want = [len(model.encode(t or "", add_special_tokens=False).ids) for t in texts]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    out = count_tokens(docs, path, cache)
    assert out.columns == ["doc_id", "content", "n", "n_bytes", "n_tokens"]
    assert [(r.n_bytes, r.n_tokens) for r in out.orderBy("doc_id").collect()] == [(len((t or "").encode()), n) for t, n in zip(texts, want)]
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for t in texts})  # each distinct content once
    more = spark.createDataFrame([(9, "Hello, world", "c", 1), (10, "new text", "c", 1)], SCHEMA)
    assert count_tokens(more, path, cache).count() == 2
    assert spark.read.parquet(cache).count() == stored + 1  # only the miss


def test_pieces_count_like_whole_texts():
    """Spaces of all kinds, contractions and special strings: the pieces' counts add up to the library's."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        count = _counter(f.read(), "tokenizers")
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    parts = ["a", "it's", "'s", "é", "ß", "日本", "123", "--", " ", "  ", "\n", "\t", "\u3000", "\u180e", "\x85", "<|endoftext|>", "😀", "longer", "x" * 70]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(12))) for _ in range(3000)]
    for _ in range(2):  # then from memory
        assert count(texts) == [len(model.encode(t, add_special_tokens=False).ids) for t in texts]


def test_empty_table_and_versions(spark, tmp_path):
    docs, cache = spark.createDataFrame([], SCHEMA), str(tmp_path / "cache")
    assert count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), cache).count() == 0
    one = spark.createDataFrame([(1, "Hello World", "c", 1)], SCHEMA)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        assert count_tokens(one, public_tokenizers.path(name), cache).first().n_tokens == 2
    assert spark.read.schema("tokenizer string").parquet(cache).distinct().count() == 2


def test_query_is_the_library(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op4_digest_token_counts(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for d, e in zip(docs, model.encode_batch([d.text or "" for d in docs], add_special_tokens=False)):
        r = rows[d.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((d.text or "").encode()), len(e.ids), len(e.ids) > 1024)
    assert len(rows) == len(docs)
