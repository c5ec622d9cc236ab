"""Extra columns whose names differ from an operator's own only in case, or hold
a dot, travel along or are replaced; nothing crashes."""

import pytest

from tablero.llm import decontam, mixing, repeats, simhash, tokens, urls
from tablero.llm._common import Scratch

EXTRA = ["a.b", "N_Tokens", "Kept", "Host", "_judged", "judged", "Taken", "TK", "content", "spans", "Rule"]
JUDGE = urls.Rule("||bad.org/", "block")


def docs(spark):
    cols = ", ".join(f"`{c}` string" for c in EXTRA)
    rows = [(1, "some words that are here", "s", "http://bad.org/x", 5, *EXTRA), (2, None, None, None, 0, *EXTRA),
            (1, "some words that are here", "s", "http://bad.org/x", 5, *EXTRA)]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, url string, size long, {cols}")


def run(name, df):
    import public_tokenizers
    spark = df.sparkSession
    if name == "repeats":
        return repeats.remove_repeats(df, length=8), ["text", "kept", "spans", "n_bytes", "n_removed"], ["n_bytes", "n_removed", "spans", "kept"]
    if name == "tokens":
        return (tokens.count_tokens(df, public_tokenizers.path("byte_bpe_50k.json"), f"{Scratch(spark, 'names').root}/cache"),
                ["text", "n_tokens", "n_bytes"], ["n_bytes", "n_tokens"])
    if name == "urls":
        return urls.judge(df, [JUDGE]), ["host", "path", "rule", "verdict", "n_tried"], ["host", "path", "rule", "verdict", "n_tried"]
    if name == "mixing":
        return mixing.mix(df), ["source_size", "target", "taken"], ["source_size", "target", "taken"]
    if name == "simhash":
        return simhash.keep_one(df), [], []
    return decontam.without_leaks(df, spark.createDataFrame([("q r s t u v",)], "text string")), [], []


@pytest.mark.parametrize("name", ["repeats", "tokens", "urls", "mixing", "simhash", "decontam"])
def test_names(spark, name):
    df = docs(spark)
    out, gone, added = run(name, df)
    assert out.columns == [c for c in df.columns if c.lower() not in gone] + added
    rows = out.collect()
    assert len(rows) == (2 if name == "simhash" else 3)
    left = [c for c in EXTRA if c.lower() not in gone]
    assert all(r[out.columns.index(c)] == c for r in rows for c in left)
