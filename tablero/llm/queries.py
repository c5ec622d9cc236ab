"""The registered queries of the training-data operators: each applies one
operator with production parameters to its whole table and derives the
contract's columns from what the operator returns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablero.llm import cascade, chat, collocations, credentials, decontam, divergence, minhash, mixing, quality, repeats, simhash, tokens, urls
from tablero.llm._common import Scratch, read, text_key


def op1_run_length_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    found = repeats.repeated_spans(docs, "text", 400).select(
        "tk", repeats.removed_bytes(F.col("spans")).alias("removed"), F.size("spans").alias("runs"), F.sha2("kept", 256).alias("kept_digest"))
    own = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text_key(F.col("text")).alias("tk"),
                      F.sha2(text, 256).alias("digest"))
    return own.join(found, "tk", "left").select(
        "doc_id", "n_bytes", F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("runs", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_digest", "digest").alias("kept_sha256"))


def op2_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op3_quadratic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", quality.statistics_of(F.col("text")).alias("x"))
    stats = Scratch(spark, "quality").cut(docs, "statistics")
    model = quality.fit(quality.labelled(stats, read(spark, sf_dir, "labels")))
    scored = stats.select("doc_id", quality.held_out("doc_id").alias("held_out"), model.column(F.col("x")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_digest_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache is new for each call, so that every call counts all it is given."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    cache = f"{Scratch(spark, 'tokens').root}/cache"
    counted = tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), cache)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op5_hamming_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "start_word", "n_words")


def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    order = cascade.plan(docs)
    judged = docs.select("doc_id", cascade.verdict(F.col("text"), order).alias("v"))
    return judged.select("doc_id", *(f"v.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


#: The contract's rules, then the method's: places of pages that are no prose, and unwanted hosts.
HOST_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
PATTERN_RULES = ["||spam-", "||adult-", "||casino-", "||ads.", "||track.", "/ads/", "/login/", "/cart/", "/wp-admin/", "/cgi-bin/", "/search/*/tag/"]


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urls.host_rule(v, p) for v, p in HOST_RULES] + [urls.Rule(p) for p in PATTERN_RULES]
    return urls.judge(read(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op8_prefix_sum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words("text").alias("size"))
    mixed = mixing.mix(Scratch(spark, "mix").cut(docs, "sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _number(kind: str) -> Column:
    return F.size(F.filter("s", lambda s: s["kind"] == kind)).cast("long")


def op9_inferred_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = docs.select("doc_id", credentials.fit(docs).column(F.col("text")).alias("s"))
    base = F.filter("s", lambda s: s["kind"] != "format")
    return found.select("doc_id", *(_number(k).alias(f"n_{k}") for k in credentials.KINDS),
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("s")).alias("spans"))


def op10_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') "
                      "AS t(conv_id, turn, role, text)")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    node = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    chain = turns.select("conv_id", node.alias("node"), "role", "text").withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
    out = chat.format_trees(chain, top=None)
    back, masked = chat.read_turns(F.col("formatted")), chat.masked_text(F.col("formatted"), F.col("loss_mask"))
    told = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.withColumns({"back": back, "masked": masked}).select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op11_packed_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.compare_edited(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                        minhash.hex_digits(F.col("fp")).alias("fingerprint"), minhash.hex_digits(F.col("edited_fp")).alias("edited_fingerprint"),
                        "near_edited", "near_next")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read(spark, sf_dir, "documents"), min_docs=30, top=50)


def op13_setm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


REGISTRY = {f.__name__: f for f in (
    op1_run_length_dedup, op2_gray_simhash, op3_quadratic_quality, op4_digest_token_counts, op5_hamming_decontamination,
    op6_quality_cascade, op7_url_rules, op8_prefix_sum_mix, op9_inferred_secrets, op10_reply_trees,
    op11_packed_minhash, op12_source_divergence, op13_setm_collocations,
)}

#: DuckDB SQL by query, for those that SQL can express.
ORACLES: dict[str, str] = {
    "op6_quality_cascade": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS ls FROM d),
e AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM w),
v AS (SELECT *, lag(word) OVER o AS prior, CASE WHEN i + 8 <= n THEN string_agg(word, ' ') OVER (o ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) END AS win
      FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 AS twice FROM v),
c AS (SELECT *, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS covered FROM r),
p AS (SELECT doc_id, count(*) FILTER (WHERE covered) AS n_repeat_words, count(*) FILTER (WHERE word = prior) AS echoes FROM c GROUP BY doc_id),
b AS (SELECT w.doc_id, t, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             len(ls) AS n_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(echoes, 0) AS echoes
      FROM w LEFT JOIN p ON p.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR 5 * echoes > n_words OR length(regexp_replace(t, '[^A-Z]', '', 'g')) > length(regexp_replace(t, '[^a-z]', '', 'g'))) AS kept
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
""",
    "op7_url_rules": r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
f AS (SELECT *, CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
                     WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
                     WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
                     WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
                     WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_matches(host || path, '^([^/]*\.)?(spam-|adult-|casino-|ads\.|track\.)')
              OR regexp_matches(host || path, '/(ads|login|cart|wp-admin|cgi-bin)/|/search/.*/tag/') THEN 'block' ELSE 'allow' END AS verdict
FROM f
""",
    "op8_prefix_sum_mix": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '') || 'mix') AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS total FROM d GROUP BY source),
k AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, total * 2.0::DOUBLE AS most FROM s),
l AS (SELECT *, (sum(total) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
      FROM k WINDOW o AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, total, least(most, weight * max(level) OVER ()) AS target FROM l),
r AS (SELECT doc_id, size, total, target, round(target)::BIGINT AS aim,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, total AS source_size, target,
       (CASE WHEN total > 0 THEN aim // total * size + greatest(0, least(size, aim % total - ahead)) ELSE 0 END)::BIGINT AS taken FROM r
""",
    "op10_reply_trees": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
           VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS n,
             length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS r FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' THEN n + 7 ELSE r + n + 17 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op12_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT id, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT lang, source, term, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total,
                 count(*) OVER (PARTITION BY lang, source) AS v FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS p FROM cells),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (sum(total) + 5 * any_value(v)) AS q FROM cells GROUP BY lang, term),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 50
""",
    "op13_setm_collocations": r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
                  regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT id, lang, unnest(pieces) AS piece, unnest(range(len(pieces))) AS k FROM d),
w AS (SELECT id, lang, k, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
o AS (SELECT id, lang, k, unnest(w) AS word, unnest(range(len(w))) AS pos FROM w),
s AS (SELECT lang, word AS w1, lead(word, 1) OVER x AS w2, lead(word, 2) OVER x AS w3, lead(word, 3) OVER x AS w4, lead(word, 4) OVER x AS w5
      FROM o WINDOW x AS (PARTITION BY id, k ORDER BY pos)),
a AS (SELECT lang, unnest([w1, w1 || ' ' || w2, w1 || ' ' || w2 || ' ' || w3, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4,
                           w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5]) AS phrase FROM s),
n AS (SELECT lang, count(*) AS n FROM s GROUP BY lang),
f AS (SELECT lang, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM a WHERE phrase IS NOT NULL GROUP BY lang, phrase HAVING count(*) >= 100),
i AS (SELECT DISTINCT lang, f, array_to_string(w[x : y], ' ') AS phrase FROM f, range(1, 6) b(x), range(1, 6) e(y)
      WHERE y <= len(w) AND x < y AND y - x + 1 < len(w)),
c AS (SELECT * FROM f WHERE len(w) > 1 AND NOT EXISTS (SELECT 1 FROM i WHERE i.lang = f.lang AND i.phrase = f.phrase AND i.f >= f.f)),
t AS (SELECT c.lang, c.phrase, c.f AS a, cut, l.f AS l, r.f AS r, n.n,
             (1000::HUGEINT * c.f * n.n) // (l.f::HUGEINT * r.f) AS score
      FROM c, range(1, 5) k(cut), f l, f r, n
      WHERE cut < len(c.w) AND l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : cut], ' ')
        AND r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1 :], ' ') AND n.lang = c.lang),
m AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM m)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM z WHERE rank <= 2000
""",
}
