"""Registered queries of the ``llm`` operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.llm import langid
from telemetra.llm.bpe import Tokenizer
from telemetra.llm.exact_dedup import exact_dedup
from telemetra.llm.hard_negatives import hard_negatives
from telemetra.llm.jaccard_join import jaccard_components
from telemetra.llm.lm_score import stupid_backoff
from telemetra.llm.mixing import mix, taken_words
from telemetra.llm.prefix_trie import numbered_turns, prefix_trie, rebuilt
from telemetra.llm.quality_rules import quality_rules
from telemetra.llm.secret_scan import secret_scan
from telemetra.llm.sharding import shard_by_bytes
from telemetra.llm.substring_dedup import remove_repeated
from telemetra.llm.suffix_dedup import remove_duplicates

#: Rank file of the registered tokenizer queries.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_duplicates(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def tokenizer(spark: SparkSession) -> Tokenizer:
    import public_tokenizers

    return Tokenizer(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def token_digests(codec: Tokenizer, docs: DataFrame) -> DataFrame:
    """Encode, decode the ids, and reduce both to digests."""
    return codec.decode(codec.encode(docs)).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(tokenizer(spark), documents(spark, sf_dir))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.predict(docs, langid.fit(docs))


def op6_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(documents(spark, sf_dir), n_shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stupid_backoff(documents(spark, sf_dir))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(*mix(documents(spark, sf_dir))).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(documents(spark, sf_dir))


def op11_substring_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, "vec_id", "embedding", label, anchor=F.col("vec_id") % 50 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_language_id": op5_language_id,
    "op6_histogram_sort_shards": op6_histogram_sort_shards,
    "op7_stupid_backoff": op7_stupid_backoff,
    "op8_source_mix": op8_source_mix,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_substring_doubling": op11_substring_doubling,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op2_quality_rules": """
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
grams AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cover AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
c AS (
  SELECT d.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN cover USING (doc_id)),
f AS (
  SELECT *, CAST(n_words < 10 AS INT) AS f1, CAST(100 * n_repeat_words > 20 * n_words AS INT) AS f2,
         CAST(10 * n_symbols > n_words AS INT) AS f3, CAST(100 * n_dup_lines > 30 * n_lines AS INT) AS f4
  FROM c),
long AS (
  SELECT source, r, count(*) AS n, sum(bad) AS k
  FROM (SELECT source, unnest(['short', 'repeats', 'symbols', 'dup_lines']) AS r, unnest([f1, f2, f3, f4]) AS bad FROM f)
  GROUP BY source, r),
prior AS (
  SELECT r, m, CASE WHEN v > 0 THEN greatest(1.0, least(1e6, m * (1 - m) / v - 1)) ELSE 1e6 END AS s
  FROM (SELECT r, sum(k) / sum(n) AS m,
               sum(1.0 * k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2
               - (sum(k) / sum(n)) * (1 - sum(k) / sum(n)) * count(*) / sum(n) AS v
        FROM long GROUP BY r)),
rate AS (
  SELECT source, max(n) AS host_docs,
         max(CASE WHEN r = 'short' THEN (k + m * s) / (n + s) END) AS rate_short,
         max(CASE WHEN r = 'repeats' THEN (k + m * s) / (n + s) END) AS rate_repeats,
         max(CASE WHEN r = 'symbols' THEN (k + m * s) / (n + s) END) AS rate_symbols,
         max(CASE WHEN r = 'dup_lines' THEN (k + m * s) / (n + s) END) AS rate_dup_lines
  FROM long JOIN prior USING (r) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       f1 + f2 > 0 AS base_failed,
       f1 + f2 = 0 AND greatest(rate_short, rate_repeats, rate_symbols, rate_dup_lines) <= 0.5 AS kept,
       host_docs, round(rate_short, 6) AS rate_short, round(rate_repeats, 6) AS rate_repeats,
       round(rate_symbols, 6) AS rate_symbols, round(rate_dup_lines, 6) AS rate_dup_lines
FROM f JOIN rate ON f.source IS NOT DISTINCT FROM rate.source
""",
    "op7_stupid_backoff": """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
t AS (
  SELECT doc_id, w[i] AS w, CASE WHEN i = 1 THEN ' ' ELSE w[i - 1] END AS v,
         CASE WHEN i <= 2 THEN ' ' ELSE w[i - 2] END AS u
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
n AS (SELECT count(*) AS docs FROM d WHERE len(w) > 0),
uni AS (SELECT w, count(*) AS c FROM t GROUP BY w),
own3 AS (SELECT doc_id, u, v, w, count(*) AS cd3 FROM t GROUP BY doc_id, u, v, w),
own2 AS (SELECT doc_id, v, w, sum(cd3) AS cd2 FROM own3 GROUP BY doc_id, v, w),
big AS (SELECT v, w, sum(cd2) AS c2 FROM own2 GROUP BY v, w),
tri AS (SELECT u, v, w, sum(cd3) AS c3 FROM own3 GROUP BY u, v, w),
ctx1 AS (SELECT w AS v, c AS b1 FROM uni UNION ALL SELECT ' ', docs FROM n),
ctx2 AS (SELECT v AS u, w AS v, c2 AS b2 FROM big UNION ALL SELECT ' ', ' ', docs FROM n),
s AS (
  SELECT doc_id, sum(cd3 * CAST(round(1e6 * log10(CASE
           WHEN c3 > cd3 THEN CAST(c3 - cd3 AS DOUBLE) / b2
           WHEN c2 > cd2 THEN CAST(0.4 AS DOUBLE) * (CAST(c2 - cd2 AS DOUBLE) / b1)
           ELSE CAST(0.4 AS DOUBLE) * CAST(0.4 AS DOUBLE) * (CAST(uni.c AS DOUBLE) / (SELECT count(*) FROM t)) END))
         AS BIGINT)) AS score
  FROM own3 JOIN own2 USING (doc_id, v, w) JOIN tri USING (u, v, w) JOIN big USING (v, w)
       JOIN ctx1 USING (v) JOIN ctx2 USING (u, v) JOIN uni USING (w) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(CAST(score AS DOUBLE), 0) / 1e6 AS log_score,
       round(CAST(score AS DOUBLE) / 1e6 / len(w), 6) AS mean_score
FROM d LEFT JOIN s USING (doc_id)
""",
    "op9_exact_dedup": """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_cp DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY n_cp DESC, doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n
""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
""",
    "op13_prefix_trie": """
WITH o AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
v AS (
  SELECT c, max(pos) AS n, c - c % 100 AS base,
         xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
             lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 6 AS h
  FROM o GROUP BY c),
w AS (SELECT v.c, v.base, v.h, least(v.h, coalesce(b.n, 0)) AS shared FROM v LEFT JOIN v b ON b.c = v.base),
r AS (
  SELECT w.c, o.pos, role, text FROM w JOIN o ON o.c = w.base AND o.pos <= w.h
  UNION ALL SELECT w.c, o.pos - w.h + w.shared, role, text FROM w JOIN o ON o.c = w.c AND o.pos > w.h),
s AS (
  SELECT w.c, coalesce(x, []) AS s
  FROM w LEFT JOIN (SELECT c, list({'role': role, 'text': text} ORDER BY pos) AS x FROM r GROUP BY c) USING (c)),
n AS (
  SELECT d, s[1:d] AS k, min(c) AS c, count(*) AS n
  FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM s) GROUP BY d, k),
kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
val AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN d = 0 THEN 0 ELSE (n - 1) * length(k[d].text) END AS saved
  FROM n LEFT JOIN kids USING (d, k)),
sub AS (
  SELECT a AS d, k[1:a] AS k, sum(CAST(n_children = 0 AS INT)) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM val) GROUP BY 1, 2),
ends AS (
  SELECT CAST(len(s) AS BIGINT) AS d, s AS k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS e FROM s GROUP BY s)
SELECT val.c AS conv_id, val.d AS depth, p.c AS parent_conv_id, val.n AS n_convs, val.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       coalesce(e, sha256('')) AS ends_sha256
FROM val JOIN sub USING (d, k) LEFT JOIN n p ON p.d = val.d - 1 AND p.k = val.k[1:val.d - 1]
LEFT JOIN ends ON ends.d = val.d AND ends.k = val.k
""",
}
