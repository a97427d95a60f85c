"""The driver's queries: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildhall.llm import _util, lang_id, toxicity
from gildhall.llm.ann import nearest
from gildhall.llm.bpe import encode_documents
from gildhall.llm.collocations import collocations
from gildhall.llm.exact_dedup import exact_duplicates
from gildhall.llm.license_scan import digest, scan
from gildhall.llm.lm_score import score_documents
from gildhall.llm.packing import pack_documents
from gildhall.llm.prefix_trie import prefix_trie, turn_sequences, with_shared_heads
from gildhall.llm.simhash_dedup import near_duplicates
from gildhall.llm.substring_dedup import remove_earlier
from gildhall.llm.suffix_dedup import remove_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return add


@query("op5_exact_dedup", oracle=r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY len DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_util.documents(spark, sf_dir))


@query("op2_lang_id")
def op2_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _util.documents(spark, sf_dir)
    out = _util.held_out(F.col("doc_id"), 4, 2)
    model = lang_id.fit(docs, ~out)
    return lang_id.predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query("op7_simhash_dedup")
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_util.documents(spark, sf_dir))


@query("op10_substring_dedup", oracle=r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
win AS (
  SELECT doc_id, s, md5(array_to_string(list_slice(words, s, s + 49), ' ')) AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM w)),
earliest AS (SELECT k, min(doc_id) AS first_id FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM win JOIN earliest USING (k) WHERE doc_id > first_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w) ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, (len(w.words) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""")
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_earlier(_util.documents(spark, sf_dir)).drop("kept_text")


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_util.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_util.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            public_tokenizers.PATTERN, keep=False)


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_util.documents(spark, sf_dir), keep=False)


@query("op6_lm_score")
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_util.documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"),
                           _util.held_out(F.col("doc_id"), 7, 2))


@query("op8_ann")
def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(table, F.col("vec_id") % 20 == 0)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _util.documents(spark, sf_dir)
    out = _util.held_out(F.col("doc_id"), 4, 2)
    net = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~out)
    return toxicity.score_documents(docs, net).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op11_prefix_trie", oracle=r"""
WITH named AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS name
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (
  SELECT conv_id, name, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) - 1 AS j
  FROM named),
c AS (
  -- crc32 of the decimal digits, bit by bit
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
           list_prepend(4294967295, flatten([[ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0] for ch in string_split(conv_id::VARCHAR, '')])),
           lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384))) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
s AS (
  SELECT c.conv_id, 0 AS part, t.j, t.name, t.words FROM c JOIN t ON t.conv_id = c.base AND t.j < c.h
  UNION ALL SELECT c.conv_id, 1, t.j, t.name, t.words FROM c JOIN t ON t.conv_id = c.conv_id AND t.j >= c.h),
seq AS (
  SELECT conv_id, list(name ORDER BY part, j) AS names, list(words ORDER BY part, j) AS words FROM s GROUP BY conv_id),
p AS (
  SELECT conv_id, d, array_to_string(list_slice(names, 1, d), ',') AS prefix,
         CASE WHEN d > 0 THEN array_to_string(list_slice(names, 1, d - 1), ',') END AS parent,
         CASE WHEN d > 0 THEN words[d] ELSE 0 END AS w, d = coalesce(len(names), 0) AS ends
  FROM (SELECT c.conv_id, names, words, unnest(range(0, coalesce(len(names), 0) + 1)) AS d FROM c LEFT JOIN seq USING (conv_id))),
node AS (
  SELECT d, prefix, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(w) AS w,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY d, prefix),
kids AS (SELECT d - 1 AS d, parent AS prefix, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
full_node AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (d, prefix)),
sub AS (
  SELECT up.d, up.prefix, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.w) AS saved
  FROM full_node f JOIN p up ON up.conv_id = f.conv_id AND up.d <= f.d GROUP BY ALL)
SELECT f.conv_id, f.d::BIGINT AS depth, par.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       sub.n_leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM full_node f JOIN sub USING (d, prefix) LEFT JOIN node par ON par.d = f.d - 1 AND par.prefix = f.parent
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = turn_sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie(*with_shared_heads(sequences)).drop("name")


@query("op12_license_scan")
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(_util.documents(spark, sf_dir)))


@query("op13_collocations", oracle=r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (
  SELECT lang, words, len(words) AS size
  FROM (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM piece)),
gram AS (
  SELECT lang, k, array_to_string(list_slice(words, s, s + k - 1), ' ') AS phrase
  FROM (SELECT lang, words, size, k, unnest(range(1, size - k + 2)) AS s FROM w, (SELECT unnest(range(1, 6)) AS k))),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM gram GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, sum(size)::HUGEINT AS n FROM w GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
covered AS (
  SELECT lang, array_to_string(list_slice(words, s, s + m - 1), ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, k, words, a, m, unnest(range(1, k - m + 2)) AS s
        FROM (SELECT lang, k, words, a, unnest(range(2, k)) AS m FROM cand))
  GROUP BY ALL),
cut AS (
  SELECT c.lang, c.phrase, c.a, c.c, l.f AS l, r.f AS r, t.n, (1000 * c.a * t.n) // (l.f * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS c FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.words, 1, c.c), ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.words, c.c + 1, c.k), ' ')
  JOIN total t ON t.lang = c.lang),
weakest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (
  SELECT weakest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM weakest LEFT JOIN covered USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_util.documents(spark, sf_dir))
