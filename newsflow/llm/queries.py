"""The queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import align, collocations, exact_dedup, lexicon, line_dedup, near_dup, packing, pii, planes, quality, sharding, token_counts, toxicity
from newsflow.llm.common import documents
from newsflow.session import written

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.verdicts(exact_dedup.build(documents(spark, sf_dir)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    return toxicity.score(docs, model).withColumn("held_out", F.coalesce(toxicity.held_out(), F.lit(False)))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.lengths(documents(spark, sf_dir), BYTE_TOKENIZER)
    return token_counts.suffix_sums(written(token_counts.histogram(counted), "lengths"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(documents(spark, sf_dir), sharding.fill())


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.digests(pii.find(docs, pii.train(docs)))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return lexicon.digests(lexicon.round_trip(docs, BYTE_TOKENIZER, lexicon.build(docs, BYTE_TOKENIZER)))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(documents(spark, sf_dir), WORD_TOKENIZER))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(documents(spark, sf_dir))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op11_binary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.digests(planes.read(planes.write(documents(spark, sf_dir), WORD_TOKENIZER)))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(documents(spark, sf_dir), align.vocabularies(BYTE_TOKENIZER, PIECE_MODEL))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup, "op2_toxicity": op2_toxicity, "op3_token_counts": op3_token_counts, "op4_sharding": op4_sharding, "op5_pii": op5_pii,
    "op6_bpe": op6_bpe, "op7_near_dup": op7_near_dup, "op8_packing": op8_packing,
    "op9_line_dedup": op9_line_dedup, "op10_quality": op10_quality, "op11_binary_ids": op11_binary_ids, "op12_collocations": op12_collocations, "op13_token_alignment": op13_token_alignment,
}

OP1_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
g AS (SELECT h, arg_min(doc_id, (-n, doc_id)) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM d JOIN g USING (h)
"""

OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
s AS (SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS t FROM l),
k AS (SELECT *, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM s),
common AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM k LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP10_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, string_split(t, chr(10)) AS ls FROM d),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w),
g3 AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram FROM g),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g3) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS x(o) GROUP BY doc_id),
l AS (SELECT doc_id, source, md5(t) AS h, unnest(ls) AS line FROM w),
k AS (
  SELECT doc_id, source, h, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM k GROUP BY doc_id),
held AS (SELECT source, key, count(DISTINCT h) AS n FROM k GROUP BY source, key),
common AS (SELECT source, key FROM held WHERE n > 50),
lost AS (SELECT doc_id, sum(words) AS gone FROM k JOIN common ON k.source IS NOT DISTINCT FROM common.source AND k.key = common.key GROUP BY doc_id),
f AS (
  SELECT doc_id, len(ws) AS n_words, list_sum(list_transform(ws, lambda x: length(x))) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, n_dup_lines, n_repeat_words, gone
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)),
c AS (
  SELECT doc_id, n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(gone, 0)::BIGINT AS n_boilerplate_words FROM f)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
  AND NOT (n_words - n_boilerplate_words < 50 OR n_words - n_boilerplate_words < 0.5 * n_words) AS kept
FROM c
"""

OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase FROM s, (VALUES (1), (2), (3), (4), (5)) AS x(size) WHERE i + size - 1 <= len(ws)),
f AS (SELECT lang, size, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, a, string_split(phrase, ' ') AS ws, unnest(range(1, size)) AS k FROM f WHERE size > 1),
e AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n, ((1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM c JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:k], ' ')
  JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1:], ' ') JOIN total ON total.lang = c.lang),
best AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
free AS (
  SELECT * FROM best WHERE NOT EXISTS (
    SELECT 1 FROM f WHERE f.lang = best.lang AND f.size > len(string_split(best.phrase, ' ')) AND 100 * f.a >= 100 * best.a
      AND contains(' ' || f.phrase || ' ', ' ' || best.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {"op1_exact_dedup": OP1_SQL, "op9_line_dedup": OP9_SQL, "op10_quality": OP10_SQL, "op12_collocations": OP12_SQL}
