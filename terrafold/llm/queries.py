"""The queries of this folder, by name; each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention_lm, collocations, cotraining, decontamination, kdtree, negatives, packing, rank_queue, rules, simhash, suffix, token_counts, token_files


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs).select(F.col("doc_id").cast("long"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_texts(_table(spark, sf_dir, "documents"))


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.kd_shards(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op9_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_table(spark, sf_dir, "documents"))


def op11_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = rank_queue.encode(_table(spark, sf_dir, "documents"))
    counted = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    return rank_queue.decode(counted).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    rows = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vec"))
    return negatives.hard_negatives(rows, rows.where("id % 100 = 0"))


#: Collocations in the terms of their definition: every phrase at every place.
_OP12_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM words),
phrases AS (
  SELECT lang, phrase, size, count(*) AS f
  FROM (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM places, generate_series(1, 5) AS s(size) WHERE i + size - 1 <= len(w))
  GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM phrases WHERE size = 1 GROUP BY 1),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM phrases WHERE size > 1 AND f >= 100),
within AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(f) AS most
  FROM candidates, generate_series(2, 4) AS a(k), generate_series(1, 4) AS b(i) WHERE k < size AND i + k - 1 <= size GROUP BY 1, 2),
kept AS (SELECT c.* FROM candidates c LEFT JOIN within i ON i.lang = c.lang AND i.phrase = c.phrase WHERE i.most IS NULL OR 100 * i.most < 100 * c.f),
cuts AS (SELECT lang, phrase, f, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS tail FROM kept, generate_series(1, 4) AS g(k) WHERE k < size),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, l.f AS l, r.f AS r, t.n,
         CAST((CAST(1000 AS HUGEINT) * c.f * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts c JOIN phrases l ON l.lang = c.lang AND l.phrase = c.head JOIN phrases r ON r.lang = c.lang AND r.phrase = c.tail JOIN totals t ON t.lang = c.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst QUALIFY rank <= 2000"""

_OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, own, id AS positive_id, score AS positive_score FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE s.label <> p.own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_decontamination, op3_suffix_dedup, op4_best_fit_packing, op5_attention_lm, op6_kd_sharding, op7_token_counts, op8_simhash, op9_cotraining, op10_token_files, op11_rank_queue_bpe, op12_collocations, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op12_collocations": _OP12_SQL, "op13_hard_negatives": _OP13_SQL}
