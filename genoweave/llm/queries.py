"""The thin digest queries over the standard tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm import decontamination, filter_audit, hard_negatives, html_text, jaccard_join, mixing, packing, quality, token_counts, toxicity, url_filter, vector_search
from genoweave.llm.common import fold

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = mixing.copies(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return df.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, text, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2) AS bucket
  FROM documents),
classed AS (
  SELECT *, CASE WHEN size < 16 THEN size ELSE 16 * (length(bin(size)) - 1) + (size >> (length(bin(size)) - 5)::INT) END AS cls FROM sized),
totals AS (SELECT k, source, sum(size)::BIGINT AS source_size FROM classed GROUP BY k, source),
weighted AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w, 3 * source_size AS cap,
         (sum(source_size) OVER ())::BIGINT AS total FROM totals),
fills AS (
  SELECT *, total - (sum(cap) OVER by_ratio)::BIGINT + cap AS remaining,
         (sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weight
  FROM weighted WINDOW by_ratio AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
filled AS (SELECT *, cap::HUGEINT * weight <= remaining::HUGEINT * w AS is_full FROM fills),
shared AS (
  SELECT *, total - (sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())::BIGINT AS rest,
         (sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ())::BIGINT AS open FROM filled),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY k, level ORDER BY cls, bucket, size, doc_id NULLS FIRST) AS r
  FROM (SELECT c.doc_id, c.k, c.size, c.cls, c.bucket, t.source_size, CASE WHEN c.size * 32 > t.source_size THEN 0 WHEN c.size * 1024 > t.source_size THEN 1 ELSE 2 END AS level FROM classed c JOIN totals t USING (k))),
held AS (
  SELECT k, count(*) FILTER (level = 0) AS n0, count(*) FILTER (level = 1) AS n1, coalesce(sum(size) FILTER (level = 0), 0)::BIGINT AS words0, coalesce(sum(size) FILTER (level = 1), 0)::BIGINT AS words1
  FROM ranked GROUP BY k),
first_rate AS (
  SELECT *, CASE WHEN source_size > 0 THEN greatest(0.0::DOUBLE, least(3.0::DOUBLE, target / source_size)) ELSE 0.0::DOUBLE END AS rate0
  FROM (SELECT k, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE rest::DOUBLE * w / open END AS target, ('0x' || substr(md5('42:' || k), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS start0 FROM shared)
  JOIN held USING (k)),
took0 AS (
  SELECT g.*, coalesce(took, 0) AS took0 FROM first_rate g LEFT JOIN (
    SELECT k, sum(size * greatest(floor(rate0), least(ceil(rate0), floor(start0 + r::DOUBLE * rate0) - floor(start0 + (r - 1)::DOUBLE * rate0)))::BIGINT)::BIGINT AS took
    FROM ranked JOIN first_rate USING (k) WHERE level = 0 GROUP BY k) USING (k)),
second_rate AS (
  SELECT *, CASE WHEN source_size - words0 > 0 THEN greatest(0.0::DOUBLE, least(3.0::DOUBLE, (target - took0) / (source_size - words0))) ELSE 0.0::DOUBLE END AS rate1, start0 + n0 * rate0 AS start1 FROM took0),
took1 AS (
  SELECT g.*, coalesce(took, 0) AS took1 FROM second_rate g LEFT JOIN (
    SELECT k, sum(size * greatest(floor(rate1), least(ceil(rate1), floor(start1 + r::DOUBLE * rate1) - floor(start1 + (r - 1)::DOUBLE * rate1)))::BIGINT)::BIGINT AS took
    FROM ranked JOIN second_rate USING (k) WHERE level = 1 GROUP BY k) USING (k)),
third_rate AS (
  SELECT *, CASE WHEN source_size - words0 - words1 > 0 THEN greatest(0.0::DOUBLE, least(3.0::DOUBLE, (target - took0 - took1) / (source_size - words0 - words1))) ELSE 0.0::DOUBLE END AS rate2, start1 + n1 * rate1 AS start2 FROM took1),
placed AS (
  SELECT r.doc_id, r.size, r.r, g.source_size, g.target, CASE level WHEN 0 THEN rate0 WHEN 1 THEN rate1 ELSE rate2 END AS rate, CASE level WHEN 0 THEN start0 WHEN 1 THEN start1 ELSE start2 END AS start
  FROM ranked r JOIN third_rate g ON r.k = g.k)
SELECT doc_id, size, source_size, target, size * greatest(floor(rate), least(ceil(rate), floor(start + r::DOUBLE * rate) - floor(start + (r - 1)::DOUBLE * rate)))::BIGINT AS taken
FROM placed
"""


def learned(labels: DataFrame, folds: int, held_out: int) -> DataFrame:
    """The labels that may be learned from: those whose id isn't in the held-out fold."""
    return labels.filter(fold(F.col("doc_id"), folds) != held_out)


def _digest(scored: DataFrame, folds: int, held_out: int) -> DataFrame:
    out = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    return _digest(quality.score(docs, quality.train(docs, learned(labels, 3, 1))), 3, 1)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    return _digest(toxicity.score(docs, *toxicity.learn(docs, learned(labels, 5, 0))), 5, 0)


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    df = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return df.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))




def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
sized AS (SELECT doc_id, s, len(s)::BIGINT AS n FROM sets),
shingles AS (SELECT doc_id, n, hash(x) AS x FROM (SELECT doc_id, n, unnest(s) AS x FROM sized)),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sized UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT s.doc_id, s.n AS n_shingles, m.component_id FROM sized s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
"""


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    df = html_text.extract(pages, html_text.learn(pages))
    return df.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings").withColumn("label", shifted), F.col("id") % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT row_number() OVER () AS a, * FROM (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0)),
scored AS (
  SELECT q.a, q.vec_id AS anchor_id, q.label = c.label AS same, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM anchors q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
positives AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS p FROM scored WHERE same) WHERE p <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.p ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
  FROM positives p JOIN scored n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = decontamination.find(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    hit = decontamination.n_hit(F.col("found"))
    return df.select(
        "doc_id", "found.n_words", hit.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"), F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated")
    )


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM (SELECT *, least(len(w), 10) AS n FROM items WHERE len(w) > 0))),
met AS (
  SELECT r, k, d.n, item_id
  FROM (SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)) d
  JOIN windows v ON d.n = v.n AND d.g = v.g),
hits AS (SELECT r, count(DISTINCT i) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS i FROM (SELECT DISTINCT r, k, n FROM met)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), _table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marked AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM texts LEFT JOIN marked USING (doc_id)),
masks AS (SELECT part, mask, count(*)::BIGINT AS n, sum(good)::BIGINT AS good, sum(toxic)::BIGINT AS toxic FROM failing GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step::INTEGER AS step, 1 << instr('ABCDE', filter_order[step]) - 1 AS own, list_sum([1 << instr('ABCDE', filter_order[i]) - 1 FOR i IN range(1, step)]) AS prior
  FROM orders, range(1, 6) r(step)),
counted AS (
  SELECT part, filter_order, step, own, sum(n) FILTER (mask & (own | coalesce(prior, 0)::INT) = 0) AS kept, sum(n) FILTER (mask & own > 0 AND mask & coalesce(prior, 0)::INT = 0) AS removed,
         sum(n) FILTER (mask & own > 0 AND mask & coalesce(prior, 0)::INT > 0) AS redundant, sum(n) FILTER (mask = own) AS unique_fails,
         sum(good) FILTER (mask & own > 0 AND mask & coalesce(prior, 0)::INT = 0) AS good_lost, sum(toxic) FILTER (mask & own > 0 AND mask & coalesce(prior, 0)::INT = 0) AS toxic_lost
  FROM steps, masks GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM counted
"""


QUERIES: dict[str, Query] = {
    "op1_mix": op1_mix, "op2_urls": op2_urls, "op3_quality": op3_quality, "op4_exact_top_k": op4_exact_top_k, "op5_pack": op5_pack, "op6_jaccard": op6_jaccard,
    "op7_toxicity": op7_toxicity, "op8_token_counts": op8_token_counts, "op9_nearest": op9_nearest, "op10_main_text": op10_main_text, "op11_hard_negatives": op11_hard_negatives, "op12_decontaminate": op12_decontaminate, "op13_filter_audit": op13_filter_audit,
}
ORACLE_SQL: dict[str, str] = {"op1_mix": OP1_SQL, "op4_exact_top_k": OP4_SQL, "op6_jaccard": OP6_SQL, "op11_hard_negatives": OP11_SQL, "op12_decontaminate": OP12_SQL, "op13_filter_audit": OP13_SQL}
