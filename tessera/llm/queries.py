"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm.common import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.near_dedup import near_dedup
    return near_dedup(table(spark, sf_dir, "documents"), k=3, percent=85)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.url_filter import LISTED_LABELS, RULES, url_filter
    labels = F.array(*[F.lit(x) for x in LISTED_LABELS])
    return url_filter(table(spark, sf_dir, "pages"), RULES, F.arrays_overlap(F.split("key", r"\."), labels))


OP2_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), judged AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM judged
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN list_has_any(string_split(host, '.'), ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.mixing import mix_sources
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs, [1, 2, 3], 3.0, seed=17).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight FROM per_source
), caps AS (
  SELECT *, source_size * 3.0::DOUBLE AS most, source_size * 3.0::DOUBLE / weight AS cap_at FROM weighted
), levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(most) OVER w, 0.0::DOUBLE))
            / (sum(weight) OVER ()::DOUBLE - coalesce(sum(weight) OVER w, 0)::DOUBLE) AS level
  FROM caps WINDOW w AS (ORDER BY cap_at, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
  SELECT coalesce(arg_min(level, cap_at) FILTER (WHERE level <= cap_at), 0.0::DOUBLE) AS w FROM levels
), targets AS (
  SELECT source, source_size, least(most, w * weight) AS target FROM levels, water
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + (('0x' || substr(md5('17:' || doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE < rate - floor(rate))::BIGINT))::BIGINT AS taken
FROM rated
"""


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.exact_dedup import exact_dedup
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

def op6_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.hmm import hmm_scores
    return hmm_scores(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.line_dedup import line_decisions
    return line_decisions(table(spark, sf_dir, "documents")).drop("place", "digest")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.substring_dedup import substring_dedup
    return substring_dedup(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tessera.llm.spiece import token_digests
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return token_digests(table(spark, sf_dir, "documents"), f.read())


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.whitening import whiten
    out = whiten(table(spark, sf_dir, "embeddings"))
    # the exact deviation outgrows a long from some millions of vectors on: null there, whole in the last column
    return out.select("vec_id", "component", "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), "whitened", "explained", "identity_error",
                      F.col("deviation").alias("deviation_exact"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tessera.llm.alignment import align
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return align(table(spark, sf_dir, "documents"), a.read(), b.read())


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.decontamination import decontaminate
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), grams AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM windows))
), hits AS (
  SELECT r, i, k, item_id FROM grams JOIN windows USING (k, s)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r
), items AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_near_dedup, op2_url_filter, op3_mix_sources, op4_exact_dedup, op5_quality_rules, op6_hmm_scores, op7_line_dedup, op8_toxicity, op9_substring_dedup, op10_sentencepiece,
                           op11_whitening, op12_alignment, op13_decontamination)
} | {"pipeline": corpus_pipeline.run}
ORACLES = {"op2_url_filter": OP2_SQL, "op3_mix_sources": OP3_SQL, "op4_exact_dedup": OP4_SQL, "op13_decontamination": OP13_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
