"""Registry of the operators: ``queries()`` and ``oracle_sql()`` for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import balltree as op8
from . import exact_dedup as op4
from . import language as op1
from . import minhash as op11
from . import mixing as op9
from . import negatives as op12
from . import packing as op6
from . import repeats as op7
from . import secrets as op5
from . import simhash as op3
from . import toxicity as op10
from . import wacz as op2
from . import whitening as op13
from .common import read, tokenizer

Query = Callable[[SparkSession, str], DataFrame]


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.exact_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_OP4 = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY sha) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha AS text_sha256
FROM t
WINDOW w AS (PARTITION BY sha ORDER BY n DESC, doc_id NULLS LAST)
"""


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return op1.predict(docs, op1.fit(docs))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.round_trip(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_OP2 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM q
"""


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5.scan(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.pack(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.remove_repeats(read(spark, sf_dir, "documents"))


def op8_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.top_k(read(spark, sf_dir, "embeddings"))


ORACLE_OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.taken_per_document(op9.mix(read(spark, sf_dir, "documents")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return op10.predict(docs, op10.learn(docs, read(spark, sf_dir, "labels")))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.near_duplicates(read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.hard_negatives(read(spark, sf_dir, "embeddings"))


ORACLE_OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, c.vec_id, c.label, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE s.label <> s.own AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.whiten(read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_language": op1_language,
        "op2_warc": op2_warc,
        "op3_simhash": op3_simhash,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_secrets": op5_secrets,
        "op6_packing": op6_packing,
        "op7_repeats": op7_repeats,
        "op8_search": op8_search,
        "op9_mixing": op9_mixing,
        "op10_toxicity": op10_toxicity,
        "op11_minhash": op11_minhash,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": ORACLE_OP2,
        "op4_exact_dedup": ORACLE_OP4,
        "op8_search": ORACLE_OP8,
        "op12_hard_negatives": ORACLE_OP12,
    }
