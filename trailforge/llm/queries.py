"""The queries op1 to op10: thin, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe_sql, embedding_dups, html_text, language_id, mixing, near_dups, pii, quality, token_counts, warc
from .common import table

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~language_id.held_out()).select("text", "lang"))
    found = language_id.predict(docs, model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_dups(table(spark, sf_dir, "documents"), size=3, percent=85)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_sql.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ids=False)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, forest)


def op6_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.embedding_dups(table(spark, sf_dir, "embeddings"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(table(spark, sf_dir, "documents")))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_near_dups": op2_near_dups,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_embedding_dups": op6_embedding_dups,
    "op7_token_counts": op7_token_counts,
    "op8_warc": op8_warc,
    "op9_pii": op9_pii,
    "op10_html_extraction": op10_html_extraction,
}

ORACLE: dict[str, str] = {}
ORACLE["op8_warc"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, cast(strlen(html) as bigint) as payload_bytes, sha256(html) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and first is not null and page_id is distinct from first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id is distinct from first then first end as refers_to
from f
"""
