"""From raw documents to token ids: quality rules, near-duplicates, personal data, the mix of sources, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as Parquet and
read again before the next. All but the last return the columns of documents, further columns included:

* quality drops what the rules or the isolation forest reject; the forest learns from the labels of sf_dir;
* near_dups keeps one document of each group of near copies (five words, similarity 0.8);
* pii masks personal data in the texts; no document goes;
* mixing repeats or leaves out documents so that the sources' words come near their targets;
* bpe returns doc_id, n_tokens, ids_sha256, decoded_sha256 and ids, a row per document that came in.

An empty table passes through every stage. Nulls are treated as the operators say in their docstrings.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trailforge.llm import bpe_sql, mixing, near_dups, pii, quality
from trailforge.llm.common import Scratch, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_dups_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.keep(docs, size=5, percent=80)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.copies(docs, mixing.mix(docs))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_sql.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, held=100_000)


STAGES = [
    ("quality", quality_stage),
    ("near_dups", near_dups_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: The isolation forest, the mix's hashes and BPE are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, lazily; what it reads goes with the application, or by trailforge.llm.common.release()."""
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark) as results:
        for name, stage in STAGES[:-1]:
            with Scratch(spark) as scratch:
                new = scratch.keep(written(stage(spark, docs, sf_dir), f"pipeline-{name}"))
            results.drop(docs)
            docs = new
        results.keep(docs)
        return STAGES[-1][1](spark, docs, sf_dir)
