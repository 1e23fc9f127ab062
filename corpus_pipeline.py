"""Corpus pipeline: five stages over ``documents``, each one of the llm operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next one's docs. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from surveyfold.llm import exact_dedup, language, mixing, packing, simhash
from surveyfold.llm.common import tokenizer
from surveyfold.session import checkpoint_root


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are null or without a letter go; the language told drops no other."""
    return language.keep_identified(docs, language.fit(docs))


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.keep_one(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, with the words it takes."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences with their token ids."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", dedup_exact),
    ("simhash_dedup", dedup_near),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

# No stage after the second can be said in SQL (fingerprints, seeded draws,
# tokenizer ids), so the rows are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = os.path.join(checkpoint_root(spark), f"pipeline-{uuid.uuid4().hex}")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
