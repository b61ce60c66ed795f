"""Corpus pipeline: the stages from raw documents to token digests."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartwise.llm import bpe, mixing, pii, rules, simhash
from cartwise.llm.common import cleared, delete, scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id: fingerprints of three-word shingles
    that lie 2 bits or fewer apart are linked."""
    return simhash.survivors(docs, simhash.SHINGLE, simhash.RADIUS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data masked by its kind."""
    return pii.mask(docs, pii.fit(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources takes them, from never to three times."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("near-dedup", near_duplicates), ("PII", personal_data),
          ("mixing sources", mixture), ("BPE encoding", encode)]

# The thresholds, fingerprints, taggers and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns but the last is written as Parquet and read again.

    Tables that a stage makes on its way, and its input, are deleted once its result is written. The cases of nulls,
    empty texts, repeated rows and other columns are those that each stage's operator states.
    """
    docs, path = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        before, path = path, scratch(spark)
        with cleared(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            delete(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
