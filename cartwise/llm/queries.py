"""The queries of this subpackage by name, each over whole tables with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartwise.llm import bpe, bytebpe, divergence, infill, langid, lattice, licenses, mixing, pii, repeats, rules, simhash, tokens
from cartwise.llm.common import scratch, table

ORACLES: dict[str, str] = {"op2_licenses": licenses.oracle(), "op8_lattice": lattice.ORACLE,
                           "op11_divergence": divergence.ORACLE, "op12_infill": infill.ORACLE}


def op1_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark)
    tokens.write(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read_documents(spark, path)


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op3_langid(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents"))


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pii.find(docs, pii.fit(docs))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits(found.fp).alias("fingerprint"), "component_id")


def op8_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, folder, "embeddings"))


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op12_infill(spark: SparkSession, folder: str) -> DataFrame:
    return infill.digests(table(spark, folder, "documents"))


def op13_bytebpe(spark: SparkSession, folder: str) -> DataFrame:
    return bytebpe.digests(table(spark, folder, "documents"), public_tokenizers.path(bytebpe.FILE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tokens": op1_tokens,
    "op2_licenses": op2_licenses,
    "op3_langid": op3_langid,
    "op4_mixing": op4_mixing,
    "op5_repeats": op5_repeats,
    "op6_pii": op6_pii,
    "op7_simhash": op7_simhash,
    "op8_lattice": op8_lattice,
    "op9_bpe": op9_bpe,
    "op10_quality": op10_quality,
    "op11_divergence": op11_divergence,
    "op12_infill": op12_infill,
    "op13_bytebpe": op13_bytebpe,
}
