"""Ratings, products, events and vectors read from a star-schema Parquet folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwise.functions.columns import ntz_epoch, rating_event


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """One rating per order line: the buyer scores the part."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_quantity")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("bigint").alias("userId"),
        F.col("l_partkey").cast("bigint").alias("productId"),
        (1 + F.col("l_quantity").cast("int") % 5).cast("double").alias("score"),
        ntz_epoch(F.col("o_orderdate")).alias("timestamp"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/part.parquet").select(
        F.col("p_partkey").cast("bigint").alias("productId"),
        F.col("p_name").alias("name"),
        F.lit(None).cast("string").alias("imageUrl"),
        F.col("p_type").alias("categories"),
        F.translate(F.concat_ws(" ", "p_name", "p_brand", "p_type"), " ", "|").alias("tags"),
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Rating events: the key in ``props`` is the product."""
    return spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("user_id").cast("bigint").alias("userId"),
        F.get_json_object("props", "$.k").cast("bigint").alias("productId"),
        (1 + F.floor("value").cast("int") % 5).cast("double").alias("score"),
        ntz_epoch(F.col("ts")).alias("timestamp"),
    )


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same events as log lines, one string column ``value``."""
    return events(spark, folder).select(
        rating_event(F.col("userId"), F.col("productId"), F.col("score"), F.col("timestamp")).alias("value")
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet").select(
        F.col("vec_id").cast("bigint").alias("productId"), F.col("embedding").alias("features")
    )
