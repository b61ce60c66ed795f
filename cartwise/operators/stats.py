"""Popularity statistics over the rating table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwise.functions.columns import register_sql_functions, yearmonth


def monthly_rollup(ratings: DataFrame, tz: str = "UTC") -> DataFrame:
    """(yearmonth, productId, count, score_sum): one pass that feeds all three lists."""
    return (
        ratings.groupBy(yearmonth(F.col("timestamp"), tz).alias("yearmonth"), "productId")
        .agg(F.count("productId").alias("count"), F.sum("score").alias("score_sum"))
    )


def rate_more_products(ratings: DataFrame, ordered: bool = False) -> DataFrame:
    """Ratings per product. ``ordered`` sorts by count, then productId."""
    out = ratings.groupBy("productId").agg(F.count("productId").alias("count"))
    return out.orderBy(F.desc("count"), "productId") if ordered else out


def rate_more_recently(ratings: DataFrame, tz: str = "UTC", ordered: bool = False) -> DataFrame:
    """Ratings per month and product."""
    out = (
        ratings.groupBy(yearmonth(F.col("timestamp"), tz).alias("yearmonth"), "productId")
        .agg(F.count("productId").alias("count"))
        .select("productId", "count", "yearmonth")
    )
    return out.orderBy(F.desc("yearmonth"), F.desc("count"), "productId") if ordered else out


def average_products(ratings: DataFrame, ordered: bool = False) -> DataFrame:
    """Mean score per product."""
    out = ratings.groupBy("productId").agg(F.avg("score").alias("avg"))
    return out.orderBy(F.desc("avg"), "productId") if ordered else out


def from_rollup(rollup: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three lists (all-time, by month, mean) from a saved ``monthly_rollup``."""
    more = rollup.groupBy("productId").agg(F.sum("count").alias("count"))
    recent = rollup.select("productId", "count", "yearmonth")
    mean = rollup.groupBy("productId").agg((F.sum("score_sum") / F.sum("count")).alias("avg"))
    return more, recent, mean


def register_views(spark: SparkSession, ratings: DataFrame) -> None:
    """Views ``ratings`` and ``ratingOfMonth``, and ``changeDate``, for SQL text."""
    register_sql_functions(spark)
    ratings.createOrReplaceTempView("ratings")
    spark.sql("SELECT productId, score, changeDate(timestamp) AS yearmonth FROM ratings") \
        .createOrReplaceTempView("ratingOfMonth")
