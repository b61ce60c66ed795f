"""Whole jobs: read tables under a base folder, compute, write result tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from cartwise import schema
from cartwise.operators import content, factors, itemcf, stats
from cartwise.operators.ranking import pack_recs, top_k
from cartwise.sources.files import read_products, read_ratings, read_table, write_table
from cartwise.sources.scratch import clear_scratch
from cartwise.streaming.live import store_lists


def load(spark: SparkSession, product_file: str, rating_file: str, base: str) -> None:
    """Files to tables Product and Rating; lines that do not parse to *Rejects."""
    for name, scan in (
        ("Product", read_products(spark, product_file)),
        ("Rating", read_ratings(spark, rating_file)),
    ):
        write_table(scan.rows, base, name)
        write_table(scan.rejects, base, f"{name}Rejects")


def statistics(spark: SparkSession, base: str, tz: str = "UTC") -> None:
    """RateMoreProducts, RateMoreRecentlyProducts, AverageProducts from one pass over Rating.

    The ratings are grouped once, by month and product; the three lists come
    from that far smaller table.
    """
    ratings = read_table(spark, base, "Rating", schema.RATING)
    write_table(stats.monthly_rollup(ratings, tz), base, "RatingMonths")
    more, recent, mean = stats.from_rollup(spark.read.parquet(f"{base}/RatingMonths"))
    write_table(more, base, "RateMoreProducts")
    write_table(recent, base, "RateMoreRecentlyProducts")
    write_table(mean, base, "AverageProducts")


def item_cf(spark: SparkSession, base: str, k: int = 10) -> None:
    """ItemCFProductRecs; a product without partners gets an empty list."""
    ratings = read_table(spark, base, "Rating", schema.RATING)
    lists = pack_recs(itemcf.item_cf(ratings, k), "productId", "rec_productId", all_keys=ratings)
    write_table(lists, base, "ItemCFProductRecs")


def content_lists(spark: SparkSession, base: str, buckets: int | None = content.BUCKETS) -> None:
    """ContentBasedProductRecs over hashed terms, or exact words with ``buckets=None``.

    Flat, (productId, rec_productId, score, rank): lists have no longest, and no
    task has to hold one.
    """
    products = read_table(spark, base, "Product", schema.PRODUCT)
    write_table(content.content_recs(products, buckets=buckets), base, "ContentBasedProductRecs")
    clear_scratch(spark)


def offline_lists(spark: SparkSession, base: str, seed: int = 7) -> None:
    """UserRecs (nested, 20 a user), the similarity relation ProductSim, ProductRecs (flat, whole) and LiveLists.

    LiveLists are ProductRecs as the live query reads them, by bucket of product and in order of rank.
    """
    ratings = read_table(spark, base, "Rating", schema.RATING)
    model = factors.train_als(ratings, seed=seed)
    write_table(pack_recs(factors.user_recs(model), "userId", "rec_productId"), base, "UserRecs")
    write_table(factors.product_similarity(model), base, "ProductSim")
    written = read_table(spark, base, "ProductSim", schema.SIMILARITY).toDF("productId", "rec_productId", "score")
    write_table(top_k(written, ["productId"], tie="rec_productId"), base, "ProductRecs")
    store_lists(read_table(spark, base, "ProductRecs", schema.RANKED), f"{base}/LiveLists")
    clear_scratch(spark)


def tune(spark: SparkSession, base: str, seed: int = 7) -> None:
    """ALSGrid: every cell of the full search grid, and ALSBest, its least error."""
    grid = factors.tune_als(read_table(spark, base, "Rating", schema.RATING), seed=seed)
    write_table(grid, base, "ALSGrid")
    write_table(factors.best_parameters(grid), base, "ALSBest")
    clear_scratch(spark)
