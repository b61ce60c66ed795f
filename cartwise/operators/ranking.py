"""Ranked lists: top-k per key, packing to arrays and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwise.sources.scratch import stored


def top_k(
    df: DataFrame, keys: list[str], score: str = "score", tie: str = "productId", k: int | None = None
) -> DataFrame:
    """Add ``rank`` by score descending, then ``tie`` ascending; keep the first ``k``.

    With ``k`` Spark cuts each key to k rows per map task (WindowGroupLimit), so
    a hot key reaches its reducer already short. Without ``k`` the whole list is
    kept, and is as long as the answer.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie))
    ranked = df.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def pack_recs(ranked: DataFrame, key: str, rec: str = "productId", all_keys: DataFrame | None = None) -> DataFrame:
    """Ranked rows to one row per key with ``recs: array<struct<productId,score>>``.

    Meant for lists already cut to k. ``all_keys`` adds keys without any row, as
    empty arrays.
    """
    entries = F.array_sort(F.collect_list(F.struct("rank", F.col(rec).alias("productId"), "score")))
    packed = ranked.groupBy(key).agg(
        F.transform(entries, lambda e: F.struct(e["productId"].alias("productId"), e["score"].alias("score")))
        .alias("recs")
    )
    if all_keys is None:
        return packed
    empty = F.array().cast("array<struct<productId:bigint,score:double>>")
    return all_keys.select(key).distinct().join(packed, key, "left").withColumn("recs", F.coalesce("recs", empty))


def unpack_recs(packed: DataFrame, key: str, rec: str = "rec_productId") -> DataFrame:
    """One row per list entry: key, recommended product, score, rank."""
    return packed.select(key, F.posexplode("recs").alias("_pos", "_rec")).select(
        key,
        F.col("_rec.productId").alias(rec),
        F.col("_rec.score").alias("score"),
        (F.col("_pos") + 1).alias("rank"),
    )


def similarity_map(sim: DataFrame, k: int) -> DataFrame:
    """(p1, map<p2, score>) of the first ``k`` partners, for callers that want maps."""
    best = top_k(sim, ["p1"], tie="p2", k=k)
    return best.groupBy("p1").agg(F.map_from_entries(F.collect_list(F.struct("p2", "score"))).alias("similar"))


def global_rank(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``rank``, the place of each row, from 1, in one order of the whole table.

    No task sees more than its range of the order: rows are split by range, sorted and numbered within it, and the
    numbers move up by the rows of the ranges before, a sum over as many rows as there are ranges. The
    numbered rows are written, so that every use sees one numbering; ``df`` is read twice, once for the
    ranges. Order it by columns that tell rows apart, or equal rows get their places by chance.
    """
    low = (1 << 33) - 1  # the bits that number a partition's rows
    numbered = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND(F.lit(low)).alias("_row")), "ranked")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy("_range").agg(F.count("*").alias("_size")).withColumn(
        "_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    return numbered.join(F.broadcast(sizes.drop("_size")), "_range").withColumn(
        "rank", F.col("_before") + F.col("_row") + 1).drop("_range", "_row", "_before")
