"""Unordered pairs of items that share a key, in bounded tasks.

A plain self-join on the key hands a hot key to one task. Here each key with
more than ``chunk`` items is split into chunks of that size, and every pair of
chunks is its own shuffle group: no task holds more than two chunks of a key,
and the groups of a hot key spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CHUNK = 512


def bounded_groups(
    rows: DataFrame, key: str, item_id: str, payload: list[str], chunk: int | Column = CHUNK, sizes: DataFrame | None = None,
    place: Column | None = None,
) -> DataFrame:
    """(key, _lo, _hi, _items): one row per pair of chunks of a key, two items at least.

    ``_items`` is an array of {id, own, *payload} by ascending id; ``own`` is the
    item's chunk. Pairs are those within one chunk where _lo = _hi, and those
    across the two chunks otherwise, so each pair of a key meets in one group.
    ``rows`` must be unique on (key, item_id). ``sizes`` (key, _size) may be
    given when the item counts are cheaper to get than from ``rows``. ``chunk`` may follow ``_size``, and ``place``
    name the integer whose remainder is an item's chunk, so that items alike in it stay together.
    """
    if sizes is None:
        sizes = rows.groupBy(key).agg(F.count("*").alias("_size"))
    large = sizes.filter(F.col("_size") > chunk).select(
        key, F.ceil(F.col("_size") / chunk).cast("int").alias("_chunks")
    )
    routed = (
        rows.join(large, key, "left")
        .withColumn("_chunks", F.coalesce("_chunks", F.lit(1)))
        .withColumn("_own", F.pmod(F.xxhash64(item_id) if place is None else place, F.col("_chunks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
        .withColumn("_lo", F.least("_own", "_other"))
        .withColumn("_hi", F.greatest("_own", "_other"))
    )
    item = F.struct(F.col(item_id).alias("id"), F.col("_own").alias("own"), *payload)
    # Explicit, because a join on the key alone would satisfy the grouping and
    # leave the hot key in one partition; with a number, because the work grows
    # with the square of a group, and merging partitions by bytes would undo the
    # spread.
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        routed.select(key, "_lo", "_hi", item.alias("_item")).repartition(partitions, key, "_lo", "_hi")
        .groupBy(key, "_lo", "_hi").agg(F.sort_array(F.collect_list("_item")).alias("_items"))
        .filter(F.size("_items") > 1)
    )


def pairs_within(
    rows: DataFrame, key: str, item_id: str, payload: list[str], chunk: int = CHUNK, sizes: DataFrame | None = None
) -> DataFrame:
    """(key, a, b): items of ``bounded_groups`` with a.id < b.id, once per pair and key.

    Streamed out of the arrays, so a filter or partial aggregate put on top runs
    in the same stage, before anything is shuffled.
    """
    groups = bounded_groups(rows, key, item_id, payload, chunk, sizes)
    first = groups.select(key, "_lo", "_hi", "_items", F.posexplode("_items").alias("_pos", "a"))
    rest = F.slice("_items", F.col("_pos") + 2, F.size("_items"))
    return (
        first.select(key, "_lo", "_hi", "a", F.explode(rest).alias("b"))
        .filter((F.col("_lo") == F.col("_hi")) | (F.col("a.own") != F.col("b.own")))
        .select(key, "a", "b")
    )


def mirror(pairs: DataFrame, a: str = "p1", b: str = "p2", swap: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """Each unordered pair in both directions, without a second pass over the input."""
    swaps: dict[str, str] = {a: b, b: a}
    for x, y in swap:
        swaps[x], swaps[y] = y, x
    forward = F.struct(*[F.col(c).alias(c) for c in pairs.columns])
    back = F.struct(*[F.col(swaps.get(c, c)).alias(c) for c in pairs.columns])
    return pairs.select(F.explode(F.array(forward, back)).alias("_r")).select("_r.*")
