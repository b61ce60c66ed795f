"""Connected components of a link table, by contraction in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartwise.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """Group the nodes of a link table.

    ``links`` has two columns ``a`` and ``b`` of one type; direction, repeats, loops and nulls do not matter (a
    link with a null end is none). Returns ``node``, ``root``: every node that has a link, with one node that
    stands for its group. In a round each node looks to its neighbour of the lowest hash, two such steps are
    taken at once, and the graph is contracted to the nodes reached; hashing makes chains of any length shrink
    by a constant factor a round. Neighbours are reduced by a map-side minimum, so no node's links meet in a
    task, and each round is written to the shared folder. An empty table gives no rows. Building the result
    runs one job a round.
    """
    links = stored(_contracted(links.select("a", "b")))
    member = None
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("v"))).alias("low"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("v"))
        step = stored(low.select(F.col("a").alias("node"), F.least(own, F.col("low"))["v"].alias("to")))
        ahead = step.select(F.col("node").alias("to"), F.col("to").alias("root"))
        hop = stored(step.join(ahead, "to").select("node", "root"))
        if member is None:
            member = hop
        else:
            onward = hop.select(F.col("node").alias("root"), F.col("root").alias("next"))
            member = member.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        member = stored(member)
        a = hop.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = hop.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        links = stored(_contracted(links.join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))))
    if member is None:
        member = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return member


def _contracted(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
