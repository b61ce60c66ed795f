"""The k best products of every user by inner product of factors, exact, with whole blocks of products ruled out by norm."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from cartwise.functions.columns import dot
from cartwise.operators.ranking import global_rank, top_k
from cartwise.sources.scratch import stored

# The kernels travel inside the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ITEM_ROWS = 4096  # products of a block; the first block, of the longest vectors, is sent to every task
USER_ROWS = 4096  # users that meet a block in one task, at most about so many
SPAN_ROWS = 32_768  # products, and users, of a task where the tables are long
MOST_SPANS, MOST_PARTS = 64, 16  # spans of products and parts of users where that makes fewer
TILE = 512  # users multiplied at once, at most
SCORES = 1 << 21  # and scores
_LIST = "userId long, rec_productId long, score double"
_LIST_ARROW = pa.schema([("userId", pa.int64()), ("rec_productId", pa.int64()), ("score", pa.float64())])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column as rows of doubles."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(whole) == 0:
        return np.zeros((0, 0))
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1).astype("float64")


def _scores(rows: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Inner products on the 1e-9 grid, so that ties are ties whatever the order of addition."""
    return np.floor(rows @ items.T * 1e9 + 0.5) / 1e9


def _best(scores: np.ndarray, ids: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k highest scores of each row above ``least``, of equal scores the lowest ids.

    The k-th score of a row is found by selection; all that reach it are put in order, and ties beyond k go.
    """
    if scores.shape[1] > k:
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        hit = (scores >= kth[:, None]) & (scores > least)
    else:
        hit = scores > least
    i, j = np.nonzero(hit)
    order = np.lexsort((ids[j], -scores[i, j], i))
    i, j = i[order], j[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return i[place < k], j[place < k]


def _reach_kernel(head: np.ndarray, longest: np.ndarray, k: int, least: float):
    """How many blocks, longest vectors first, can hold one of a user's k best.

    The k-th score within the first block is a bound from below; a block whose longest vector times the user's
    length stays under it holds none, nor does any behind.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("features"))
            known = batch.column("rated").to_pylist()
            reach = np.zeros(len(rows), np.int32)
            for at in range(0, len(rows), TILE):
                part = rows[at:at + TILE]
                scores = _scores(part, head)
                for row, places in enumerate(known[at:at + TILE]):
                    if places:
                        scores[row, places] = -np.inf
                kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1] if scores.shape[1] >= k else np.full(len(part), -np.inf)
                bound = np.linalg.norm(part, axis=1)[:, None] * longest[None, :] * (1 + 1e-12) + 1e-9
                # Lengths fall, so the blocks that may count are the first ones.
                reach[at:at + TILE] = ((bound >= kth[:, None]) & (bound > least)).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("userId"), batch.column("features"), pa.array(reach)], names=["userId", "features", "reach"])

    return run


def _meet(k: int, least: float):
    def meet(users: pa.Table, items: pa.Table) -> pa.Table:
        if users.num_rows == 0 or items.num_rows == 0:
            return _LIST_ARROW.empty_table()
        ids, block = items.column("productId").to_numpy(), items.column("at").to_numpy()
        order = np.lexsort((block, ids))
        ids, block, others = ids[order], block[order], _matrix(items.column("features"))[order]
        # What a rated id masks: its first row in each block.
        first = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (block[1:] != block[:-1]))))
        unique = bool((np.diff(ids[first]) > 0).all())
        names, rows = users.column("userId").to_numpy(), _matrix(users.column("features"))
        known = users.column("rated").to_pylist()
        found = []
        high = max(1, min(TILE, SCORES // len(ids)))
        for at in range(0, len(rows), high):
            scores = _scores(rows[at:at + high], others)
            for row, rated in enumerate(known[at:at + high]):
                if rated:
                    hit = np.searchsorted(ids[first], rated) if unique else np.flatnonzero(np.isin(ids[first], rated))
                    scores[row, first[hit]] = -np.inf
            i, j = _best(scores, ids, k, least)
            found.append(pa.table([names[at:at + high][i], ids[j], scores[i, j]], schema=_LIST_ARROW))
        return pa.concat_tables(found)

    return meet


class Catalogue:
    """Products laid out in blocks of falling vector length, made once and met by any number of users."""

    def __init__(self, products: DataFrame, block_rows: int = ITEM_ROWS):
        """``products`` (productId, features), unique; null vectors drop out."""
        self.block_rows = block_rows
        long = products.where("features IS NOT NULL").select("productId", "features").withColumn(
            "norm", F.sqrt(dot(F.col("features"), F.col("features"))))
        ranked = global_rank(long, [F.desc("norm"), F.asc("productId")])
        place = F.col("rank") - 1
        self.rows = stored(ranked.select(
            "productId", "features", "norm", F.floor(place / block_rows).cast("int").alias("block"),
            (place % block_rows).cast("int").alias("place")), "products")
        # A number for each block, and the rows of one.
        longest = self.rows.groupBy("block").agg(F.max("norm")).orderBy("block").collect()
        self.longest = np.array([r[1] for r in longest], float)
        head = self.rows.where("block = 0").select("place", "features").orderBy("place").collect()
        self.head = np.array([r[1] for r in head], float)

    def _merged(self) -> int:
        """How many blocks make a span, the products of a task."""
        spans = max(MOST_SPANS, -(-len(self.longest) * self.block_rows // SPAN_ROWS))
        return -(-len(self.longest) // min(len(self.longest), spans))

    def reach(self, users: DataFrame, rated: DataFrame | None, k: int, least: float) -> DataFrame:
        """``users`` (userId, features) with ``reach``, the number of blocks that can hold one of the k best."""
        if rated is None:
            known = users.withColumn("rated", F.lit(None).cast("array<int>"))
        else:
            met = rated.join(self.rows.where("block = 0").select("productId", "place"), "productId")
            known = users.join(met.groupBy("userId").agg(F.collect_set("place").alias("rated")), "userId", "left")
        width = self.rows.schema["features"].dataType.simpleString()
        return known.select("userId", F.col("features").cast(width).alias("features"), "rated").mapInArrow(
            _reach_kernel(self.head, self.longest, k, least), f"userId long, features {width}, reach int")

    def top(self, users: DataFrame, k: int, least: float = 0.0, rated: DataFrame | None = None,
            user_rows: int = USER_ROWS) -> DataFrame:
        """(userId, rec_productId, score, rank): the k best products above ``least``, ties by productId.

        ``rated`` (userId, productId) is masked before the cut. Users are grouped by how far they reach, in parts of
        about ``user_rows``, and a part meets the blocks its users reach, in tasks that hand on k rows
        a user. Of a user's rated products a task gets those of its blocks. Where blocks or parts are many, several
        neighbours share a task: every user goes to each span of blocks once, every product to each part, so
        that their number must not follow the tables until a span has SPAN_ROWS.
        """
        if not len(self.longest):
            return top_k(users.sparkSession.createDataFrame([], _LIST), ["userId"], tie="rec_productId", k=k)
        users = users.where("features IS NOT NULL").select("userId", "features")
        if rated is not None:
            rated = rated.select("userId", "productId").distinct()
        reach = self.reach(users, rated, k, least).where("reach > 0")
        # At most as many classes as the bits of a block number.
        reach = stored(reach.withColumn("class", F.ceil(F.log2("reach")).cast("int")), "reach")
        merged = self._merged()
        reach = reach.withColumn("reach", F.ceil(F.col("reach") / merged).cast("int"))
        parts = reach.groupBy("class").agg(F.least(
            F.ceil(F.count("*") / user_rows), F.greatest(F.lit(MOST_PARTS), F.ceil(F.count("*") / SPAN_ROWS))).alias("parts"))
        routed = reach.join(F.broadcast(parts), "class").select(
            "userId", "features", "class", F.pmod(F.xxhash64("userId"), "parts").cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.col("reach") - 1)).alias("block"))
        needed = reach.join(F.broadcast(parts), "class").groupBy(
            "class", F.pmod(F.xxhash64("userId"), "parts").cast("int").alias("part")).agg(F.max("reach").alias("reach"))
        wanted = needed.select("class", "part", F.explode(F.sequence(F.lit(0), F.col("reach") - 1)).alias("block"))
        # Named anew, as both sides of the meeting come from ``reach``.
        span = F.floor(F.col("block") / merged).cast("int").alias("block")
        items = self.rows.select(span, F.col("block").alias("at"), "productId", "features").join(wanted, "block").select(
            F.col("class").alias("c"), F.col("part").alias("p"), F.col("block").alias("b"), "at", "productId", "features")
        if rated is None:
            mine = routed.withColumn("rated", F.lit(None).cast("array<long>"))
        else:
            blocked = rated.join(self.rows.select("productId", span), "productId").groupBy("userId", "block").agg(
                F.collect_set("productId").alias("rated"))
            mine = routed.join(blocked, ["userId", "block"], "left")
        lists = mine.groupBy("class", "part", "block").cogroup(items.groupBy("c", "p", "b")).applyInArrow(
            _meet(k, least), _LIST)
        return top_k(lists, ["userId"], tie="rec_productId", k=k)
