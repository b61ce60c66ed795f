"""Item-to-item similarity by co-rating."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwise.functions.columns import cooccurrence_similarity
from cartwise.operators.pairs import CHUNK, bounded_groups
from cartwise.operators.ranking import top_k
from cartwise.sources.scratch import stored

# The kernel travels inside the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# From how many products on a user counts as heavy, of how many products their pieces are, and how many
# baskets are read at once.
HEAVY = 20_000
BLOCK_ROWS = 1024
USER_SLICE = 4096
PART_PAIRS = 1 << 22  # pairs of a task, about
SLICE_PAIRS = 1 << 20  # pairs made at once
ROUND_PAIRS = 1 << 30  # pairs whose baskets are on their way at once; of more, eight for each rating
MOST_PARTS = 1 << 14
RATERS = 1 << 16  # raters of a product that one task takes
DENSE_IDS = 1 << 23  # span of ids for which a task keeps totals in an array


def counted_ratings(ratings: DataFrame, distinct_users: bool = False) -> DataFrame:
    """(userId, productId, n): how often the user rated the product.

    Repeated ratings count, unless ``distinct_users``. Grouping first makes the
    rows unique and shrinks a hot product to one row per user.
    """
    counted = ratings.groupBy("userId", "productId").agg(F.count("*").alias("n"))
    return counted.withColumn("n", F.least("n", F.lit(1))) if distinct_users else counted


def _with_totals(counted: DataFrame) -> DataFrame:
    """(userId, productId, n, total, spread): counted ratings with the product's number of ratings, and over how many
    tasks its raters are spread.

    Totals travel with the items: joining them to the pairs would shuffle the
    far larger pair relation twice more.
    """
    totals = counted.groupBy("productId").agg(F.sum("n").alias("total"), F.ceil(F.count("*") / RATERS).cast("int").alias("spread"))
    return counted.join(totals, "productId")


def _sizes(counted: DataFrame) -> DataFrame:
    """(userId, _size): products per user."""
    return counted.groupBy("userId").agg(F.count("*").alias("_size"))


def cooccurrence(ratings: DataFrame, distinct_users: bool = False, chunk: int = CHUNK) -> DataFrame:
    """(p1, p2, cocount, count1, count2) for every co-rated pair with p1 < p2.

    The relation is symmetric; ``mirror`` gives the other half. Self-pairs are
    left out, as every list drops them. The whole relation is the answer here;
    ``item_cf`` cuts it where it is summed.
    """
    return _pair_sums(counted_ratings(ratings, distinct_users), None, chunk, HEAVY, BLOCK_ROWS).drop("rank")


def register_view(spark: SparkSession, ratings: DataFrame) -> None:
    """View ``cooccurrence`` (product1, product2, cocount, count1, count2) for SQL text."""
    cooccurrence(ratings).toDF("product1", "product2", "cocount", "count1", "count2") \
        .createOrReplaceTempView("cooccurrence")


def item_cf(
    ratings: DataFrame, k: int = 10, distinct_users: bool = False, chunk: int = CHUNK,
    heavy: int = HEAVY, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(productId, rec_productId, score, rank): the k most similar products of each product.

    Exact: every pair is counted, in the task of its first product, which hands on k rows per product. Users with more
    than ``chunk`` products have baskets cut in pieces, those with more than ``heavy`` in pieces of ``block_rows``.
    """
    sums = _pair_sums(counted_ratings(ratings, distinct_users), k, chunk, heavy, block_rows)
    score = cooccurrence_similarity(F.col("cocount"), F.col("count1"), F.col("count2"))
    return sums.select(F.col("p1").alias("productId"), F.col("p2").alias("rec_productId"), score.alias("score"), "rank")


class Layout(NamedTuple):
    """How baskets are written: ids less ``low``, which are below ``span``, and totals up to ``most``.

    Ids so far apart that twice the distance is no number of 64 bits are written as they are.
    """

    low: int
    span: int
    most: int

    @classmethod
    def of(cls, low: int | None, high: int | None, most: int | None) -> Layout:
        span = (high or 0) - (low or 0) + 1
        return cls(low or 0 if span <= 1 << 62 else 0, span, most or 0)

    def far(self) -> bool:
        return self.span > 1 << 62

    def widths(self) -> tuple[int, int]:
        """Bytes of an id, with one bit beside it, and of a total."""
        return 8 if self.far() else -(-(2 * self.span).bit_length() // 8), max(1, -(-self.most.bit_length() // 8))


def _pair_sums(counted: DataFrame, k: int | None, chunk: int, heavy: int, block_rows: int) -> DataFrame:
    """(p1, p2, cocount, count1, count2, rank): with ``k`` the k best p2 of each p1, else all with p1 < p2 (rank null).

    Pairs are no rows of a shuffle, where each would cost as much as a basket's piece of several: products lie in
    parts by a hash, and a part gets once the basket of every user who rated one of its products, with
    those products. The number of parts follows the pairs, so that a task counts a bounded number of
    them, all pairs of its products. Of a product that more than RATERS users rated the users are spread over several parts,
    and the sums of those are added up after. Baskets sent to all parts take as much room as the pairs grow; with ``k``,
    whose result is short, parts take turns once there are many, and what one turn shuffled is deleted before the next.
    """
    spark = counted.sparkSession
    counted = stored(counted, "counted")
    sizes = _sizes(counted)
    # One pass over the sizes: how many pairs there are, and if any basket is cut.
    pairs, largest, ratings = sizes.agg(F.sum(F.col("_size").cast("double") * F.col("_size")), F.max("_size"), F.sum("_size")).first()
    low, high, most, raters = counted.where("productId IS NOT NULL").groupBy("productId").agg(
        F.sum("n").alias("total"), F.count("*").alias("raters")).agg(
        F.min("productId"), F.max("productId"), F.max("total"), F.max("raters")).first()
    layout = Layout.of(low, high, most)
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = int(min(max(few, (pairs or 0) / (PART_PAIRS if k is not None else 2 * PART_PAIRS)), MOST_PARTS))
    turns = min(parts, max(1, math.ceil((pairs or 0) / max(ROUND_PAIRS, 8 * (ratings or 0)))))
    part = F.pmod(F.xxhash64("productId"), F.lit(parts)).cast("int")
    rows = _with_totals(counted).withColumn("part", part)
    payload = ["n", "total", "spread", "part"]
    if (largest or 0) > min(chunk, heavy):
        size = F.when(F.col("_size") > heavy, F.lit(block_rows)).otherwise(F.lit(chunk))
        groups = bounded_groups(rows, "userId", "productId", payload, size, sizes, F.col("part"))
    else:
        item = F.struct(F.col("productId").alias("id"), F.lit(0).alias("own"), *payload)
        groups = rows.groupBy("userId").agg(F.sort_array(F.collect_list(item)).alias("_items")).select(
            "userId", F.lit(0).alias("_lo"), F.lit(0).alias("_hi"), "_items").filter(F.size("_items") > 1)
    groups = groups.select(F.coalesce(F.xxhash64("userId"), F.lit(0)).alias("salt"), "_lo", "_hi", "_items")
    if turns > 1:
        groups = stored(groups, "baskets")

    def summed(first: int, end: int) -> DataFrame:
        """The sums of the parts from ``first`` to before ``end``."""
        routed = groups.mapInArrow(
            _route_kernel(layout, parts, first, end, k is None), "part int, hot boolean, mine int, items binary, ns binary")
        return routed.repartitionById(end - first, F.col("part")).mapInArrow(
            _sum_kernel(layout, k, USER_SLICE), "p1 long, p2 long, cocount long, count1 long, count2 long, rank int, hot boolean")

    if k is None or turns == 1:
        sums = summed(0, parts)
    else:
        cuts = [parts * turn // turns for turn in range(turns + 1)]
        sums = reduce(DataFrame.unionByName, [stored(summed(a, b), "sums") for a, b in zip(cuts, cuts[1:])])
    if (raters or 0) <= RATERS:
        return sums.drop("hot")
    if k is None or turns == 1:
        sums = stored(sums, "sums")
    hot = sums.filter("hot").groupBy("p1", "p2").agg(
        F.sum("cocount").alias("cocount"), F.max("count1").alias("count1"), F.max("count2").alias("count2"))
    if k is not None:
        score = cooccurrence_similarity(F.col("cocount"), F.col("count1"), F.col("count2"))
        hot = top_k(hot.withColumn("score", score), ["p1"], tie="p2", k=k).drop("score")
    return sums.filter("not hot").drop("hot").unionByName(hot, allowMissingColumns=True)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts, starts + 1, ... of every range, one range after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _bytes(values: np.ndarray, width: int) -> np.ndarray:
    """The lower ``width`` bytes of each of some numbers of 64 bits."""
    return values.astype("<i8", copy=False).view(np.uint8).reshape(-1, 8)[:, :width]


def _number(data: np.ndarray) -> np.ndarray:
    """The numbers of ``_bytes``."""
    whole = np.zeros((len(data), 8), np.uint8)
    whole[:, :data.shape[1]] = data
    return whole.view("<i8")[:, 0]


def _binaries(rows: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The bytes of ``lengths`` rows each."""
    ends = np.concatenate(([0], np.cumsum(lengths))) * rows.shape[1]
    made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [
        None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(rows))])
    return made.cast(pa.binary())


def _rows(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All rows of ``_binaries`` one after another, and how many each binary has."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0]: bounds[-1]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    return data.reshape(-1, width), np.diff(bounds) // width


def _route_kernel(layout: Layout, parts: int, first: int, end: int, once: bool):
    """Of each group of a user's products the rows (part, hot, mine, items, ns) for the parts from ``first`` to before
    ``end``: the products of a part, ``mine`` of them, and after those the products they meet.

    With ``once`` a product meets those of higher ids only. An id is written twice its distance from the lowest, and one
    more where the user rated it several times; those numbers are in ``ns``, all of them where ids are written as they are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("_items").value_lengths().to_numpy().astype(float)
            # Rows of a slice repeat baskets, by the square of their lengths at most.
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths * lengths) // SLICE_PAIRS, prepend=0)) if len(lengths) else []
            for a, b in zip([0, *cuts], [*cuts, len(lengths)]):
                if b > a:
                    yield route(batch.slice(a, b - a))

    def route(batch: pa.RecordBatch) -> pa.RecordBatch:
        groups = batch.column("_items")
        items, count = groups.flatten(), groups.value_lengths().to_numpy().astype(np.int64)
        ids, own, n, total, spread, part = (items.field(f).to_numpy() for f in ("id", "own", "n", "total", "spread", "part"))
        lo, hi, salt = (np.repeat(batch.column(f).to_numpy(), count) for f in ("_lo", "_hi", "salt"))
        group = np.repeat(np.arange(len(count)), count)
        # Sides of a group: the products of its chunks. Those of one chunk meet themselves.
        across = lo != hi
        side = 2 * group + (across & (own == hi))
        order = np.argsort(side, kind="stable")  # ids stay ascending
        ids, n, total, spread, part, side, across, salt = (x[order] for x in (ids, n, total, spread, part, side, across, salt))
        hot = spread > 1
        part = np.where(hot, (part + salt % np.maximum(spread, 1)) % parts, part)
        rows = np.flatnonzero((part >= first) & (part < end))
        rows = rows[np.argsort((side[rows] * 2 + hot[rows]) * parts + part[rows], kind="stable")]
        new = np.ones(len(rows), bool)
        new[1:] = (side[rows][1:] != side[rows][:-1]) | (hot[rows][1:] != hot[rows][:-1]) | (part[rows][1:] != part[rows][:-1])
        at = np.flatnonzero(new)
        mine = np.diff(np.append(at, len(rows)))
        lead = rows[at]  # the first product of a row, its lowest id
        other = side[lead] ^ across[lead]
        begin, stop = np.searchsorted(side, other), np.searchsorted(side, other, side="right")
        if once:
            span = _ranges(begin, stop - begin)
            higher = np.concatenate(([0], np.cumsum(ids[span] > np.repeat(ids[lead], stop - begin))))
            begin = stop - np.diff(higher[np.concatenate(([0], np.cumsum(stop - begin)))])
        some = stop > begin
        begin, stop, lead, mine, at = begin[some], stop[some], lead[some], mine[some], at[some]
        lengths = mine + stop - begin
        place = np.empty(int(lengths.sum()), np.int64)
        start = np.cumsum(lengths) - lengths
        place[_ranges(start, mine)] = rows[_ranges(at, mine)]
        place[_ranges(start + mine, stop - begin)] = _ranges(begin, stop - begin)
        several = (n > 1) | layout.far()
        packed = np.concatenate([_bytes(x, w) for x, w in zip((
            ids if layout.far() else (ids - layout.low) * 2 + several, total), layout.widths())], axis=1)
        several = several[place]
        ns = np.diff(np.concatenate(([0], np.cumsum(several)))[np.append(start, len(place))])
        return pa.RecordBatch.from_arrays(
            [pa.array(part[lead] - first, pa.int32()), pa.array(hot[lead]), pa.array(mine, pa.int32()),
             _binaries(packed[place], lengths), _binaries(_bytes(n[place][several], 8), ns)],
            names=["part", "hot", "mine", "items", "ns"])

    return run


def _sum_kernel(layout: Layout, k: int | None, baskets: int):
    """The sums of all pairs of a part's products, cut to the ``k`` best of each; hot products' are handed on whole.

    While they are summed, a pair is one number, or its place among those of a table too wide for that.
    """
    packs = layout.span < 3_037_000_499  # the square fits 63 bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, hot = Totals(layout), np.zeros(0, np.int64)
        held, fresh, waiting = None, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, baskets):
                for pairs in expand(batch.slice(at, baskets), totals):
                    hot = np.union1d(hot, pairs.pop())
                    fresh.append(pairs)
                    waiting += len(pairs[0])
                    if waiting > max(2 * SLICE_PAIRS, len(held[0]) if held else 0):
                        held, fresh, waiting = added(held, fresh), [], 0
        if fresh:
            held = added(held, fresh)
        if held is not None:
            yield from answer(held, totals, hot)

    def expand(batch: pa.RecordBatch, totals: Totals) -> Iterator[list]:
        """p1, p2 (or the number of both), product of counts, and which p1 are hot: for every pair of a product of a row and one it meets."""
        width = layout.widths()
        packed, lengths = _rows(batch.column("items"), sum(width))
        ids = _number(packed[:, :width[0]])
        n, ns = np.ones(len(ids), np.int64), _number(_rows(batch.column("ns"), 8)[0])
        if layout.far():
            n = ns
        else:
            n[(ids & 1).astype(bool)] = ns
            ids >>= 1
        totals.add(ids, _number(packed[:, width[0]:]))
        mine = batch.column("mine").to_numpy().astype(np.int64)
        start = np.cumsum(lengths) - lengths
        left, others, first = _ranges(start, mine), np.repeat(lengths - mine, mine), np.repeat(start + mine, mine)
        hot = np.repeat(batch.column("hot").to_numpy(zero_copy_only=False), mine)
        made = np.cumsum(others)
        cuts = [0, *np.flatnonzero(np.diff(made // SLICE_PAIRS, prepend=0)), len(left)]
        for a, b in zip(cuts, cuts[1:]):
            if b == a:
                continue
            met = _ranges(first[a:b], others[a:b])
            p1, p2 = np.repeat(ids[left[a:b]], others[a:b]), ids[met]
            keep = p1 < p2 if k is None else p1 != p2
            p1, p2 = p1[keep], p2[keep]
            times = (np.repeat(n[left[a:b]], others[a:b]) * n[met])[keep] if len(ns) else np.ones(len(p1), np.int64)
            yield [*((p1 * layout.span + p2,) if packs else (p1, p2)), times, np.unique(ids[left[a:b][hot[a:b]]])]

    def added(held: tuple | None, fresh: list) -> tuple:
        fresh = [np.concatenate(x) for x in zip(*fresh)]
        *pair, n = fresh
        if packs and n.sum() <= 2 * len(n):
            key = np.sort(pair[0] if len(n) == 0 or n.max() == 1 else np.repeat(pair[0], n))
            at = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
            fresh = [key[at], np.diff(np.append(at, len(key)))]
            if held is None:
                return tuple(fresh)
        *pair, n = (np.concatenate(x) for x in zip(held, fresh)) if held else fresh
        if len(n) == 0:
            return *pair, n
        order = np.argsort(pair[0], kind="stable") if packs else np.lexsort(pair[::-1])
        pair = [x[order] for x in pair]
        new = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([x[1:] != x[:-1] for x in pair]))))
        return *(x[new] for x in pair), np.add.reduceat(n[order], new)

    def answer(sums: tuple, totals: Totals, hot_ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        *pair, n = sums
        p1, p2 = np.divmod(pair[0], layout.span) if packs else pair
        total1, total2 = totals.of(p1), totals.of(p2)
        hot = np.isin(p1, hot_ids) if len(hot_ids) else np.zeros(len(p1), bool)
        rank = None
        if k is not None and len(p1):
            score = n / np.sqrt(total1.astype("float64") * total2)
            likely = np.flatnonzero((score >= _bound(p1, score, k)) | hot)
            order = likely[np.lexsort((p2[likely], -score[likely], p1[likely]))]
            sorted1 = p1[order]
            place = np.arange(len(order)) - np.searchsorted(sorted1, sorted1) + 1
            keep = (place <= k) | hot[order]
            order, rank = order[keep], place[keep]
            p1, p2, n, total1, total2, hot = (x[order] for x in (p1, p2, n, total1, total2, hot))
        for at in range(0, len(p1), 1 << 16):
            here = slice(at, at + (1 << 16))
            size = len(p1[here])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x[here], pa.int64()) for x in (p1 + layout.low, p2 + layout.low, n, total1, total2)),
                 pa.nulls(size, pa.int32()) if rank is None else pa.array(rank[here], pa.int32()), pa.array(hot[here])],
                names=["p1", "p2", "cocount", "count1", "count2", "rank", "hot"])

    return run


def _bound(p1: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """For each pair a number that the k-th best score of its p1 is not below; pairs of one p1 follow each other.

    The pairs of a p1 are cut in k pieces, whose best are k scores.
    """
    start = np.flatnonzero(np.diff(p1, prepend=p1[0] - 1))
    size = np.diff(np.append(start, len(p1)))
    least = np.full(len(start), -np.inf)
    long = np.flatnonzero(size > 2 * k)
    if len(long):
        # Between pieces of one p1 and the next of the long ones lie those of short ones: they join its last piece, so that is cut off.
        pieces = (start[long, None] + size[long, None] * np.arange(k) // k).ravel()
        cut = np.stack([pieces, np.append(pieces[1:], len(p1))], 1)
        cut[k - 1::k, 1] = start[long] + size[long]
        bounds = cut.ravel()
        best = np.maximum.reduceat(np.append(score, -np.inf), bounds)[::2]
        least[long] = best.reshape(-1, k).min(axis=1)
    return np.repeat(least, size)


class Totals:
    """The totals of the ids a task has seen, in an array where ids lie close together."""

    def __init__(self, layout: Layout):
        self.dense = np.zeros(layout.span, np.int64) if layout.span <= DENSE_IDS else None
        self.ids, self.totals = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, totals: np.ndarray) -> None:
        if self.dense is not None:
            self.dense[ids] = totals
            return
        ids, first = np.unique(np.concatenate((self.ids, ids)), return_index=True)
        self.totals, self.ids = np.concatenate((self.totals, totals))[first], ids

    def of(self, ids: np.ndarray) -> np.ndarray:
        if self.dense is not None:
            return self.dense[ids]
        return self.totals[np.searchsorted(self.ids, ids)]
