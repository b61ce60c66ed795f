"""Mixing sources to target weights: documents grouped by the sources they belong to, routed by min-cost flow."""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwise.llm.common import stored

SHARE, MOST, SEED = 1.0, 3, 20  # words to take, as a share of all; times a document may be taken; seed of the draw
BITS = 12  # a level of the draw halves the range this often
TOP = 63
FILLS = 4  # documents that may close the gap after the drawn prefix, one a pass

@dataclass
class Group:
    """Documents of one membership pattern that are credited to one source."""

    quota: int  # words to take
    size: int = 0
    whole: int = 0  # times each document is taken
    rest: int = 0  # words still to be taken once more
    below: int = 0  # documents of a lower draw are taken once more
    more: tuple[int, ...] = ()  # draws of further ones


def targets(sizes: dict[str | None, int], share: float = SHARE, most: int = MOST) -> dict[str | None, float]:
    """Words to take of each source: weights 1, 2, 3, repeating, in code point order, null last.

    A target stops at ``most`` times its source's size and what is over is shared by weight among the others.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {name: 1 + place % 3 for place, name in enumerate(names)}
    out: dict[str | None, float] = {}
    left, free = share * sum(sizes.values()), list(names)
    while free:
        total = sum(weight[n] for n in free)
        given = {n: left * weight[n] / total for n in free}
        over = [n for n in free if given[n] > most * sizes[n]]
        if not over:
            return out | given
        for n in over:
            out[n] = float(most * sizes[n])
        left -= sum(most * sizes[n] for n in over)
        free = [n for n in free if n not in over]
    return out


def min_cost_flow(supply: dict[str, int], members: dict[str, list], quota: dict, most: int = MOST) -> dict[tuple[str, object], int]:
    """Words that each pattern gives to each of its sources.

    A pattern has ``most`` arcs of its size, the i-th at cost i, so repeating is convex and the first copies of all
    go before the second of any; a source takes its quota. Successive cheapest paths give the largest flow and, of
    those, the cheapest.
    """
    ends: list[int] = []
    room: list[int] = []
    cost: list[int] = []
    out: dict[object, list[int]] = {}

    def arc(a, b, capacity: int, price: int) -> int:
        for u, v, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            out.setdefault(u, []).append(len(ends))
            ends.append(v)
            room.append(c)
            cost.append(p)
        return len(ends) - 2

    start, stop = ("start",), ("stop",)
    out[start], out[stop] = [], []
    routes = {}
    for name, size in supply.items():
        for copy in range(most):
            arc(start, ("pattern", name), size, copy)
        for source in members[name]:
            routes[name, source] = arc(("pattern", name), ("source", source), most * size, 0)
    for source, words in quota.items():
        arc(("source", source), stop, words, 0)
    while True:
        price, into, queue = {start: 0}, {}, deque([start])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                v = ends[e]
                if room[e] > 0 and price[u] + cost[e] < price.get(v, 1 << 60):
                    price[v], into[v] = price[u] + cost[e], e
                    queue.append(v)
        if stop not in price:
            break
        path, v = [], stop
        while v != start:
            path.append(into[v])
            v = ends[into[v] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    return {route: room[e ^ 1] for route, e in routes.items() if room[e ^ 1] > 0}


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def drawn(docs: DataFrame, members: Column, keep: list[str], seed: int = SEED) -> DataFrame:
    """``row``, a struct of the columns to keep, ``pattern`` (the sources as JSON, sorted), ``size``, and ``draw``, below 2^63.

    The draw depends on seed, id and text only, so reruns agree; rows equal in both are drawn alike.
    """
    return docs.select(
        F.struct(*[docs[c] for c in keep]).alias("row"), F.to_json(F.array_sort(F.array_distinct(members))).alias("pattern"),
        size(docs["text"]).alias("size"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), docs["doc_id"], docs["text"]), 1).alias("draw"),
    )


class Mix:
    """A plan of how often each document is taken; made from the whole table, small itself: a row per group."""

    def __init__(self, rows: DataFrame, share: float = SHARE, most: int = MOST):
        """``rows`` has ``pattern``, ``size``, ``draw``. Runs a fixed number of aggregations.

        The driver holds a row per membership pattern and per source; their number is that of the corpora mixed
        and their overlaps, not of documents.
        """
        supply = {r[0]: r[1] for r in rows.where("pattern is not null").groupBy("pattern").agg(F.sum("size")).collect()}
        self.members = {name: json.loads(name) for name in supply}
        self.source_size: dict[str | None, int] = {}
        for name, words in supply.items():
            for source in self.members[name]:
                self.source_size[source] = self.source_size.get(source, 0) + words
        # Shares count each document once, however many sources it is in.
        scale = share * sum(w for n, w in supply.items() if self.members[n]) / max(sum(self.source_size.values()), 1)
        self.target = targets(self.source_size, scale, most)
        flow = min_cost_flow(supply, self.members, {s: round(t) for s, t in self.target.items()}, most)
        self.split: dict[str, list[tuple[str | None, float]]] = {}
        self.groups: dict[str, Group] = {}
        for name, sources in self.members.items():
            own = [(s, flow[name, s]) for s in sources if (name, s) in flow]
            total, reached = sum(w for _, w in own), 0
            self.split[name] = []
            for index, (source, words) in enumerate(own or [(s, 0) for s in sources[:1]]):
                reached += words
                self.split[name].append((source, reached / total if total else 1.0))
                self.groups[_group(name, index)] = Group(words)
        rows = rows.select(self.group_of().alias("group"), "size", "draw").where("group is not null")
        for r in rows.groupBy("group").agg(F.sum("size").alias("size")).collect():
            self.groups[r[0]].size = r.size
        for group in self.groups.values():
            if group.size:
                group.quota = min(group.quota, most * group.size)
                group.whole, group.rest = divmod(group.quota, group.size)
        self._draw(rows)
        for _ in range(FILLS):
            if not self._fill(rows):
                break
        self._fill(rows, over=True)

    def group_of(self) -> Column:
        """The group of a row; a pattern that serves several sources is dealt among them by a hash of the draw."""
        place = F.pmod(F.xxhash64("draw"), F.lit(1 << 30)) / float(1 << 30)
        out = F.when(F.json_array_length("pattern") > 0, F.concat("pattern", F.lit("\t0")))
        for name, parts in self.split.items():
            if len(parts) > 1:
                dealt = F.lit(_group(name, len(parts) - 1))
                for index in range(len(parts) - 2, -1, -1):
                    dealt = F.when(place < parts[index][1], F.lit(_group(name, index))).otherwise(dealt)
                out = F.when(F.col("pattern") == name, dealt).otherwise(out)
        return out

    def _draw(self, rows: DataFrame) -> None:
        """Find for each group the draw below which documents add up to its rest, level by level."""
        at = {g: (0, group.rest) for g, group in self.groups.items() if group.rest}  # prefix of the draw, words left
        for level in (1, 2):
            shift = TOP - BITS * level
            state = _frame(rows, [(g, prefix, left) for g, (prefix, left) in at.items()], "group string, prefix long, left long")
            inside = rows.join(F.broadcast(state), "group").where(F.shiftright("draw", shift + BITS) == F.col("prefix"))
            sums = inside.groupBy("group", F.shiftright("draw", shift).alias("bucket")).agg(F.sum("size").alias("words"))
            at = self._cut(sums, at)
        state = _frame(rows, [(g, prefix, left) for g, (prefix, left) in at.items()], "group string, prefix long, left long")
        last = rows.join(F.broadcast(state), "group").where(F.shiftright("draw", TOP - 2 * BITS) == F.col("prefix"))
        sums = last.groupBy("group", F.col("draw").alias("bucket")).agg(F.sum("size").alias("words"))
        for g, (bucket, left) in self._cut(sums, at).items():
            self.groups[g].below, self.groups[g].rest = bucket, left

    def _cut(self, sums: DataFrame, at: dict[str, tuple[int, int]]) -> dict[str, tuple[int, int]]:
        """The first bucket of each group that does not fit whole, and the words left before it.

        A group has at most 2^BITS buckets at each of the first two levels, and those of its last range at the third.
        """
        state = _frame(sums, [(g, left) for g, (_, left) in at.items()], "group string, left long")
        run = F.sum("words").over(_in_order())
        row = sums.join(F.broadcast(state), "group").withColumn("run", run).where("run > left")
        first = row.groupBy("group").agg(F.min(F.struct("bucket", "run", "words", "left")).alias("cut"))
        return {r[0]: (r.cut.bucket, r.cut.left - (r.cut.run - r.cut.words)) for r in first.collect()}

    def _fill(self, rows: DataFrame, over: bool = False) -> bool:
        """Take in each group the largest document not yet taken once more that fits the words left.

        With ``over`` the smallest that does not fit, if that brings the group nearer to its quota.
        """
        wanting = [(g, group.below, list(group.more), group.rest) for g, group in self.groups.items() if group.rest > 0]
        if not wanting:
            return False
        state = _frame(rows, wanting, "group string, below long, more array<long>, rest long")
        room, words = F.col("rest"), F.col("size")
        fits = (words > room) & (words < 2 * room) if over else (words > 0) & (words <= room)
        fits = fits & (F.col("draw") >= F.col("below")) & ~F.array_contains("more", F.col("draw"))
        pick = F.min if over else F.max
        best = rows.join(F.broadcast(state), "group").where(fits).groupBy("group").agg(
            pick(F.struct("size", "draw")).alias("best")
        ).collect()
        for r in best:
            group = self.groups[r[0]]
            group.more, group.rest = (*group.more, r.best[1]), group.rest - r.best[0]
        return bool(best)

    def apply(self, rows: DataFrame) -> DataFrame:
        """The rows with ``times``, ``source_size``, ``target``; 0 times and nulls without a source."""
        facts = []
        for name, parts in self.split.items():
            for index, (source, _) in enumerate(parts):
                g = self.groups[_group(name, index)]
                facts.append((_group(name, index), g.whole, g.below, list(g.more), self.source_size[source], self.target[source]))
        schema = "group string, whole long, below long, more array<long>, source_size long, target double"
        found = rows.withColumn("group", self.group_of()).join(F.broadcast(_frame(rows, facts, schema)), "group", "left")
        again = (F.col("draw") < F.col("below")) | F.array_contains("more", F.col("draw"))
        times = F.when(F.col("size") > 0, F.col("whole") + again.cast("long"))
        return found.select("row", "size", "source_size", "target", F.coalesce(times, F.lit(0).cast("long")).alias("times"))


def mix(docs: DataFrame, members: Column | None = None, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, one row per row of ``docs``.

    ``members`` is the array of sources a document belongs to, its ``source`` alone by default; a document is
    credited to one of them, whose size and target are shown. Null text has size 0 and is never taken; a null source
    is a source of its own, a null or empty array is none: such rows have null targets and are not taken. Rows equal
    in id and text are drawn alike. Empty tables give no rows; other columns are not read.
    """
    rows = stored(drawn(docs, F.array("source") if members is None else members, ["doc_id"], seed))
    return Mix(rows, share, most).apply(rows).select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def mixed(docs: DataFrame, members: Column | None = None, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as often as :func:`mix` takes them, with their columns, whatever those are called.

    Null texts and texts without words have size 0 and are never taken; a null source is one of its own; repeated rows are
    taken each on their own, by the hash of their id and text; an empty table gives no rows.
    """
    rows = drawn(docs, F.array("source") if members is None else members, docs.columns, seed)
    plan = Mix(stored(rows.drop("row")), share, most)
    return plan.apply(rows).select("row", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))).alias("copy")).select("row.*")


def _frame(like: DataFrame, rows: list, schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame(rows, schema)


def _group(pattern: str, index: int) -> str:
    return f"{pattern}\t{index}"


def _in_order():
    return Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
