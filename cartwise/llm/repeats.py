"""Repeated passages: anchors bring equal strings together, and a two-stage suffix sort with common prefixes proves them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cartwise.llm.common import map_texts, ship, stored

LENGTH = 400  # bytes of a string that may not stand twice
GRAM = 160  # bytes of an anchor; every string of LENGTH bytes holds LENGTH - GRAM + 1 of them
PIECE = 1 << 18  # starts handled at once in a long text
HOT = 1_500  # distinct regions of one anchor that a task sorts, and their bytes; beyond, their strings are counted by digests
HOT_BYTES = 1 << 20
PACKED = 7  # letters of nine bits in a 64-bit number
COUNTED = 1 << 16  # strings of a batch on their way to be counted
_ODD = np.uint64(0x9E3779B97F4A7C15)


# --- anchors ---------------------------------------------------------------------------------------------------------

def _rolling(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on, from hashes of halves."""
    table = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(0xA0761D6478BD642F)
    power, width, part = np.uint64(0x2545F4914F6CDD1D), 1, table[codes]
    made, done = None, 0
    while True:
        if size & width:
            made = part if made is None else made[:len(codes) - done - width + 1] * power + part[done:]
            done += width
        if done == size:
            break
        part = part[:-width] * power + part[width:]
        with np.errstate(over="ignore"):
            power, width = power * power, width * 2
    made = (made ^ (made >> np.uint64(29))) * _ODD
    return made ^ (made >> np.uint64(32))


def _lowest(values: np.ndarray, size: int) -> np.ndarray:
    """The least of the ``size`` values from each place on."""
    width = 1
    while width * 2 <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def regions(text: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, first start, starts, inner): runs of string starts whose least anchor hash is one.

    The anchor of a start depends on its string alone, so equal strings are always under one anchor. ``inner`` is 1
    if the anchor stands twice in the run's strings, without which none of them can be another's equal.
    """
    for begin in range(0, len(text) - LENGTH + 1, PIECE):
        codes = np.frombuffer(text, np.uint8)[begin:begin + PIECE + LENGTH - 1]
        grams = _rolling(codes, GRAM)
        least = _lowest(grams, LENGTH - GRAM + 1)
        firsts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        sizes = np.diff(np.concatenate((firsts, [len(least)])))
        inner = np.concatenate([_twice(grams, least[f], f, z) for f, z in zip(np.array_split(firsts, len(firsts) // 2048 + 1),
                                                                              np.array_split(sizes, len(firsts) // 2048 + 1))])
        yield from zip(least[firsts].view(np.int64).tolist(), (firsts + begin).tolist(), sizes.tolist(), inner.tolist())


def _twice(grams: np.ndarray, anchors: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Does each run's anchor stand twice among its grams? A run longer than one anchor can cover has it twice."""
    reach = LENGTH - GRAM
    along = np.arange(2 * reach + 1)
    places = firsts[:, None] + along
    stands = (grams[np.minimum(places, len(grams) - 1)] == anchors[:, None]) & (along < (sizes + reach)[:, None])
    return ((stands.sum(1) > 1) | (sizes > reach + 1)).astype(np.int64)


# --- the suffix sort -------------------------------------------------------------------------------------------------

def suffix_order(codes: np.ndarray, wanted: np.ndarray, depth: int = LENGTH, words: np.ndarray | None = None) -> np.ndarray:
    """Places of the wanted suffixes in order of their first ``depth`` letters, by two-stage sorting.

    ``codes`` are letters from 1 up, and 0 ends each text. Suffixes smaller than their successors are sorted
    directly; the others are put behind, in the bucket of their first letter, when the scan of the buckets from the
    lowest up comes to their successor. A larger suffix needs its successor, so each wanted run is followed to the
    next smaller one.
    """
    size = len(codes)
    step = np.sign(np.diff(codes.astype(np.int32), append=0))
    last = np.where(step != 0, np.arange(size), size)
    decides = np.minimum.accumulate(last[::-1])[::-1]  # the next place whose letter differs from its successor's
    smaller = np.zeros(size, bool)
    inside = decides < size
    smaller[inside] = step[decides[inside]] > 0
    smaller[codes == 0] = True  # an end: nothing is induced beyond it
    stop = np.where(smaller, np.arange(size), size)
    stop = np.minimum.accumulate(stop[::-1])[::-1]  # the next smaller suffix, where the run of a wanted one ends
    edge = np.zeros(size + 1, np.int32)
    starts = np.flatnonzero(wanted)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(stop[starts], size - 1) + 1, -1)
    needed = np.cumsum(edge[:-1]) > 0
    direct = sorted_directly(packed(codes, depth) if words is None else words, np.flatnonzero(needed & smaller), depth)
    first = codes[direct]
    bounds = np.searchsorted(first, np.arange(258))
    waiting: list[list[np.ndarray]] = [[] for _ in range(258)]
    order: list[np.ndarray] = []
    induced = needed & ~smaller
    for letter in range(257):
        # Larger suffixes of this letter come before its smaller ones; those that begin a run of it call the next.
        queue, done = waiting[letter], 0
        while done < len(queue):
            _call(queue[done], codes, induced, waiting)
            done += 1
        own = direct[bounds[letter]:bounds[letter + 1]]
        _call(own, codes, induced, waiting)
        order += [*queue, own]
    return np.concatenate(order) if order else np.zeros(0, np.int64)


def packed(codes: np.ndarray, depth: int) -> np.ndarray:
    """From each place on seven letters as one number, nine bits each; behind the last text there are ends only."""
    wide = np.zeros(len(codes) + depth + 2 * PACKED, np.uint64)
    wide[:len(codes)] = codes
    words = np.zeros(len(codes) + depth + PACKED, np.uint64)
    for letter in range(PACKED):
        words <<= np.uint64(9)
        words |= wide[letter:letter + len(words)]
    return words


def sorted_directly(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """These suffixes in order of their first ``depth`` letters, seven at a time: only those still alike are looked at again.

    Of them, only groups whose next letters differ are sorted. What follows the end of a text may be compared
    too, but only between suffixes that are alike up to there. Memory is a few numbers for each suffix, however deep
    they are alike.
    """
    key = words[places]
    by = np.argsort(key, kind="stable")
    places, key = places[by], key[by]
    head = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    group = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))  # the first place of those alike
    live = _alike(group, np.arange(len(group)))
    for at in range(PACKED, depth, PACKED):
        if not len(live):
            break
        key, own = words[places[live] + at], group[live]
        differ = (key[1:] != key[:-1]) & (own[1:] == own[:-1])
        if not differ.any():
            continue
        mixed = np.isin(own, own[1:][differ])
        some, key, own = live[mixed], key[mixed], own[mixed]
        by = np.lexsort((key, own))
        places[some], key = places[some][by], key[by]
        head = np.concatenate(([True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])))
        group[some] = np.maximum.accumulate(np.where(head, some, 0))
        live = _alike(group[live], live)
    return places


def _alike(group: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Those of the places, in order, whose group has another member."""
    same = group[1:] == group[:-1]
    return places[np.append(same, False) | np.append(False, same)] if len(places) else places


def _call(places: np.ndarray, codes: np.ndarray, induced: np.ndarray, waiting: list[list[np.ndarray]]) -> None:
    """Put the larger suffixes just before these places, in their order, behind what waits for their first letters."""
    before = places[places > 0] - 1
    before = before[induced[before]]
    if len(before):
        letters = codes[before]
        sorted_by = np.argsort(letters, kind="stable")
        before, letters = before[sorted_by], letters[sorted_by]
        cuts = np.flatnonzero(letters[1:] != letters[:-1]) + 1
        for part in np.split(before, cuts):
            waiting[int(codes[part[0]])].append(part)


def common_prefixes(codes: np.ndarray, order: np.ndarray, most: int = LENGTH, words: np.ndarray | None = None) -> np.ndarray:
    """Letters that each suffix of the order shares with the one before it, up to ``most``; the first shares none."""
    words = packed(codes, most) if words is None else words
    shared = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for at in range(0, most, PACKED):
        apart = words[order[live - 1] + at] ^ words[order[live] + at]
        other = apart != 0
        shared[live[other]] = at + sum((apart[other] >> np.uint64(9 * left)) == 0 for left in range(PACKED))
        live = live[~other]
        if not len(live):
            break
    shared[live] = most
    ends = np.flatnonzero(codes == 0)
    left = ends[np.searchsorted(ends, order)] - order  # letters of each text behind a place
    shared[1:] = np.minimum(shared[1:], np.minimum(left[1:], left[:-1]))
    return np.minimum(shared, most)


def repeated_starts(texts: list[bytes], sizes: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, which of its first ``size`` starts have a string that also starts elsewhere in the texts."""
    codes = np.zeros(sum(map(len, texts)) + len(texts), np.int16)
    wanted = np.zeros(len(codes), bool)
    begins, at = [], 0
    for text, size in zip(texts, sizes):
        codes[at:at + len(text)] = np.frombuffer(text, np.uint8)
        codes[at:at + len(text)] += 1
        wanted[at:at + size] = True
        begins.append(at)
        at += len(text) + 1
    words = packed(codes, length)
    order = suffix_order(codes, wanted, length, words)
    order = order[wanted[order]]
    equal = common_prefixes(codes, order, length, words) >= length
    found = np.zeros(len(codes), bool)
    found[order[equal]] = True
    found[order[:-1][equal[1:]]] = True
    return [found[b:b + size] for b, size in zip(begins, sizes)]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


# --- on Spark --------------------------------------------------------------------------------------------------------

SORT_BYTES = 256 << 10  # bytes of regions that are sorted together
KEY = ["k1", "k2"]


def _region_kernel():
    def step(batch: pa.RecordBatch) -> dict:
        rows: list[list[int]] = [[], [], [], [], [], [], []]
        for k1, k2, text in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text"))):
            for anchor, start, size, inner in regions(text):
                digest = xxhash.xxh3_64_intdigest(text[start:start + size + LENGTH - 1])
                for column, value in zip(rows, (k1, k2, anchor, digest - (1 << 63), start, size, inner)):
                    column.append(value)
        return {n: pa.array(c, pa.int64()) for n, c in zip(("k1", "k2", "anchor", "digest", "start", "size", "inner"), rows)}

    return step


def _cut_kernel():
    def step(batch: pa.RecordBatch) -> dict:
        anchors, digests, sizes, parts = [], [], [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            for w in wanted:
                anchors.append(w["anchor"])
                digests.append(w["digest"])
                sizes.append(w["size"])
                parts.append(text[w["start"]:w["start"] + w["size"] + LENGTH - 1])
        return {"anchor": pa.array(anchors, pa.int64()), "digest": pa.array(digests, pa.int64()),
                "size": pa.array(sizes, pa.int64()), "part": pa.array(parts, pa.binary())}

    return step


SPANS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
FOUND = "anchor long, digest long, spans array<struct<lo:bigint,hi:bigint>>"


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by anchor; whole anchors are gathered up to SORT_BYTES and sorted together."""
    held: list[tuple] = []
    weight = 0

    def done() -> pa.RecordBatch:
        flags = repeated_starts([h[3] for h in held], [h[2] for h in held])
        made = [(h[0], h[1], [{"lo": a, "hi": b} for a, b in runs(f)]) for h, f in zip(held, flags) if f.any()]
        columns = list(zip(*made)) if made else [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], SPANS)],
            names=["anchor", "digest", "spans"],
        )

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "size", "part"))):
            if held and weight >= SORT_BYTES and row[0] != held[-1][0]:
                yield done()
                held, weight = [], 0
            held.append(row)
            weight += len(row[3])
    if held:
        yield done()


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``anchor``, ``digest``, ``start``, ``string`` (its 128-bit digest) for every start of a region, COUNTED at a time."""
    for batch in batches:
        for anchor, digest, size, part in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "size", "part"))):
            for low in range(0, size, COUNTED):
                starts = range(low, min(low + COUNTED, size))
                made = [xxhash.xxh3_128_digest(part[s:s + LENGTH]) for s in starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(made), anchor)), pa.array(np.full(len(made), digest)), pa.array(np.array(starts)),
                     pa.array(made, pa.binary())], names=["anchor", "digest", "start", "string"])


def _result_kernel():
    def step(batch: pa.RecordBatch) -> dict:
        size, gone, spans, digest = [], [], [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            left, cut, count, at = [], 0, 0, 0
            for lo, hi in sorted((f["lo"], f["hi"] + LENGTH - 1) for f in found or ()):
                if lo > at or count == 0:
                    left.append(text[at:lo])
                    count += 1
                    cut += hi - lo
                elif hi > at:
                    cut += hi - at
                at = max(at, hi)
            left.append(text[at:])
            size.append(len(text))
            gone.append(cut)
            spans.append(count)
            digest.append(hashlib.sha256(b"".join(left)).hexdigest())
        return {"doc_id": batch.column("doc_id"), "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}

    return step


def repeated_strings(docs: DataFrame, hot: int = HOT, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``k1``, ``k2`` (a text's two hashes), ``spans``: starts of strings of LENGTH bytes that also start elsewhere.

    Every text is cut into regions, runs of starts under one anchor. Equal regions are a class before anything is
    sorted, so a group of copies of any size is one region; a class of two has only repeated starts. Anchors with
    more than one class, or with one that may repeat itself, go to the suffix sort, each whole to one task, unless over ``hot`` classes share one
    or they have over ``hot_bytes`` bytes: then each string of theirs is counted by a 128-bit digest instead, which splits any group and is as exact.
    """
    made = map_texts(docs.where(F.length("text") >= LENGTH),
                     "k1 long, k2 long, anchor long, digest long, start long, size long, inner long", _region_kernel)
    found = stored(made)
    classes = stored(found.groupBy("anchor", "digest", "size").agg(
        F.count(F.lit(1)).alias("n"), F.max("inner").alias("inner"), F.min(F.struct("k1", "k2", "start")).alias("at")
    ))
    weight = F.sum(F.col("size") + LENGTH)
    kinds = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.max("inner").alias("any"), weight.alias("bytes"))
    kinds = kinds.where("kinds > 1 or any = 1").withColumn("few", (F.col("kinds") <= hot) & (F.col("bytes") <= hot_bytes))
    mixed = classes.join(kinds, "anchor").select("anchor", "digest", "size", "at.*")
    wanted = mixed.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "digest", "size", "start")).alias("wanted"))
    one = docs.where(F.length("text") >= LENGTH).dropDuplicates(KEY)
    parts = stored(map_texts(one.join(wanted, KEY).select("text", "wanted"),
                             "anchor long, digest long, size long, part binary", _cut_kernel))
    several = kinds.where("few").select("anchor")
    by_anchor = parts.join(several, "anchor", "left_semi").repartition("anchor").sortWithinPartitions("anchor", "digest")
    sorted_out = by_anchor.mapInArrow(_sorted_groups, FOUND)
    crowded = parts.join(kinds.where("not few").select("anchor"), "anchor", "left_semi")
    ship(docs.sparkSession)
    strings = crowded.mapInArrow(_strings, "anchor long, digest long, start long, string binary")
    again = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
    counted = strings.join(again, "string", "left_semi").groupBy("anchor", "digest").agg(
        F.transform(F.collect_set("start"), lambda s: F.struct(s.alias("lo"), (s + 1).alias("hi"))).alias("spans")
    )
    every = classes.where("n > 1").select("anchor", "digest", F.array(
        F.struct(F.lit(0).cast("long").alias("lo"), F.col("size").alias("hi"))).alias("spans"))
    marks = every.union(sorted_out).union(counted)
    placed = found.select(*KEY, "anchor", "digest", "start").distinct().join(marks, ["anchor", "digest"])
    shifted = F.transform("spans", lambda s: F.struct((s["lo"] + F.col("start")).alias("lo"), (s["hi"] + F.col("start")).alias("hi")))
    return placed.groupBy(*KEY).agg(F.flatten(F.collect_list(shifted)).alias("spans"))


def remove_repeats(docs: DataFrame, hot: int = HOT, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, one row per row of ``docs``.

    Each byte under a string of LENGTH bytes that also starts anywhere else is removed, in every place, the first
    included; matches never cross documents. Null text counts as empty; shorter texts stay whole. Ids may be null or
    repeat, repeated rows are repeats of each other, an empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    spans = stored(repeated_strings(keyed.drop("doc_id"), hot, hot_bytes))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_texts(keyed.join(spans, KEY, "left").select("doc_id", "text", "spans"), schema, _result_kernel)
