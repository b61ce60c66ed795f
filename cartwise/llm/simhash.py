"""SimHash near-duplicates: majority fingerprints of word shingles, linked by multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cartwise.llm.common import carried, map_texts, stored, with_row
from cartwise.llm.graph import components

SHINGLE, SEED, RADIUS = 3, 42, 2
HALF, LOW = 32, 0xFFFFFFFF
BLOCK = 255  # so many bits add up in one byte


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """The hashes of all runs of ``size`` words, of a shorter text that of the whole; null or no words gives none."""
    words = text.lower().split() if text else []  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-size] + 1))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())], np.uint64)


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text; null or no words gives 0."""
    hashes = shingles(text, size)
    return _majority(hashes) if len(hashes) else 0


def _majority(hashes: np.ndarray) -> int:
    count = np.zeros(64, np.int64)
    for start in range(0, len(hashes), BLOCK * 64):
        part = hashes[start:start + BLOCK * 64]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // BLOCK
        if whole:
            count += bits[:whole * BLOCK].reshape(whole, BLOCK, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        count += bits[whole * BLOCK:].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _kernel():
    def step(batch: pa.RecordBatch) -> dict:
        made = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        return {"doc_id": batch.column("doc_id"), "fp": made.view(np.int64)}

    return step


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a long), one row per row of ``docs``."""
    return map_texts(docs.select("doc_id", F.col("text").cast("binary").alias("text")), "doc_id long, fp long", _kernel)


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs of distinct fingerprints at 1 to ``radius`` differing bits, as ``a``, ``b``, found by multi-index hashing.

    A fingerprint is two segments of 32 bits; of two that differ in at most 3 bits, one segment differs in at
    most 1. Each segment is a table; a fingerprint looks up its own segment and the 32 one bit away. A pair one
    bit apart is met from both sides, so only the side whose bit is 0 looks, which halves the probes. The two are
    shuffled: Spark takes the probes, a score for each fingerprint, to be no larger than the stored table they
    unfold from, and would send them through the driver.
    """
    if not 0 <= radius <= 3:
        raise ValueError("two segments and a ball of one bit find pairs of up to 3 bits")
    fp = F.col("fp")
    table = None
    probe = None
    for index, segment in enumerate((fp.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(fp, HALF))):
        own = F.lit(index).alias("seg")
        rows = fps.select(own, segment.alias("key"), fp.alias("b"))
        ball = F.concat(
            F.array(segment),
            F.transform(
                F.filter(F.sequence(F.lit(0), F.lit(HALF - 1)), lambda i: F.call_function("getbit", segment, i) == 0),
                lambda i: segment.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
            ),
        )
        looks = fps.select(own, F.explode(ball).alias("key"), fp.alias("a"))
        table = rows if table is None else table.union(rows)
        probe = looks if probe is None else probe.union(looks)
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return probe.hint("merge").join(table, ["seg", "key"]).where((F.col("a") != F.col("b")) & (apart <= radius)).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id``: the smallest doc_id that links reach, one row per row of ``docs``.

    Rows of one fingerprint are a class before any pair is sought, so a group of copies of any size is one
    fingerprint. Null, empty and blank texts have fingerprint 0 and link like any other. A null doc_id is never
    the smallest; a component of null ids only has a null component_id. Repeated rows each get a row. An empty
    table gives none. Other columns are not read.
    """
    rows = stored(fingerprints(docs))
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    grouped = components(links(classes))
    named = classes.join(grouped, classes.fp == grouped.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of = named.join(lowest, "root").select("fp", "component_id")
    return rows.join(of, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def survivors(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The columns of ``docs`` for one row of each component: its smallest doc_id, of equal ids the lowest text hash.

    Shingles are of ``size`` words, links of up to ``radius`` bits. Of rows with one id and one text any one stays. Rows
    of a component whose ids are all null count as ids alike; null, empty and blank texts are one component. An empty
    table gives no rows. Which rows stay is settled on ids and hashes; only then are whole rows joined, once.
    """
    held = carried(docs, docs.columns)
    # The place of a row is fixed by the table it is written to.
    marked = stored(map_texts(held, with_row(held, "fp long"), _keeping_kernel, size)
                    .withColumn("place", F.monotonically_increasing_id()))
    first = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.xxhash64("row.text"), "place")
    classes = stored(marked.groupBy("fp").agg(F.min(first).alias("low")))
    grouped = components(links(classes, radius))
    of = classes.join(grouped, classes.fp == grouped.node, "left").select(F.coalesce("root", "fp").alias("root"), "low")
    stay = of.groupBy("root").agg(F.min("low")["place"].alias("place"))
    return marked.join(stay.select("place"), "place", "left_semi").select("row.*")


def _keeping_kernel(size: int):
    def step(batch: pa.RecordBatch) -> dict:
        made = np.array([fingerprint(t, size) for t in batch.column("text").to_pylist()], np.uint64)
        return {"row": batch.column("row"), "fp": made.view(np.int64)}

    return step
