"""Near-duplicate vectors by lattice hashing: random projections decoded to points of E8, neighbours probed."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartwise.llm.common import map_texts, stored
from cartwise.llm.graph import components

LEAST = 0.98  # cosine from which vectors link
TABLES, BLOCKS, PROBES = 10, 3, 6  # tables; blocks of 8 projections in a key; neighbouring cells looked up in a table
SCALE, SEED = 0.55, 11  # lattice units for a projection of length 1


def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two whole entries of 1, or eight halves with an even number of minus signs."""
    made = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            made.append(v)
    made += [np.array(s) / 2 for s in itertools.product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(made)


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest point with whole entries of an even sum."""
    whole = np.rint(x)
    off = x - whole
    worst = np.abs(off).argmax(1)
    rows = np.flatnonzero(whole.sum(1) % 2)
    column = worst[rows]
    whole[rows, column] += np.where(off[rows, column] >= 0, 1, -1)
    return whole


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8 to each row of eight numbers."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(closer[:, None], a, b)


def cells(vectors: np.ndarray, labels: np.ndarray, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES) -> np.ndarray:
    """Keys of the cells of each vector: [vectors, tables, 1 + probes], its own first, then those nearest to it."""
    count, dim = vectors.shape
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    steps = shortest()
    out = np.zeros((count, tables, 1 + probes), np.uint64)
    for table in range(tables):
        rng = np.random.default_rng([SEED, dim, table])
        at = unit @ rng.standard_normal((dim, 8 * blocks)) * SCALE
        mixers = rng.integers(0, 1 << 63, (blocks, 8), np.uint64) * np.uint64(2) + np.uint64(1)
        base = _mixed(labels.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(table))
        own = np.zeros(count, np.uint64)
        gain, change = [], []
        for block in range(blocks):
            x = at[:, 8 * block:8 * block + 8]
            point = nearest(x)
            own += (point * 2).astype(np.int64).view(np.uint64) @ mixers[block]
            gain.append((x - point) @ steps.T)
            change.append((steps * 2).astype(np.int64).view(np.uint64) @ mixers[block])
        gain, change = np.concatenate(gain, 1), np.concatenate(change)
        best = np.argpartition(-gain, probes, axis=1)[:, :probes]
        out[:, table, 0] = own
        out[:, table, 1:] = own[:, None] + change[best]
        out[:, table] = _mixed(out[:, table] ^ base[:, None])
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _by_length(vectors: list) -> dict[int, list[int]]:
    rows: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        rows.setdefault(len(v), []).append(i)
    return rows


def _cell_kernel(tables: int, blocks: int, probes: int):
    def step(batch: pa.RecordBatch) -> dict:
        vectors, labels = batch.column("embedding").to_pylist(), batch.column("label").to_pylist()
        keys = np.zeros((len(vectors), tables, 1 + probes), np.uint64)
        for rows in _by_length(vectors).values():
            keys[rows] = cells(np.array([vectors[i] for i in rows], float), np.array([labels[i] for i in rows], np.int64), tables, blocks, probes)
        own = np.zeros_like(keys, bool)
        own[:, :, 0] = True
        index = pa.array(np.repeat(np.arange(len(vectors)), tables * (1 + probes)))
        return {"cid": batch.column("cid").take(index), "cell": keys.reshape(-1).view(np.int64), "own": pa.array(own.reshape(-1))}

    return step


def _cosine_kernel(least: float):
    def step(batch: pa.RecordBatch) -> dict:
        left, right = batch.column("va").to_pylist(), batch.column("vb").to_pylist()
        keep = np.zeros(len(left), bool)
        for rows in _by_length(left).values():
            rows = [i for i in rows if len(right[i]) == len(left[i])]
            if rows:
                a, b = np.array([left[i] for i in rows], float), np.array([right[i] for i in rows], float)
                cosine = (a * b).sum(1) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
                keep[rows] = cosine >= least
        chosen = pa.array(np.flatnonzero(keep))
        return {"a": batch.column("a").take(chosen), "b": batch.column("b").take(chosen)}

    return step


def usable(embedding: Column, label: Column) -> Column:
    """Has the row a label and a vector of finite numbers that are not all zero?"""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def links(classes: DataFrame, least: float = LEAST, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES) -> DataFrame:
    """``a``, ``b``: pairs of classes, found by sharing a cell or probing the other's, with cosine ``least`` or more."""
    made = stored(map_texts(classes.select("cid", "label", "embedding"), "cid string, cell long, own boolean", _cell_kernel,
                            tables, blocks, probes, column="embedding"))
    home = made.where("own").select("cell", F.col("cid").alias("b"))
    looks = made.select("cell", F.col("cid").alias("a"))
    pairs = looks.join(home, "cell").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    va = classes.select(F.col("cid").alias("a"), F.col("embedding").alias("va"))
    vb = classes.select(F.col("cid").alias("b"), F.col("embedding").alias("vb"))
    return map_texts(pairs.join(va, "a").join(vb, "b").select("a", "b", "va", "vb"), "a string, b string", _cosine_kernel, least, column="va")


def near_duplicates(
    vectors: DataFrame, least: float = LEAST, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``, one row per row of ``vectors``.

    Vectors of one label that are equal are a class, so copies are never paired; the links of a class count with its
    size. Null, zero and not finite vectors, and those without a label, link with nothing and are their own component,
    as does a vector of another length. ``component_id`` is the smallest vec_id that links reach; null ids are never
    the smallest. Repeated rows are vectors like any other; an empty table gives no rows; other columns are not read.
    More ``tables`` and ``probes`` find more, more ``blocks`` make cells smaller.
    """
    ok = usable(F.col("embedding"), F.col("label"))
    cid = F.concat(F.hex(F.xxhash64("label", "embedding")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), "label", "embedding")))
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.select("vec_id", "label", "embedding", F.when(ok, cid).alias("cid"))
    classes = stored(rows.where("cid is not null").groupBy("cid").agg(
        F.first("label").cast("long").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("n"),
        F.min("vec_id").alias("low"),
    ))
    found = stored(links(classes, least, tables, blocks, probes))
    both = found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("cid").alias("b"), "n")
    linked = both.join(sizes, "b").groupBy("a").agg(F.sum("n").alias("others"))
    grouped = components(found)
    named = classes.join(linked, classes.cid == linked.a, "left").join(grouped, classes.cid == grouped.node, "left").select(
        "cid", "low", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "cid").alias("root")
    )
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    facts = named.join(lowest, "root").select("cid", "n_links", "component_id")
    component = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", "cid").join(facts, "cid", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


# The same result as DuckDB SQL over ``embeddings``, by comparing all pairs of a label.
ORACLE = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= {LEAST}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low ON low.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""
