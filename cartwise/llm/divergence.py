"""How the sources of a language differ in their words: chi-square-like divergences of smoothed shares, in whole numbers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwise.llm.common import ship, slices, stored

# Documents of a language that a kept term is in at least, parts that make a whole share, listed terms.
SUPPORT, WHOLE, LISTED = 3, 1_000_000_000, 200
# One pass over a text: capital ASCII letters to small ones, other ASCII but letters to blanks, the rest as it is.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
HELD = 300_000  # entries of the sums a task holds before it hands them on
TERMS, SOURCES = 2048, 256  # terms of a block, sources of each of its sides
COUNTS = "lang string, source string, term string, count long, docs long"
PAIRS = "lang string, source string, item string, part long, seen long"


def terms(text: bytes | None) -> Counter:
    """How often each term stands in a text; null has none."""
    return Counter(text.translate(TABLE).split()) if text else Counter()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequencies and document counts summed by language, source and term over what a task reads, handed on in parts."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush() -> pa.RecordBatch:
        groups = [(lang, source, count, docs) for (lang, source), (count, docs) in held.items()]
        sizes = [len(count) for _, _, count, _ in groups]
        place = pa.array(np.repeat(np.arange(len(groups)), sizes))
        columns = [
            pa.array([g[0] for g in groups], pa.string()).take(place),
            pa.array([g[1] for g in groups], pa.string()).take(place),
            pa.array([t for _, _, count, _ in groups for t in count], pa.binary()).cast(pa.string()),
            pa.array([n for _, _, count, _ in groups for n in count.values()], pa.int64()),
            pa.array([docs[t] for _, _, count, docs in groups for t in count], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "count", "docs"])

    for batch in slices(batches, "text"):
        rows = zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")))
        for lang, source, text in rows:
            mine = terms(text)
            count, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(count)
            count.update(mine)
            docs.update(mine.keys())
            size += len(count)
            if size >= HELD:
                yield flush()
                held, size = {}, 0
    if held:
        yield flush()


def counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``count``, ``docs``: occurrences, and documents with the term, by group."""
    ship(docs.sparkSession)
    read = docs.select(_blank("lang"), _blank("source"), F.col("text").cast("binary").alias("text"))
    made = read.mapInArrow(_summed, COUNTS)
    return made.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(WHOLE * (count + 1) / (total + kept)), exact however large the counts; null if there is nothing to divide by."""
    parts = F.lit(WHOLE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return F.call_function("div", parts, F.nullif((total + kept).cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))) + 1


def _value(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _met(block: pa.Table) -> pa.Table:
    """The values of all pairs of one side's sources with the other's, summed over the terms of a block.

    Rows without a term are the roster: each source of the two sides with the share of a term it does not have.
    """
    lang, lo, hi = (block.column(c)[0].as_py() for c in ("lang", "lo", "hi"))
    roster = block.filter(pc.is_null(block.column("term")))
    entry = block.filter(pc.is_valid(block.column("term")))
    names = np.array(roster.column("source").to_pylist(), object)
    side, least = roster.column("own").to_numpy(), roster.column("p").to_numpy()
    if not entry.num_rows:
        return pa.table({c: [] for c in ("lang", "source", "item", "part", "seen")}, _PAIR)
    term = entry.column("term").combine_chunks().dictionary_encode()
    seen = len(term.dictionary)
    row_of = {name: i for i, name in enumerate(names.tolist())}
    row = np.fromiter((row_of[s] for s in entry.column("source").to_pylist()), np.int64, entry.num_rows)
    share = np.repeat(least[:, None], seen, axis=1)
    share[row, term.indices.to_numpy()] = entry.column("p").to_numpy()
    left, right = np.flatnonzero(side == lo), np.flatnonzero(side == hi)
    source, item, part = [], [], []
    for mine, others in ((left, right),) if lo == hi else ((left, right), (right, left)):
        for a in mine:
            others_of = others[others != a]
            apart = share[a] - share[others_of]
            part.append((apart * apart // share[others_of]).sum(axis=1))
            source += [names[a]] * len(others_of)
            item += names[others_of].tolist()
    part = np.concatenate(part) if part else np.zeros(0, np.int64)
    return pa.table([[lang] * len(source), source, item, part, [seen] * len(source)], schema=_PAIR)


_PAIR = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("part", pa.int64()), ("seen", pa.int64())])


def _pairs(entries: DataFrame, groups: DataFrame, size: int, sources: int, terms_: int, sides: int) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value`` of all pairs of a language's sources.

    A task takes a block of terms and two sides of sources, however many of either there are, and adds up its
    values: no pair of rows of a term is made. Terms that neither side has give every pair of it one value, once.
    """
    blocks = max(1, -(-size // terms_))
    chunks = max(1, -(-sides // sources))

    def routed(df: DataFrame) -> DataFrame:
        own = df.withColumn("own", F.pmod(F.xxhash64("source"), F.lit(chunks)).cast("int"))
        return own.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).select(
            "lang", "block", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "source", "term", "p")

    mine = entries.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"), "source", "term", "p")
    roster = groups.where("v > 0").select("lang", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "source",
                                          F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"))
    met = routed(mine).unionByName(routed(roster)).groupBy("lang", "block", "lo", "hi").applyInArrow(_met, PAIRS)
    summed = met.groupBy("lang", "source", "item").agg(F.sum("part").alias("part"), F.sum("seen").alias("seen"))
    left = groups.select("lang", "source", "v", "p0")
    right = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    every = left.join(right, "lang").where("source <> item").join(summed, ["lang", "source", "item"], "left")
    rest = (F.col("v") - F.coalesce("seen", F.lit(0))) * _value(F.col("p0"), F.col("q0"))
    value = F.when(F.col("v") == 0, 0).otherwise(F.coalesce("part", F.lit(0)) + rest)
    return every.select("lang", "source", "item", value.alias("value"))


def audit(docs: DataFrame, support: int = SUPPORT, listed: int = LISTED, sources: int = SOURCES, terms_: int = TERMS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: how each source of a language differs from the others.

    Part ``pair`` has every other source of the language, part ``term`` the first ``listed`` terms that the source has
    more of than the language as a whole; both by falling value, ties by the item's UTF-8. Terms are runs of
    letters, kept if at least ``support`` documents of the language have them; repeated rows are documents each.
    Null text, lang and source count as empty; a group without a term still has its pairs, a language without kept
    terms only pairs of value 0, a language of one source no pairs. Ids are not read, nor are other columns. An
    empty table gives no rows. Only two counts come to the driver, the most terms and the most sources of a
    language. Texts of any length are counted whole.
    """
    summed = stored(counts(docs))
    kept = stored(summed.groupBy("lang", "term").agg(F.sum("count").alias("in_lang"), F.sum("docs").alias("docs"))
                  .where(F.col("docs") >= support).drop("docs"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("lang_total"))
    own = stored(summed.drop("docs").join(kept, ["lang", "term"]))
    totals = own.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = docs.select(_blank("lang"), _blank("source")).distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("v", "lang_total", "total")])
    groups = stored(groups.withColumn("p0", _share(F.lit(0), F.col("total"), F.col("v"))))
    entries = own.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _share(F.col("count"), F.col("total"), F.col("v")).alias("p"),
        _share(F.col("in_lang"), F.col("lang_total"), F.col("v")).alias("q"))
    most = groups.groupBy("lang").agg(F.max("v").alias("v"), F.count("*").alias("n")).agg(F.max("v"), F.max("n")).first()
    pairs = _pairs(entries, groups, most[0] or 0, sources, terms_, most[1] or 0)
    named = entries.where("p > q").select("lang", "source", F.col("term").alias("item"), _value(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = [pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")),
              named.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
              .where(F.col("rank") <= listed)]
    return ranked[0].unionByName(ranked[1])


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The same result as DuckDB SQL over ``documents``.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT row, lang, source, term, count(*) AS n FROM (SELECT row, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS lang_n FROM c GROUP BY ALL HAVING count(*) >= {SUPPORT}),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
own AS (SELECT lang, source, term, sum(n) AS n FROM c JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
sized AS (SELECT g.lang, g.source, coalesce(v, 0)::HUGEINT AS v, coalesce(langs.total, 0)::HUGEINT AS lang_total,
          coalesce((SELECT sum(n) FROM own WHERE own.lang = g.lang AND own.source = g.source), 0)::HUGEINT AS total
          FROM g LEFT JOIN langs USING (lang)),
every AS (SELECT s.lang, s.source, kept.term, coalesce(n, 0) AS n, 1 + {WHOLE}::HUGEINT * (coalesce(n, 0) + 1) // (s.total + s.v) AS p,
          1 + {WHOLE}::HUGEINT * (lang_n + 1) // (s.lang_total + s.v) AS q
          FROM sized s JOIN kept USING (lang) LEFT JOIN own ON own.lang = s.lang AND own.source = s.source AND own.term = kept.term),
met AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM every a JOIN every b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN met ON met.lang = a.lang AND met.source = a.source AND met.item = b.source),
named AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM every WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM named)) WHERE part = 'pair' OR rank <= {LISTED}"""
