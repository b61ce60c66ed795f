"""Quality rules: fixed text rules, and cutoffs whose share of false rejections is bounded on labelled documents."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartwise.llm.common import carried, map_texts, stored, with_row

SPACE = b" \t\n\x0b\f\r"
CONTINUED = bytes(range(0x80, 0xC0))  # every byte of a UTF-8 letter but its first
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = UPPER + UPPER.lower()

RISK = 0.01  # of a stratum's good documents, so many at most may be rejected by all rules together
DOUBT = 0.05  # the chance that the bound fails anywhere
STEPS = 100  # values told apart per rule, evenly; and cutoffs tried of the score
TUNING = 3  # of so many labelled documents one scales the rules; the others certify
POOL = "*"  # the stratum of all that have too few good labels to certify one of their own
# Each rule is a share from 0 to 1; a document above the cutoff is rejected.
RULES = ("symbol_share", "upper_share", "shout_share", "repeat_share", "dup_line_share")

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MORE = "n_lines long, n_upper long, n_letters long, n_shouts long"


def measure(text: bytes | None) -> tuple[int, ...]:
    """The counts of BASE and MORE for one text; null counts as empty."""
    if not text:
        return (0,) * 9
    words = text.split()
    size = len(text)
    chars = len(text.translate(None, CONTINUED + SPACE))
    symbols = size - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    upper = size - len(text.translate(None, UPPER))
    letters = size - len(text.translate(None, LETTERS))
    return (len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines), upper, letters,
            text.count(b"!"))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words that stands twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    twice = np.fromiter((count[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + len(twice)] |= twice
    return int(covered.sum())


def _kernel():
    names = _names(f"{BASE}, {MORE}")

    def step(batch: pa.RecordBatch) -> dict:
        counts = np.array([measure(t) for t in batch.column("text").to_pylist()], np.int64).reshape(-1, len(names))
        return {"row": batch.column("row"), **{name: counts[:, i].copy() for i, name in enumerate(names)}}

    return step


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """A struct ``row`` of the columns ``keep`` with the counts of each text."""
    held = carried(docs, keep)
    return map_texts(held, with_row(held, f"{BASE}, {MORE}"), _kernel)


def shares() -> dict[str, Column]:
    """Each rule's share as an expression over the counts; nothing to divide by gives 0."""
    def part(a: str, b: str) -> Column:
        return F.coalesce(F.least(F.lit(1.0), F.col(a) / F.nullif(F.col(b), F.lit(0))), F.lit(0.0))

    return dict(zip(RULES, (part("n_symbols", "n_words"), part("n_upper", "n_letters"), part("n_shouts", "n_words"),
                            part("n_repeat_words", "n_words"), part("n_dup_lines", "n_lines"))))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def certified(rejected: int, good: int, risk: float, doubt: float) -> bool:
    """Is the exact upper bound of a rejection rate, seen ``rejected`` times in ``good``, at most ``risk``?

    True if so few or fewer are seen with chance ``doubt`` at most, were the rate ``risk`` (Clopper and Pearson).
    """
    if good == 0 or rejected >= good * risk:
        return False
    k = np.arange(rejected, dtype=float)
    steps = np.log((good - k) / (k + 1)) + math.log(risk) - math.log1p(-risk)
    logs = good * math.log1p(-risk) + np.concatenate(([0.0], np.cumsum(steps)))
    top = logs.max()
    return bool(top + math.log(np.exp(logs - top).sum()) <= math.log(doubt))


def choose(good: np.ndarray, bad: np.ndarray, risk: float, doubt: float) -> int | None:
    """The step whose cutoff is used, or None. ``good[i]``, ``bad[i]``: documents whose share falls in step i.

    Steps are tested from the highest cutoff down and testing stops at the first that is not certified, so all of
    them together need no correction. Of the certified ones the one that rejects most bad documents less good ones
    is taken, of equals the highest cutoff.
    """
    above_good, above_bad = np.cumsum(good[::-1])[::-1], np.cumsum(bad[::-1])[::-1]
    best, chosen = 0, None
    for step in range(len(good) - 2, -1, -1):
        lost, caught = int(above_good[step + 1]), int(above_bad[step + 1])
        if not certified(lost, int(above_good[0]), risk, doubt):
            break
        if caught - lost > best:
            best, chosen = caught - lost, step
    return chosen


def _steps() -> Column:
    """``at``: the step, 0 to STEPS, of each rule's share, in the order of RULES."""
    return F.array(*[F.ceil(share * STEPS).cast("int") for share in shares().values()]).alias("at")


def _labelled(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """``stratum``, ``at``, ``good``, ``tuning`` of labelled documents that pass the base rules.

    A document with several labels is bad if any says so; null labels and ids say nothing. Which part a document is
    in follows from its id.
    """
    said = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return counts.where(~base_failed()).join(said, "doc_id").select(
        "stratum", _steps(), (F.col("quality") > 0).cast("long").alias("good"),
        (F.pmod(F.xxhash64("doc_id"), F.lit(TUNING)) == 0).alias("tuning"))


def extremes(good: np.ndarray) -> np.ndarray:
    """A value for each rule and step, lower the more extreme; ``good`` counts good documents by rule and step.

    It is the number of good documents with that step or a higher one, STEPS at most; where there are none, less the steps
    that lie between it and the highest good one.
    """
    tails = np.cumsum(good[:, ::-1], axis=1)[:, ::-1]
    highest = good.shape[1] - 1 - (good[:, ::-1] > 0).argmax(axis=1)
    return np.where(tails > 0, np.minimum(tails, STEPS), np.where(good.any(axis=1), highest, -1)[:, None] - np.arange(good.shape[1]))


def _rank(table: Column) -> Column:
    """The score of a document: the least value over all rules, from -STEPS to STEPS.

    0 and less say that some rule puts it beyond every good document of the tuning part. Rejecting scores up to k is one
    cutoff for each rule at once, stricter with k, so that one certificate speaks for all rules together.
    """
    return F.least(*[F.element_at(table[i], F.col("at")[i] + 1) for i in range(len(RULES))])


@dataclass
class Cutoffs:
    """What the labels certify: for each stratum how extreme its good documents are, and the score up to which it rejects.

    ``strata`` are those certified on their own; all others are one, POOL.
    """

    strata: list[str]
    tails: dict[str, np.ndarray]
    rejects: dict[str, int]

    def of(self) -> Column:
        """The stratum a document is judged in."""
        return F.when(F.col("stratum").isin(self.strata), F.col("stratum")).otherwise(POOL) if self.strata else F.lit(POOL)

    def score(self) -> Column:
        made = F.lit(STEPS)
        for name, table in sorted(self.tails.items()):
            own = F.array(*[F.array(*map(F.lit, row)) for row in table.tolist()])
            made = F.when(self.of() == name, _rank(own)).otherwise(made)
        return made

    def cutoff(self) -> Column:
        """The certified score up to which the document's stratum rejects; null where nothing is certified."""
        made = F.lit(None).cast("int")
        for name, level in sorted(self.rejects.items()):
            made = F.when(self.of() == name, level).otherwise(made)
        return made

    def kept(self) -> Column:
        return ~base_failed() & F.coalesce(F.col("score") > F.col("cutoff"), F.lit(True))


def enough(risk: float, doubt: float) -> int:
    """So many good documents certify a cutoff that rejects none of them."""
    return math.ceil(math.log(doubt) / math.log1p(-risk))


def cutoffs(counts: DataFrame, labels: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> Cutoffs:
    """Cutoffs whose share of rejected good documents is at most ``risk`` in every stratum, but for the chance ``doubt``.

    One part of the labelled documents scales the rules, so that they have one score; the other certifies cutoffs of that
    score, from the mildest on. ``doubt`` is shared among the strata (Bonferroni), ``risk`` is not shared among the
    rules, as they are certified together. Strata with too few good documents in the second part, which is
    known before anything is seen of their scores, are pooled and certified as one. Only histograms come to the
    driver: strata x rules x steps, and strata x scores, however many documents are labelled.
    """
    known = stored(_labelled(counts, labels))
    sizes = {r.stratum: r.n for r in known.where("not tuning").groupBy("stratum").agg(F.sum("good").alias("n")).collect()}
    strata = sorted(sizes)
    while strata:  # as strata are pooled, the others' share of the doubt grows
        least = enough(risk, doubt / (len(strata) + 1))
        small = [x for x in strata if sizes[x] < least]
        if not small:
            break
        strata = [x for x in strata if x not in small]
    made = Cutoffs(strata, {}, {})
    rows = known.select(made.of().alias("own"), "at", "good", "tuning")
    each = F.posexplode("at").alias("rule", "step")
    cells = rows.where("tuning and good = 1").select("own", each).groupBy("own", "rule", "step").count().collect()
    for row in cells:
        made.tails.setdefault(row.own, np.zeros((len(RULES), STEPS + 1), np.int64))[row.rule, row.step] += row["count"]
    made.tails = {name: extremes(good) for name, good in made.tails.items()}
    scored = known.where("not tuning").withColumn("score", made.score()).groupBy(made.of().alias("own"), "score").agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")).collect()
    found: dict[str, np.ndarray] = {}
    for row in scored:
        found.setdefault(row.own, np.zeros((2, 2 * STEPS + 2), np.int64))[:, STEPS - row.score] += (row.good, row.bad)
    for name, (good, bad) in found.items():
        step = choose(good, bad, risk, doubt / len(found))
        if step is not None:
            made.rejects[name] = STEPS - step - 1
    return made


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


def _stratum() -> Column:
    return F.coalesce(F.col("row.lang"), F.lit("")).alias("stratum")


def _judged(counts: DataFrame, labels: DataFrame, risk: float, doubt: float) -> DataFrame:
    """``counts`` with ``base_failed``, ``score``, ``cutoff`` and ``kept``."""
    found = cutoffs(counts, labels, risk, doubt)
    return counts.withColumn("at", _steps()).withColumns({"score": found.score(), "cutoff": found.cutoff()}).withColumns(
        {"base_failed": base_failed(), "kept": found.kept(), "stratum": found.of()})


def quality(docs: DataFrame, labels: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """``doc_id``, the BASE counts, ``base_failed``, ``kept``, ``stratum``, ``score``, ``cutoff``, one row per row of ``docs``.

    A document that passes the base rules is rejected if its score is at most the cutoff of its stratum; a null cutoff
    rejects nothing. Null, empty and blank texts count 0 of everything and fail the base rules. A null lang is a
    stratum of its own; strata with too few labels are judged together as POOL, and by the base rules alone
    if those are too few as well. Null ids have no label. Repeated rows each count and each get a row; empty tables
    give no rows, or no cutoffs. Texts of any length are measured whole. Other columns are not read.
    """
    counts = stored(measured(docs, ["doc_id", "lang"]).select("row.doc_id", _stratum(), *_names(f"{BASE}, {MORE}")))
    return _judged(counts, labels, risk, doubt).select(
        "doc_id", *_names(BASE), "base_failed", "kept", "stratum", F.col("score").cast("int").alias("score"), "cutoff")


def keep(docs: DataFrame, labels: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """The rows of ``docs`` that :func:`quality` keeps, with their columns; cases as there.

    Texts are measured once: the rows are written with their counts, and judged from there.
    """
    held = measured(docs, docs.columns).withColumn("stratum", _stratum()).withColumn("doc_id", F.col("row.doc_id"))
    held = stored(held)
    return _judged(held, labels, risk, doubt).where("kept").select("row.*")
