"""The certified cutoffs of the quality rules against plain Python, and on labels they were not certified on."""

import collections
import math

import numpy as np
from pyspark.sql import functions as F

from cartwise.llm import rules
from cartwise.llm.common import table

LARGE = "/root/testdata/sf0.1"


def plain_steps(text):
    n_words, _, symbols, dup_lines, repeated, lines, upper, letters, shouts = rules.measure(text.encode() if text else None)
    pairs = ((symbols, n_words), (upper, letters), (shouts, n_words), (repeated, n_words), (dup_lines, lines))
    return [math.ceil(min(1.0, a / b) * rules.STEPS) if b else 0 for a, b in pairs], n_words < 50 or 100 * repeated > 50 * n_words


def plain_value(good, step):
    """Of one rule: good documents as extreme, or the steps beyond the highest."""
    as_extreme = sum(g >= step for g in good)
    return min(as_extreme, rules.STEPS) if as_extreme else max(good, default=-1) - step


def plain_cutoff(scored, risk, doubt):
    """The score up to which to reject, tried from the mildest: certified by the binomial tail, best by bad less good."""
    good = sum(q for _, q in scored)
    best, chosen = 0, None
    for level in range(-rules.STEPS - 1, rules.STEPS):
        lost = sum(q for s, q in scored if s <= level)
        caught = sum(not q for s, q in scored if s <= level)
        tail = sum(math.comb(good, k) * risk ** k * (1 - risk) ** (good - k) for k in range(lost + 1))
        if lost >= good * risk or tail > doubt:
            break
        if caught - lost > best:
            best, chosen = caught - lost, level
    return chosen


def test_verdicts_against_plain_python(spark):
    docs, labels = table(spark, LARGE, "documents"), table(spark, LARGE, "labels")
    rows = docs.select("doc_id", "text", "lang", (F.pmod(F.xxhash64("doc_id"), F.lit(rules.TUNING)) == 0).alias("tuning")).collect()
    said = {}
    for r in labels.collect():
        if r.doc_id is not None and r.quality is not None:
            said[r.doc_id] = min(said.get(r.doc_id, 1), r.quality)
    steps = {r.doc_id: plain_steps(r.text) for r in rows}
    known = [(r, steps[r.doc_id][0], said[r.doc_id] > 0) for r in rows if r.doc_id in said and not steps[r.doc_id][1]]
    sizes = collections.Counter(r.lang or "" for r, _, good in known if good and not r.tuning)
    strata = sorted({r.lang or "" for r, _, _ in known if not r.tuning})
    while True:
        small = [x for x in strata if sizes[x] < rules.enough(rules.RISK, rules.DOUBT / (len(strata) + 1))]
        strata = [x for x in strata if x not in small]
        if not small or not strata:
            break
    own = lambda lang: (lang or "") if (lang or "") in strata else rules.POOL
    tuning, held = {}, collections.defaultdict(list)
    for r, at, good in known:
        if r.tuning and good:
            for rule, step in enumerate(at):
                tuning.setdefault(own(r.lang), [[] for _ in at])[rule].append(step)
    value = {name: [[plain_value(good, s) for s in range(rules.STEPS + 1)] for good in each] for name, each in tuning.items()}
    score = lambda name, at: min(value[name][rule][s] for rule, s in enumerate(at)) if name in value else rules.STEPS
    for r, at, good in known:
        if not r.tuning:
            held[own(r.lang)].append((score(own(r.lang), at), good))
    cutoff = {name: plain_cutoff(scored, rules.RISK, rules.DOUBT / len(held)) for name, scored in held.items()}
    made = {r.doc_id: r for r in rules.quality(docs, labels).collect()}
    assert any(c is not None for c in cutoff.values())  # something is certified at the production risk
    for r in rows:
        at, failed = steps[r.doc_id]
        name = own(r.lang)
        want = not failed and not (cutoff.get(name) is not None and score(name, at) <= cutoff[name])
        m = made[r.doc_id]
        assert (m.stratum, m.cutoff, m.score, m.base_failed, m.kept) == (name, cutoff.get(name), score(name, at), failed, want)
    assert sum(not m.kept and not m.base_failed for m in made.values()) > 100


def test_fresh_good_documents_are_kept(spark):
    """Certified on one half of the labels, counted on the other."""
    docs, labels = table(spark, LARGE, "documents"), table(spark, LARGE, "labels")
    judged = rules.quality(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed")
    rows = judged.select("stratum", "quality", "kept", "cutoff").collect()
    assert any(r.cutoff is not None for r in rows)
    for name in {r.stratum for r in rows}:
        good = [r.kept for r in rows if r.quality and r.stratum == name]
        assert sum(not k for k in good) <= max(3, 2 * rules.RISK * len(good))
    bad = [r.kept for r in rows if not r.quality and r.cutoff is not None]
    assert bad and sum(bad) < 0.1 * len(bad)


def test_so_many_good_documents_are_enough():
    for risk, doubt in ((0.01, 0.05), (0.2, 0.01), (0.05, 0.0125)):
        n = rules.enough(risk, doubt)
        assert rules.certified(0, n, risk, doubt) and not rules.certified(0, n - 1, risk, doubt)


def test_values_of_rules():
    good = np.zeros((2, rules.STEPS + 1), int)
    good[0, [0, 3, 7]] = 5, 2, 1
    value = rules.extremes(good)
    assert value[0, :9].tolist() == [8, 3, 3, 3, 1, 1, 1, 1, -1] and value[0, 100] == -93
    assert value[1, 0] == -1 and value[1, 100] == -101
