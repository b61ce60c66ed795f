"""The tagger: its paths and its gradient by enumeration, and what it finds in pieces it was not trained on."""

import itertools
import random

import numpy as np
import pytest
from cartwise.llm import pii
from cartwise.llm.common import table


def small_weights(seed):
    rng = np.random.default_rng(seed)
    w = {"v": rng.normal(size=(pii.CODES, pii.EMBED)), "e": rng.normal(size=(2 * pii.HIDDEN, pii.TAGS)), "eb": rng.normal(size=pii.TAGS),
         "t": rng.normal(size=(pii.TAGS, pii.TAGS))}
    for way in "fb":
        w |= {"x" + way: rng.normal(size=(pii.EMBED, 4 * pii.HIDDEN)) / 3, "h" + way: rng.normal(size=(pii.HIDDEN, 4 * pii.HIDDEN)) / 4,
              "b" + way: rng.normal(size=4 * pii.HIDDEN) / 3}
    return w


def path_scores(w, x):
    """The score of every tag path of one row."""
    emitted = pii.Tagger(w).emissions(x[None])[0]
    paths = np.array(list(itertools.product(range(pii.TAGS), repeat=len(x))))
    score = emitted[np.arange(len(x)), paths].sum(1)
    return paths, score + w["t"][paths[:, :-1], paths[:, 1:]].sum(1)


def mean_loss(w, x, y):
    total = 0.0
    for row, tags in zip(x, y):
        paths, score = path_scores(w, row)
        top = score.max()
        total += top + np.log(np.exp(score - top).sum()) - score[(paths == tags).all(1)][0]
    return total / len(x)


def test_best_paths_by_enumeration():
    rng, w = np.random.default_rng(1), small_weights(1)
    x = rng.integers(0, pii.CODES, (12, 4))
    for row, path in zip(x, pii.Tagger(w).tags(x)):
        paths, score = path_scores(w, row)
        assert paths[score.argmax()].tolist() == path.tolist()


def test_gradient_by_differences():
    rng, w = np.random.default_rng(2), small_weights(2)
    x, y = rng.integers(0, pii.CODES, (2, 3)), rng.integers(0, pii.TAGS, (2, 3))
    made = pii._gradient(w, x, y)
    for name, value in w.items():
        places = [np.unravel_index(i, value.shape) for i in rng.choice(value.size, 6, replace=False)]
        if name == "v":
            places = [(c, 3) for c in x[0]] + [(y[0, 0], 1)]
        for place in places:
            kept, step = value[place], 1e-5
            value[place] = kept + step
            above = mean_loss(w, x, y)
            value[place] = kept - step
            below = mean_loss(w, x, y)
            value[place] = kept
            assert made[name][place] == pytest.approx((above - below) / (2 * step), abs=1e-6)


def test_forms_hold_their_spans():
    rng = random.Random(3)
    text = "Write to anna.k@mail.example.com or +49 170 1234567, host 10.2.3.4, card 4111 1111 1111 1111 now."
    spans = pii._shown_spans(text)
    assert [k for k, _, _ in spans] == [0, 3, 1, 2]
    for _ in range(300):
        out, made = pii.varied(text, spans, rng)
        assert len(out) <= pii.TRAIN_LENGTH
        for kind, begin, end in made:
            assert pii._trimmed(out, (kind, begin, end)) == (kind, begin, end) and 0 <= begin < end <= len(out)


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_held_out_spans_are_found(spark, size):
    tagger = pii.fit(table(spark, f"/root/testdata/{size}", "documents"))
    assert tagger.report.keys() == set(pii.KINDS)
    assert all(precision >= 0.9 and recall >= 0.9 for precision, recall in tagger.report.values()), tagger.report
    lines = {"thand on (632) 555-4827 inat the ered": (3, 9, 23), "write to jan.doe [at] mail [dot] org today": (0, 9, 31),
             "the host 10[.]0[.]3[.]77 was": (1, 9, 24), "a card 4532-1234-5678-9010 ok": (2, 7, 26)}
    assert sum(span in pii.tagged_spans(tagger, [line])[0] for line, span in lines.items()) >= 3
    plain = ["paid 1,299.00 on 2021-03-04 at 12:30:45 for #123456", "version v1.2.3 of 04.03.2021, some 120 % more"]
    assert pii.tagged_spans(tagger, plain) == [[], []]


def test_no_examples_no_tags():
    never = pii.train([])
    assert pii.tagged_spans(never, ["a@b.com 4111 1111 1111 1111", ""]) == [[], []]
    assert pii.measured(never, [])["card"] == (1.0, 1.0)
