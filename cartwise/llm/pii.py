"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions that adds spans of the same kinds."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwise.llm.common import carried, map_texts, stored, with_row

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns. Possessive repeats match the same spans and keep runs of digits linear.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Every kind, in whatever form the tagger learns, holds one of these, so a window without them has no span.
HINT = re.compile(r"[0-9@]|[(\[]at[)\]]")

AT = re.compile(r" ?@ ?[^ ]{2}| ?[(\[]at[)\]] ?[^ ]{2}")

WINDOW, STRIDE = 160, 96  # characters; a window rules its middle, the margins are context
MARGIN = (WINDOW - STRIDE) // 2
TRAIN_WINDOWS = 2_400  # the bound of the labelled sample the tagger is fitted on
TRAIN_LENGTH, STEPS, BATCH, RATE = 88, 450, 128, 0.015  # as many steps however few the examples are
VARIANTS = 6  # forms of a sampled piece that are shown, the piece itself besides
HELD_OUT = 5  # of so many sampled pieces one is kept to measure the tagger
EMBED, HIDDEN = 12, 20
TAGS = 1 + 2 * len(KINDS)  # outside, then first and further letter of each kind
LETTERS = "\n\t" + "".join(map(chr, range(32, 127)))
PAD, OTHER_LETTER, OTHER = len(LETTERS), len(LETTERS) + 1, len(LETTERS) + 2
CODES = len(LETTERS) + 3
DECODE = 256  # windows decoded at once, which bounds the memory of texts full of digits

Span = tuple[int, int, int]  # kind, start, end (exclusive), in code points


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then kind; those that fail their check are dropped."""
    if not HINT.search(text):
        return []
    found: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((0, start, done))
        at = text.find("@", max(at + 1, done))
    for hit in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in hit[0].split(".")):
            found.append((1, *hit.span()))
    for hit in CARD.finditer(text):
        digits = hit[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *hit.span()))
    for hit in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in hit[0]) <= 15:
            found.append((3, *hit.span()))
    return sorted(found, key=lambda s: (s[1], s[0]))


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _TABLE[np.minimum(points, len(_TABLE) - 1)]


def _table() -> np.ndarray:
    table = np.full(0x0250 + 1, OTHER, np.int16)
    for point in range(0x00AA, 0x0250):
        if chr(point).isalpha():
            table[point] = OTHER_LETTER
    for code, letter in enumerate(LETTERS):
        table[ord(letter)] = code
    return table


_TABLE = _table()


@dataclass
class Tagger:
    """Weights: letter vectors; for each direction input, recurrent and bias; emissions; tag to tag scores."""

    weights: dict[str, np.ndarray]
    report: dict[str, tuple[float, float]] | None = None  # precision and recall by kind, on pieces not trained on

    def emissions(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        out = w["eb"] + np.zeros((*x.shape, TAGS), w["eb"].dtype)
        for way, rows in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            states, _ = _run(w, way, x, False)
            out += states @ w["e"][rows]
        return out

    def tags(self, x: np.ndarray) -> np.ndarray:
        """The best tag path of each row of letter codes."""
        score = self.emissions(x)
        rows, length, _ = score.shape
        back = np.zeros((rows, length, TAGS), np.int8)
        best = score[:, 0]
        for t in range(1, length):
            paths = best[:, :, None] + self.weights["t"]
            back[:, t] = paths.argmax(1)
            best = paths.max(1) + score[:, t]
        path = np.zeros((rows, length), np.int8)
        path[:, -1] = best.argmax(1)
        for t in range(length - 1, 0, -1):
            path[:, t - 1] = back[np.arange(rows), t, path[:, t]]
        return path


def _run(w: dict, way: str, x: np.ndarray, keep: bool):
    """Hidden states of one direction, and what the gradient needs."""
    if way == "b":
        x = x[:, ::-1]
    rows, length = x.shape
    given = (w["v"] @ w["x" + way] + w["b" + way])[x]
    h = np.zeros((rows, HIDDEN), given.dtype)
    c = np.zeros_like(h)
    states = np.zeros((rows, length, HIDDEN), given.dtype)
    kept = []
    for t in range(length):
        z = given[:, t] + h @ w["h" + way]
        gates = 0.5 + 0.5 * np.tanh(0.5 * z[:, :3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        before = c
        c = f * before + i * g
        squashed = np.tanh(c)
        if keep:
            kept.append((h, before, i, f, o, g, squashed))
        h = o * squashed
        states[:, t] = h
    return (states[:, ::-1] if way == "b" else states), kept


def _gradient(w: dict, x: np.ndarray, y: np.ndarray) -> dict:
    """Gradient of the mean CRF loss of a batch."""
    rows, length = x.shape
    both = {way: _run(w, way, x, True) for way in "fb"}
    hidden = np.concatenate([both["f"][0], both["b"][0]], 2)
    score = hidden @ w["e"] + w["eb"]
    trans = w["t"]
    alpha, beta = np.zeros_like(score), np.zeros_like(score)
    alpha[:, 0] = score[:, 0]
    for t in range(1, length):
        alpha[:, t] = score[:, t] + _logsum(alpha[:, t - 1, :, None] + trans, 1)
    for t in range(length - 2, -1, -1):
        beta[:, t] = _logsum(trans + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    total = _logsum(alpha[:, -1], 1)
    d_score = np.exp(alpha + beta - total[:, None, None])
    pairs = np.exp(alpha[:, :-1, :, None] + trans + (score + beta)[:, 1:, None, :] - total[:, None, None, None])
    d_trans = pairs.sum((0, 1))
    np.subtract.at(d_trans, (y[:, :-1], y[:, 1:]), 1)
    d_score[np.arange(rows)[:, None], np.arange(length), y] -= 1
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    grad["t"] = d_trans / rows
    d_score /= rows
    flat = d_score.reshape(-1, TAGS)
    grad["e"] = hidden.reshape(-1, 2 * HIDDEN).T @ flat
    grad["eb"] = flat.sum(0)
    d_hidden = d_score @ w["e"].T
    for way, part in (("f", d_hidden[:, :, :HIDDEN]), ("b", d_hidden[:, ::-1, HIDDEN:])):
        codes_in = x if way == "f" else x[:, ::-1]
        kept = both[way][1]
        d_given = np.zeros((rows, length, 4 * HIDDEN))
        dh = np.zeros((rows, HIDDEN))
        dc = np.zeros_like(dh)
        for t in range(length - 1, -1, -1):
            h, before, i, f, o, g, squashed = kept[t]
            dh = dh + part[:, t]
            dc = dc + dh * o * (1 - squashed * squashed)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o),
                                 dc * i * (1 - g * g)], 1)
            d_given[:, t] = dz
            grad["h" + way] += h.T @ dz
            dh = dz @ w["h" + way].T
            dc = dc * f
        by_code = np.zeros((CODES, 4 * HIDDEN))
        np.add.at(by_code, codes_in.reshape(-1), d_given.reshape(-1, 4 * HIDDEN))
        grad["b" + way] = by_code.sum(0)
        grad["x" + way] = w["v"].T @ by_code
        grad["v"] += by_code @ w["x" + way].T
    return grad


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def train(examples: list[tuple[str, list[Span]]], seed: int = 7) -> Tagger:
    """Fit the tagger on texts of up to TRAIN_LENGTH letters with their spans; with none it never tags.

    In double precision, so that sums taken in another order on another machine leave the weights, which are
    rounded to single at the end, all but the same.
    """
    rng = np.random.default_rng(seed)

    def start(*shape: int) -> np.ndarray:
        return rng.standard_normal(shape) / np.sqrt(shape[0])

    w = {"v": start(CODES, EMBED) * 3, "e": start(2 * HIDDEN, TAGS), "eb": np.zeros(TAGS), "t": np.zeros((TAGS, TAGS))}
    for way in "fb":
        bias = np.zeros(4 * HIDDEN)
        bias[HIDDEN:2 * HIDDEN] = 1
        w |= {"x" + way: start(EMBED, 4 * HIDDEN), "h" + way: start(HIDDEN, 4 * HIDDEN), "b" + way: bias}
    for tag in range(TAGS):  # a further letter follows only a letter of its kind
        for further in range(2, TAGS, 2):
            if tag not in (further, further - 1):
                w["t"][tag, further] = -30
    if not examples:
        w["eb"][0] = 100
        return _rounded(w)
    x = np.full((len(examples), TRAIN_LENGTH), PAD, np.int16)
    y = np.zeros((len(examples), TRAIN_LENGTH), np.int8)
    for row, (text, spans) in enumerate(examples):
        x[row, :len(text)] = codes(text)[:TRAIN_LENGTH]
        for kind, begin, end in spans:
            y[row, begin:end] = 2 + 2 * kind
            y[row, begin] = 1 + 2 * kind
    fixed = w["t"] < -1
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    order = np.zeros(0, np.int64)
    for step in range(1, STEPS + 1):
        while len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(examples))])
        rows, order = order[:BATCH], order[BATCH:]
        grad = _gradient(w, x[rows], y[rows])
        grad["t"][fixed] = 0
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = RATE * (1 - (step - 1) / STEPS)
        for k, g in grad.items():
            g = g * min(1.0, 5.0 / max(norm, 1e-9))
            m, v = moment[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return _rounded(w)


def _rounded(w: dict[str, np.ndarray]) -> Tagger:
    return Tagger({name: value.astype(np.float32) for name, value in w.items()})


def _sample_kernel():
    def step(batch: pa.RecordBatch) -> dict | None:
        texts, marks, order = [], [], []
        for raw in batch.column("text").to_pylist():
            text = raw.decode() if raw else ""
            spans = _shown_spans(text)
            anchors = [(s[1] + s[2]) // 2 for s in spans] + [m.start() for m in HINT.finditer(text)][::97]
            for place in anchors:
                start = max(0, place - TRAIN_LENGTH // 2)
                piece = text[start:start + TRAIN_LENGTH]
                inside = [(k, max(b - start, 0), min(e - start, len(piece))) for k, b, e in spans
                          if b < start + len(piece) and e > start]
                texts.append(piece)
                marks.append(_written(inside, numbers=True))
                order.append(hashlib.sha1(piece.encode()).hexdigest())
        return {"piece": pa.array(texts, pa.string()), "spans": pa.array(marks, pa.string()), "place": pa.array(order, pa.string())}

    return step


def _shown_spans(text: str) -> list[Span]:
    """What the tagger is taught: the pattern spans, and numbers that read like a card's though their check digit is wrong."""
    base = base_spans(text)
    cards = [(2, *hit.span()) for hit in CARD.finditer(text) if 15 <= sum(c.isdigit() for c in hit[0]) <= 16]
    return _apart(sorted({*base, *cards}, key=lambda s: (s[1], s[0])))


def _apart(spans: list[Span]) -> list[Span]:
    """Of overlapping spans the first."""
    out: list[Span] = []
    for span in spans:
        if not out or span[1] >= out[-1][2]:
            out.append(span)
    return out


def _written(spans: list[Span], numbers: bool = False) -> str:
    return ",".join(f"{k if numbers else KINDS[k]}:{b}:{e}" for k, b, e in spans)


def fit(docs: DataFrame, windows: int = TRAIN_WINDOWS) -> Tagger:
    """A tagger fitted on ``windows`` pieces of text at most, those of the lowest hash, labelled by the patterns.

    Pieces are counted by the first digits of their hash, at most 4096 numbers, so that only the buckets needed are
    looked at. Of those Spark makes the cut, and the driver gets ``windows`` rows: the cut is written first, since a
    limit that is collected sends the lowest rows of every task there. One piece of HELD_OUT, by its hash, is not trained
    on: it measures the tagger, whose ``report`` has precision and recall by kind. Of the others each is shown as it
    is and in VARIANTS forms: names and digits drawn anew, written in ways that the patterns do not take as well, and with
    prices, dates and the like in between.
    """
    pieces = map_texts(docs.select(F.col("text").cast("binary").alias("text")).where(F.col("text").isNotNull()),
                       "piece string, spans string, place string", _sample_kernel)
    pieces = stored(pieces)
    most, room = "g", windows  # "g" is above every digit of a hash
    buckets = pieces.groupBy(F.substring("place", 1, 3).alias("bucket")).agg(F.count_distinct("place").alias("n")).collect()
    for bucket, count in sorted(map(tuple, buckets)):
        room -= count
        if room <= 0:
            most = bucket + "g"
            break
    # Equal pieces may be marked differently where a text was cut; the least marks are taken.
    lowest = pieces.where(F.col("place") < most).groupBy("place", "piece").agg(F.min("spans").alias("spans"))
    rows = sorted(stored(lowest.orderBy("place").limit(windows)).collect(), key=lambda r: r.place)
    shown, kept = [], []
    for row in rows:
        spans = [tuple(map(int, part.split(":"))) for part in row.spans.split(",") if part]
        rng = random.Random(int(row.place[:12], 16))
        forms = [(row.piece, spans), *(varied(row.piece, spans, rng) for _ in range(VARIANTS))]
        if int(row.place[-4:], 16) % HELD_OUT:
            shown += forms
        else:
            kept += forms[:2]
    tagger = train(shown)
    return Tagger(tagger.weights, measured(tagger, kept))


def measured(tagger: Tagger, examples: list[tuple[str, list[Span]]]) -> dict[str, tuple[float, float]]:
    """Precision and recall of the tagger's spans by kind, 1 where there is nothing to find or nothing was found."""
    right, said, there = Counter(), Counter(), Counter()
    for (_, spans), found in zip(examples, tagged_spans(tagger, [text for text, _ in examples])):
        right.update(s[0] for s in set(spans) & set(found))
        said.update(s[0] for s in found)
        there.update(s[0] for s in spans)
    return {name: (right[k] / said[k] if said[k] else 1.0, right[k] / there[k] if there[k] else 1.0) for k, name in enumerate(KINDS)}


def _redrawn(value: str, rng: random.Random) -> str:
    """The value with other digits and small letters in their places."""
    return "".join(rng.choice("0123456789") if c.isdigit() else rng.choice("abcdefghijklmnopqrstuvwxyz") if "a" <= c <= "z" else c for c in value)


def _form(kind: int, value: str, rng: random.Random) -> str:
    """Other personal data of a kind, in the form of the value or another."""
    if kind == 0:
        local, _, domain = value.partition("@")
        name, _, last = domain.rpartition(".")
        local, domain = _redrawn(local, rng), f"{_redrawn(name, rng)}.{rng.choice([last, last, 'com', 'org', 'net', 'de', 'fr', 'io'])}"
        at, dot = rng.choice([("@", "."), ("@", "."), ("@", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "."), ("(at)", "."), (" @ ", ".")])
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return rng.choice([".", ".", "[.]", " . "]).join(str(rng.randrange(256)) for _ in range(4))
    if kind == 2:
        digits = "".join(rng.choice("0123456789") for _ in range(rng.choice([16, 16, 16, 15])))
        return rng.choice(["", "", "", " ", "-", "."]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if rng.random() < 0.4:
        return _redrawn(value, rng)
    drawn = "".join(rng.choice("0123456789") for _ in range(10))
    return rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "({}) {} {}", "0{}/{}{}", "+1 {}-{}-{}", "+44 {} {} {}"]).format(
        drawn[:3], drawn[3:6], drawn[6:])


def _decoy(rng: random.Random) -> str:
    """What looks like personal data and is none: prices, dates, times, numbers of things, versions, very long numbers."""
    n = rng.randrange
    return rng.choice([
        lambda: f"${n(1, 10**4):,}.{n(100):02d}", lambda: f"{n(1, 1000)},{n(100):02d} EUR", lambda: f"{n(1990, 2030)}-{n(1, 13):02d}-{n(1, 29):02d}",
        lambda: f"{n(1, 29):02d}.{n(1, 13):02d}.{n(1990, 2030)}", lambda: f"{n(24):02d}:{n(60):02d}:{n(60):02d}", lambda: f"#{n(10**7)}",
        lambda: f"v{n(20)}.{n(20)}.{n(20)}", lambda: f"{n(10**5)}", lambda: f"{n(10**20, 10**22)}", lambda: f"{n(300, 999)}.{n(300, 999)}.{n(999)}",
        lambda: f"{n(100)} %", lambda: "@" + _redrawn("aaaaaa", rng), lambda: f"{n(10**3)}-{n(10**3)}",
    ])()


def varied(text: str, spans: list[Span], rng: random.Random) -> tuple[str, list[Span]]:
    """The text with other data in its spans, sometimes something in a space before them that is none, and cut."""
    out, made, at = "", [], 0
    for kind, begin, end in spans:
        out += text[at:begin]
        new = _form(kind, text[begin:end], rng)
        made.append((kind, len(out), len(out) + len(new)))
        out, at = out + new, end
    out += text[at:]
    gaps = [i for i, c in enumerate(out) if c == " " and not any(b <= i < e for _, b, e in made)]
    if gaps and rng.random() < 0.6:
        gap, decoy = rng.choice(gaps), " " + _decoy(rng)
        out = out[:gap] + decoy + out[gap:]
        made = [(k, b + len(decoy), e + len(decoy)) if b >= gap else (k, b, e) for k, b, e in made]
    # Data may also stand at the start of a text, or near it.
    cut = rng.randrange((made[0][1] if made else len(out) // 2) + 1) if rng.random() < 0.5 else 0
    out, made = out[cut:cut + TRAIN_LENGTH], [(k, b - cut, e - cut) for k, b, e in made]
    if made and rng.random() < 0.3:
        out = out[:rng.randrange(made[-1][2], max(len(out), made[-1][2]) + 1)]
    return out, [s for s in made if s[2] <= TRAIN_LENGTH]


def tagged_spans(tagger: Tagger, texts: list[str]) -> list[list[Span]]:
    """The tagger's spans of whole texts.

    Windows overlap; each letter takes its tag from the window in whose middle it lies, and spans are read from the
    joined tags, so a span may run over several windows. Windows without a digit or @ hold no span and are not decoded.
    """
    found: list[list[Span]] = [[] for _ in texts]
    todo: list[tuple[int, int]] = []
    for number, text in enumerate(texts):
        last = -1
        for hit in HINT.finditer(text):
            first = max(0, -(-(hit.start() - WINDOW + 1) // STRIDE))
            for index in range(max(first, last + 1), hit.start() // STRIDE + 1):
                todo.append((number, index))
                last = index
    marks: dict[int, dict[int, np.ndarray]] = {}
    for begin in range(0, len(todo), DECODE):
        part = todo[begin:begin + DECODE]
        x = np.full((len(part), WINDOW), PAD, np.int16)
        for row, (number, index) in enumerate(part):
            piece = codes(texts[number][index * STRIDE:index * STRIDE + WINDOW])
            x[row, :len(piece)] = piece
        for (number, index), tags in zip(part, tagger.tags(x)):
            if tags.any():
                marks.setdefault(number, {})[index] = tags
    for number, by_window in marks.items():
        found[number] = _joined(texts[number], by_window)
    return found


def _joined(text: str, by_window: dict[int, np.ndarray]) -> list[Span]:
    spans: list[Span] = []
    open_kind, begin, before = -1, 0, -2
    for index in sorted(by_window):
        tags = by_window[index]
        low = 0 if index == 0 else MARGIN
        for offset in np.flatnonzero(tags[low:MARGIN + STRIDE]).tolist():
            place, tag = index * STRIDE + low + offset, int(tags[low + offset])
            kind = (tag - 1) // 2
            if place >= len(text):
                break
            if kind != open_kind or tag % 2 or place != before + 1:
                if open_kind >= 0:
                    spans.append((open_kind, begin, before + 1))
                open_kind, begin = kind, place
            before = place
    if open_kind >= 0:
        spans.append((open_kind, begin, before + 1))
    return [s for s in (_trimmed(text, s) for s in spans) if s]


def _trimmed(text: str, span: Span) -> Span | None:
    """The span without blanks and stops at its ends, if it can be of its kind at all."""
    kind, begin, end = span
    while begin < end and not (text[begin].isalnum() or text[begin] in "+("):
        begin += 1
    while end > begin and not text[end - 1].isalnum():
        end -= 1
    value = text[begin:end]
    if text[max(0, begin - 1):begin].isalnum() or text[end:end + 1].isalnum():  # part of a longer word or number
        return None
    digits = sum(c.isdigit() for c in value)
    fits = (
        AT.search(value, 1) is not None if kind == 0
        else len(re.findall(r"[0-9]+", value)) == 4 and value.count(".") == 3 if kind == 1
        else 12 <= digits <= 19 and not any(c.isalpha() for c in value) if kind == 2
        else 9 <= digits <= 15 and digits < len(value) and not any(c.isalpha() for c in value)
    )
    return (kind, begin, end) if fits else None


def all_spans(tagger: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Of each text the pattern spans, and all spans: those and the tagger's that overlap none of them."""
    out = []
    for text, added in zip(texts, tagged_spans(tagger, texts)):
        base = base_spans(text)
        if added:
            taken = np.zeros(len(text) + 1, bool)
            for _, begin, end in base:
                taken[begin:end] = True
            whole = sorted(base + [s for s in added if not taken[s[1]:s[2]].any()], key=lambda s: (s[1], s[0]))
        else:
            whole = base
        out.append((base, whole))
    return out


def _find_kernel(weights: dict):
    tagger = Tagger(weights)

    def step(batch: pa.RecordBatch) -> dict:
        texts = [t.decode() if t else "" for t in batch.column("text").to_pylist()]
        both = all_spans(tagger, texts)
        count = np.array([[sum(s[0] == k for s in base) for k in range(len(KINDS))] for base, _ in both], np.int64).reshape(-1, 4)
        return {
            "row": batch.column("row"), **{f"n_{kind}": count[:, k].copy() for k, kind in enumerate(KINDS)},
            "base_sha256": pa.array([hashlib.sha256(_written(base).encode()).hexdigest() for base, _ in both], pa.string()),
            "spans": pa.array([_written(whole) for _, whole in both], pa.string()),
        }

    return step


def find(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """``doc_id``, counts of the pattern spans by kind, ``base_sha256`` of them, ``spans`` with the tagger's.

    Null text counts as empty and has no spans. Ids may be null or repeat, each row gives one row, an empty table
    none; other columns are not read. Texts of any length are read whole. Spans are ``kind:start:end`` by start,
    then kind, in code points.
    """
    held = carried(docs, ["doc_id"])
    more = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_texts(held, with_row(held, more), _find_kernel, tagger.weights).select(
        "row.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    )


def _mask_kernel(weights: dict):
    tagger = Tagger(weights)

    def step(batch: pa.RecordBatch) -> dict:
        raw = batch.column("text").to_pylist()
        texts = [t.decode() if t else "" for t in raw]
        new = [masked(text, whole) for text, (_, whole) in zip(texts, all_spans(tagger, texts))]
        return {"row": batch.column("row"), "clean": pa.array([None if r is None else n for r, n in zip(raw, new)], pa.string())}

    return step


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind in brackets."""
    parts, done, open_end = [], 0, -1
    for kind, begin, end in spans:
        if begin >= open_end:
            parts += [text[done:begin], f"[{KINDS[kind].upper()}]"]
        open_end = done = max(end, open_end)
    parts.append(text[done:])
    return "".join(parts)


def mask(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """The rows of ``docs`` with personal data in ``text`` replaced by its kind, and ``n_chars``, if there, counted anew.

    Null text stays null and empty text empty, with their ``n_chars`` as they were; a null text's count is kept. Ids and
    other columns are handed on, whatever they are called; each row gives one row, an empty table none; texts of any
    length are masked whole.
    """
    held = carried(docs, docs.columns)
    done = map_texts(held, with_row(held, "clean string"), _mask_kernel, tagger.weights)
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length("clean").cast("long"), F.col("row.n_chars"))
    return done.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
