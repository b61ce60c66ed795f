"""Language identification by a convolutional network over bytes: filters of several widths, max pooling, softmax."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwise.llm.common import carried, map_texts, with_row

LENGTH = 256  # bytes of a window
EMBED, FILTERS, WIDTHS = 8, 16, (2, 3, 4)
PAD = 256
EXAMPLES, SPARE = 1_500, 4  # the bound of the sample: windows of each language, one a document at most
STEPS, BATCH, RATE, SEED = 600, 64, 0.01, 3  # as many steps however few the examples are
DECODE = 512  # windows scored at once
UNKNOWN = "und"
TOP = (1 << 63) - 1


def held_out(doc_id: Column) -> Column:
    """Is the document kept from learning? Null ids are neither held out nor learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Network:
    """``v`` byte vectors, ``w2`` ``w3`` ``w4`` filters with biases, ``o`` output with bias; classes by position."""

    def __init__(self, langs: list[str], weights: dict[str, np.ndarray]):
        self.langs, self.w = langs, weights

    @classmethod
    def start(cls, langs: list[str], seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)

        def drawn(*shape: int, scale: float = 1.0) -> np.ndarray:
            return (rng.standard_normal(shape) * scale / np.sqrt(shape[0])).astype(np.float32)

        w = {"v": drawn(PAD + 1, EMBED, scale=8), "o": drawn(FILTERS * len(WIDTHS), len(langs)), "ob": np.zeros(len(langs), np.float32)}
        for width in WIDTHS:
            w[f"w{width}"], w[f"b{width}"] = drawn(width * EMBED, FILTERS), np.zeros(FILTERS, np.float32)
        return cls(langs, w)

    def pooled(self, x: np.ndarray, keep: bool = False):
        """The largest response of each filter in each window, and where it is if the gradient asks."""
        vectors = self.w["v"][x].reshape(len(x), -1)
        out, places = [], []
        for width in WIDTHS:
            count = x.shape[1] - width + 1
            patch = np.lib.stride_tricks.as_strided(
                vectors, (len(x), count, width * EMBED), (vectors.strides[0], EMBED * 4, 4), writeable=False
            )
            response = (patch.reshape(-1, width * EMBED) @ self.w[f"w{width}"]).reshape(len(x), count, FILTERS)
            if keep:
                places.append(response.argmax(1))
            out.append(response.max(1) + self.w[f"b{width}"])
        return np.maximum(np.concatenate(out, 1), 0), places

    def log_shares(self, x: np.ndarray) -> np.ndarray:
        score = self.pooled(x)[0] @ self.w["o"] + self.w["ob"]
        score -= score.max(1, keepdims=True)
        return score - np.log(np.exp(score).sum(1, keepdims=True))

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        hidden, places = self.pooled(x, True)
        score = hidden @ w["o"] + w["ob"]
        share = np.exp(score - score.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        share[np.arange(len(y)), y] -= 1
        share /= len(y)
        grad = {"o": hidden.T @ share, "ob": share.sum(0), "v": np.zeros_like(w["v"])}
        back = (share @ w["o"].T) * (hidden > 0)
        for index, width in enumerate(WIDTHS):
            own = back[:, index * FILTERS:(index + 1) * FILTERS]
            at = places[index][:, :, None] + np.arange(width)
            codes = x[np.arange(len(x))[:, None, None], at]
            patch = w["v"][codes].reshape(len(x), FILTERS, width * EMBED)
            grad[f"w{width}"] = np.einsum("nf,nfk->kf", own, patch)
            grad[f"b{width}"] = own.sum(0)
            to_vectors = own[:, :, None] * w[f"w{width}"].T[None]
            np.add.at(grad["v"], codes.reshape(-1), to_vectors.reshape(-1, EMBED))
        return grad

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}
        order = np.zeros(0, np.int64)
        for step in range(1, STEPS + 1):
            while len(order) < BATCH:
                order = np.concatenate([order, rng.permutation(len(x))])
            rows, order = order[:BATCH], order[BATCH:]
            rate = RATE * (1 - (step - 1) / STEPS)
            for k, g in self.gradient(x[rows], y[rows]).items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                self.w[k] -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return self


def windows(text: bytes) -> np.ndarray:
    """The whole text as windows of LENGTH byte codes, the last one padded."""
    count = max(1, -(-len(text) // LENGTH))
    x = np.full(count * LENGTH, PAD, np.int16)
    x[:len(text)] = np.frombuffer(text, np.uint8)
    return x.reshape(count, LENGTH)


def sample(docs: DataFrame, examples: int = EXAMPLES) -> list[tuple[str, bytes]]:
    """(lang, window) of up to ``examples`` learnable documents of each language, those of the lowest hash of id and text.

    A window starts at a place that the hash picks. At most ``examples`` short windows a language reach the driver;
    a first count, which reads no text, sets a hash bound that about SPARE times as many pass, so that the ranking
    task gets few rows however many documents there are.
    """
    learnable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    bound = F.lit(TOP)
    for lang, count in learnable.groupBy("lang").count().collect():
        bound = F.when(F.col("lang") == lang, F.lit(min(TOP, TOP * SPARE * examples // count))).otherwise(bound)
    rows = learnable.where(F.col("text").rlike(r"\p{L}"))
    place = F.xxhash64("doc_id", "text")
    start = F.pmod(place, F.greatest(F.length("text") - LENGTH, F.lit(1)).cast("long")).cast("int") + 1
    rows = rows.select("lang", place.alias("place"), F.substring("text", start, F.lit(LENGTH)).alias("part"))
    rows = rows.where(F.shiftrightunsigned("place", 1) < bound)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place", "part"))
    taken = rows.withColumn("first", first).where(F.col("first") <= examples).select("lang", "place", "part").collect()
    return [(r.lang, r.part.encode()[:LENGTH]) for r in sorted(taken, key=lambda r: (r.lang, r.place, r.part))]


def train(examples: list[tuple[str, bytes]]) -> Network:
    langs = sorted({lang for lang, _ in examples})
    network = Network.start(langs)
    if len(langs) > 1:
        x = np.concatenate([windows(text)[:1] for _, text in examples])
        network.fit(x, np.array([langs.index(lang) for lang, _ in examples]))
    return network


def _kernel(langs: list[str], weights: dict[str, np.ndarray]):
    network = Network(langs, weights)

    def step(batch: pa.RecordBatch) -> dict:
        texts = [t if t and letters and langs else None for t, letters in zip(batch.column("text").to_pylist(), batch.column("row").field("letters").to_pylist())]
        found, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if t]
        if rows:
            cut = [windows(texts[i]) for i in rows]
            x = np.concatenate(cut)
            logs = np.concatenate([network.log_shares(x[b:b + DECODE]) for b in range(0, len(x), DECODE)])
            weight = (x != PAD).sum(1, dtype=np.float32)[:, None]
            starts = np.cumsum([0, *map(len, cut)])[:-1]
            mean = np.add.reduceat(logs * weight, starts, axis=0) / np.add.reduceat(weight, starts, axis=0)
            share = np.add.reduceat(np.exp(logs) * weight, starts, axis=0) / np.add.reduceat(weight, starts, axis=0)
            for i, best, own in zip(rows, mean.argmax(1), share):
                found[i], score[i] = langs[best], min(1.0, float(own[best]))
        return {"row": batch.column("row"), "lang_pred": pa.array(found, pa.string()), "score": score}

    return step


def predict(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, one row per row of ``docs``.

    A text is cut into windows, and the language with the highest mean log share, by bytes, is taken; its mean share
    is the score. A null text, or one without a letter, is ``und`` with score 0, as are all if nothing was learned.
    Null ids are not held out. Repeated rows each give a row, empty tables none; other columns are not read.
    """
    marked = docs.select("doc_id", F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)).alias("letters"), "text")
    held = carried(marked, ["doc_id", "letters"])
    made = map_texts(held, with_row(held, "lang_pred string, score double"), _kernel, network.langs, network.w)
    return made.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """:func:`predict` with a network learned from the documents themselves, those not held out."""
    return predict(docs, train(sample(docs, examples)))
