"""Byte-pair encoding by a deterministic automaton over tokens, built merge by merge, and decoding by its arc labels."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from cartwise.llm.common import map_texts

WORD_END = "</w>"
# White space of the regular expression engine of the library; others that str.split() would cut at are no space there.
ODD_SPACE = regex.compile(r"[\x1c-\x1f]")
SPACE = regex.compile(r"\p{White_Space}+")
# Letters up to here are classed alike by every Unicode release; beyond, the library itself normalises and splits.
OLD = regex.compile(r"[^\x00-\u024f]")
PREFIX = 4
CACHE = 300_000  # words a task remembers before it starts anew; a matter of speed only


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else one from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


class Automaton:
    """Accepts just the token sequences that the merges make, one for each word.

    It starts as one state with an arc for each base symbol. For a merge (u, v) -> w the gadget gives u's arcs a
    copy of their target that has no v arc, and every state with a u arc gains a w arc to the target of v. All arcs
    of one token lead to one state, so a state is stored as its parent and the token it lost, and an arc table is
    filled as it is asked for: whether a state has the arc of a token made later is whether it has that of its left
    part; of a token made earlier, whether its parent has it.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = ""):
        self.vocab, self.end = vocab, end
        size = max(vocab.values(), default=-1) + 1
        self.labels = [""] * size
        for label, token in vocab.items():
            self.labels[token] = label
        self.born, self.left = [0] * size, [-1] * size
        self.target = [0] * size  # the state that a token's arcs lead to
        self.parent, self.lost, self.since = [-1], [-1], [0]
        for time, (a, b) in enumerate(merges, 1):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            onward = self.target[v]
            self.parent.append(self.target[u])
            self.lost.append(v)
            self.since.append(time)
            self.target[u] = len(self.parent) - 1
            self.target[w] = onward
            self.born[w], self.left[w] = time, u
        # The most letters of a token by its first ones, so that no longer slices are looked up.
        self.longest: dict[str, int] = {}
        for label in vocab:
            letters = label[:-len(end)] if end and label.endswith(end) and label != end else label
            start = letters[:PREFIX]
            self.longest[start] = max(len(letters), self.longest.get(start, 0))
        self.arcs: dict[int, bool] = {}
        self.size = size

    def has_arc(self, state: int, token: int) -> bool:
        key = state * self.size + token
        known = self.arcs.get(key)
        if known is None:
            s, t = state, token
            while True:
                if self.born[t] >= self.since[s] and self.left[t] >= 0:
                    t = self.left[t]
                elif s == 0:
                    known = True
                    break
                elif self.lost[s] == t:
                    known = False
                    break
                else:
                    s = self.parent[s]
            if len(self.arcs) > 2_000_000:
                self.arcs.clear()
            self.arcs[key] = known
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of one word, in letters of the vocabulary: the one accepted path that spells it."""
        if not word:
            return []
        lookup, target, has_arc, known, size = self.vocab.get, self.target, self.has_arc, self.arcs.get, self.size
        spelled, stop, tail = word + self.end, len(word), len(self.end)
        whole = lookup(spelled)
        if whole is not None and has_arc(0, whole):
            return [whole]
        # Depth first, longest arc first; a place and token that led nowhere is not tried twice.
        dead: set[tuple[int, int]] = set()
        path: list[int] = []
        places = [0]
        longest = self.longest.get
        reach = min(stop, longest(word[:PREFIX], PREFIX))
        while True:
            place = places[-1]
            state = target[path[-1]] if path else 0
            found = -1
            while reach > place:
                token = lookup(spelled[place:reach] if reach < stop else spelled[place:stop + tail])
                if token is not None:
                    leads = known(state * size + token)
                    if leads is None:
                        leads = has_arc(state, token)
                    if leads and (not dead or (reach, token) not in dead):
                        found = token
                        break
                reach -= 1
            if found >= 0:
                path.append(found)
                places.append(reach)
                if reach == stop:
                    return path
                reach = min(stop, reach + longest(word[reach:reach + PREFIX], PREFIX))
            elif path:
                dead.add((places.pop(), path.pop()))
                reach = min(stop, places[-1] + longest(word[places[-1]:places[-1] + PREFIX], PREFIX))
            else:
                raise ValueError(f"a letter of {word!r} is not in the vocabulary")


class WordCodec:
    """A word-level BPE file of the tokenizers library: its normaliser, its split, and the automaton of its merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.automaton = Automaton(
            model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]],
            model["end_of_word_suffix"] or "",
        )
        size = max(t["id"] for t in spec["added_tokens"]) + 1 if spec["added_tokens"] else 0
        self.labels = self.automaton.labels + [""] * max(0, size - len(self.automaton.labels))
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, token in self.added.items():
            self.labels[token] = content
        special = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        own = Tokenizer.from_file(path)
        self.normalize, self.split = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        self.letters = byte_letters()
        self.cache: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.width = 2 if len(self.labels) <= 1 << 16 else 4
        self.dtype = f"<u{self.width}"

    def _miss(self, word: str) -> bytes:
        if OLD.search(word):
            parts = [part for part, _ in self.split(word)]
        else:
            parts = ["".join([self.letters[b] for b in part.encode()]) for part in self.pattern.findall(word)]
        known, width = self.parts, self.width
        made = b""
        for part in parts:
            ids = known.get(part)
            if ids is None:
                ids = b"".join([token.to_bytes(width, "little") for token in self.automaton.encode(part)])
                if len(known) >= CACHE:
                    known.clear()
                known[part] = ids
            made += ids
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[word] = made
        return made

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            text = text.lower()
        elif OLD.search(text):
            text = self.normalize(text)
        else:
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.lower()
        words = SPACE.split(text) if ODD_SPACE.search(text) else text.split()
        get, miss = self.cache.get, self._miss
        return b"".join([get(w) or miss(w) for w in words])

    def encode(self, text: str) -> np.ndarray:
        if self.special is None or "<|" not in text:
            return np.frombuffer(self._plain(text), self.dtype)
        made, done = [], 0
        for hit in self.special.finditer(text):
            made += [self._plain(text[done:hit.start()]), np.array([self.added[hit[0]]], self.dtype).tobytes()]
            done = hit.end()
        made.append(self._plain(text[done:]))
        return np.frombuffer(b"".join(made), self.dtype)

    def decode(self, ids: np.ndarray) -> str:
        """Arc labels one after another; the file names no decoder, so a space stands between them."""
        return " ".join(map(self.labels.__getitem__, ids.tolist()))


@lru_cache(maxsize=1)
def codec(path: str) -> WordCodec:
    return WordCodec(path)


def _local(path: str) -> str:
    """The file itself, or the copy that ``SparkContext.addFile`` brought to this executor."""
    return SparkFiles.get(path.removeprefix("files:")) if path.startswith("files:") else path


def _kernel(path: str):
    coder = codec(_local(path))

    def step(batch: pa.RecordBatch) -> dict:
        count, ids_sha, text_sha = [], [], []
        for text in batch.column("text").to_pylist():
            ids = coder.encode(text or "")
            count.append(len(ids))
            ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            text_sha.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
        return {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(count, pa.int64()),
                "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}

    return step


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of each row's text, encoded and decoded again.

    Null text is taken as empty: no ids, and the digests of nothing. A null doc_id stays null, repeated rows each
    give a row, an empty table gives none, other columns are not read. Texts of any length are encoded whole, word
    by word. ``path`` is a file every executor has, or ``files:NAME`` for one sent with ``SparkContext.addFile``.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs.select("doc_id", "text"), schema, _kernel, path)


def _ids_kernel(path: str, back: bool):
    coder = codec(_local(path))

    def step(batch: pa.RecordBatch) -> dict:
        if back:
            ids = [None if x is None else np.array(x, np.int64) for x in batch.column("ids").to_pylist()]
            return {"doc_id": batch.column("doc_id"), "text": pa.array([None if x is None else coder.decode(x) for x in ids], pa.string())}
        made = [coder.encode(text or "").astype(np.int32) for text in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "ids": pa.array(made, pa.list_(pa.int32()))}

    return step


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids``: the token ids of each whole text; cases as in :func:`digests`."""
    return map_texts(docs.select("doc_id", "text"), "doc_id long, ids array<int>", _ids_kernel, path, False)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``text``: the arc labels of each row's ``ids``; a null list gives null."""
    return map_texts(tokens.select("doc_id", F.col("ids").cast("array<int>").alias("ids")), "doc_id long, text string",
                     _ids_kernel, path, True, column="ids")
