"""Byte-level BPE by overlapping chunks: split in parallel, stitched where the splits agree, encoded piece by piece."""

from __future__ import annotations

import hashlib
from base64 import b64decode
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window, functions as F

from cartwise.llm.common import map_texts, ship, stored

CHUNK, OVERLAP = 1 << 15, 1 << 10  # characters of a chunk, and those it shares with the next
# So many characters behind a piece may decide about it: two that would make an apostrophe a contraction, and one more.
AHEAD = 3
CACHE = 200_000  # pieces in each of the two generations a task remembers; a matter of speed only
FILE = "byte_bpe_50k.tiktoken"
# Letters up to here are classed alike by every Unicode release.
OLD = regex.compile(r"[^\x00-ɏ]")
# Stand-ins for a letter, a number and another sign; the letter is in no contraction.
STAND_INS = ("ß", "0", "§")
CHUNKS = "key long, doc_id long, seq int, start long, last boolean, text string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Pieces:
    """Cuts text at the matches of a pattern, as the library that the rank file is made for does.

    Which newer characters are letters depends on the Unicode release of a regular expression engine. Where this
    process's and the library's differ, found by asking both about every character, a stand-in of the
    library's class is matched in the character's place.
    """

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        self.odd: dict[int, str] | None = None

    def differing(self) -> dict[int, str]:
        if self.odd is None:
            every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
            single = {bytes([b]): b for b in range(256)}
            self.odd, known = {}, set()
            for name, stand_in in zip((r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"), STAND_INS):
                own = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
                theirs = set(bytes(own.encode_ordinary(every)).decode())
                self.odd.update((ord(c), stand_in) for c in theirs.difference(regex.findall(name, every)))
        return self.odd

    def cut(self, text: str) -> list[str]:
        seen = text
        if OLD.search(text) and not self.differing().keys().isdisjoint(map(ord, set(text))):
            seen = text.translate(self.differing())
        made = self.pattern.findall(seen)
        if seen is not text:
            ends = np.cumsum([0, *map(len, made)]).tolist()
            made = [text[a:b] for a, b in zip(ends, ends[1:])]
        return made


class Coder:
    """A rank file: pieces to ids by its merges, remembered, and ids to bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pieces = Pieces(public_tokenizers.PATTERN)
        self.own = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values()) + 1
        self.bytes_of = [b""] * size
        for raw, rank in ranks.items():
            self.bytes_of[rank] = raw
        self.digits = [str(i) for i in range(size)]
        self.dtype = "<u2" if size <= 1 << 16 else "<u4"
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _miss(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            # One match of the pattern is one match alone too, so the library merges it as it is.
            ids = np.array(self.own.encode_ordinary(piece), self.dtype).tobytes()
        if len(self.now) >= CACHE:
            self.old, self.now = self.now, {}
        if len(piece) <= 64:
            self.now[piece] = ids
        return ids

    def encode(self, pieces: list[str]) -> np.ndarray:
        get, miss = self.now.get, self._miss
        return np.frombuffer(b"".join([get(p) or miss(p) for p in pieces]), self.dtype)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=1)
def coder(path: str) -> Coder:
    return Coder(SparkFiles.get(path.removeprefix("files:")) if path.startswith("files:") else path)


# --- chunks ----------------------------------------------------------------------------------------------------------

def chunks(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, str]]:
    """``start``, ``text`` of the chunks of a text, each running ``overlap`` characters into the next; the last has more than those."""
    return [(start, text[start:start + chunk + overlap]) for start in range(0, max(1, len(text) - overlap), chunk)]


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


def _cut_kernel(chunk: int, overlap: int):
    def step(batch: pa.RecordBatch) -> dict:
        rows = [(key, i, seq, start, start + len(part) == len(text), part)
                for key, i, text in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "text")))
                for seq, (start, part) in enumerate(chunks(text, chunk, overlap))]
        types = pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.string()
        return {name: pa.array(made, kind) for name, kind, made in zip(_names(CHUNKS), types, zip(*rows))} if rows else None

    return step


def _split_kernel(path: str, chunk: int, overlap: int):
    """``ends`` of the pieces of a chunk; of those ``head`` lies in what it shares with the chunk before, ``tail`` with the next.

    ``tail`` has only ends that what follows the chunk cannot change. A chunk's start counts as an end.
    """
    pieces = coder(path).pieces

    def step(batch: pa.RecordBatch) -> dict:
        ends, heads, tails = [], [], []
        for seq, start, last, text in zip(*(batch.column(c).to_pylist() for c in ("seq", "start", "last", "text"))):
            at = np.cumsum([0, *map(len, pieces.cut(text))])
            ends.append(at[1:].astype(np.int32))
            heads.append(start + at[at <= overlap] if seq else [])
            sure = at <= len(text) - AHEAD
            tails.append([] if last else start + at[sure & (at >= chunk)])
        lists = pa.list_(pa.int64())
        return {**{c: batch.column(c) for c in _names(CHUNKS)},
                "ends": pa.array(ends, pa.list_(pa.int32())), "head": pa.array(heads, lists), "tail": pa.array(tails, lists)}

    return step


def _encode_kernel(path: str):
    """The ids of a chunk's pieces from ``begin`` to ``stop``, places in the whole text; null is the text's end."""
    own = coder(path)

    def step(batch: pa.RecordBatch) -> dict:
        ids = []
        for start, begin, stop, text, ends in zip(*(batch.column(c).to_pylist() for c in ("start", "begin", "stop", "text", "ends"))):
            to = np.array(ends, np.int64)
            come = np.concatenate(([0], to[:-1]))
            mine = (come >= begin - start) & (to <= (len(text) if stop is None else stop - start))
            ids.append(own.encode([text[a:b] for a, b in zip(come[mine].tolist(), to[mine].tolist())]).astype("<u4").tobytes())
        return {**{c: batch.column(c) for c in ("key", "doc_id", "seq")}, "ids": pa.array(ids, pa.binary())}

    return step


def _in_order(path: str, chunk: int):
    """Chunks of a text one after another, for texts whose chunks never agree: what is not sure yet waits for the next.

    Text that waits is split anew only when it has doubled, so a piece that runs over many chunks costs in proportion.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        waiting, asked = "", 0
        for batch in batches:
            for key, doc_id, seq, last, text in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "seq", "last", "text"))):
                waiting = text if seq == 0 else waiting + text
                asked = 0 if seq == 0 else asked
                # All but the last chunk bring only what is theirs alone; the last brings the rest.
                sure: list[str] = []
                if last or len(waiting) >= 2 * asked:
                    sure = own.pieces.cut(waiting)
                    if not last:
                        at = np.cumsum(list(map(len, sure)))
                        sure = sure[:int(np.searchsorted(at, len(waiting) - AHEAD, "right"))]
                        waiting = waiting[sum(map(len, sure)):]
                        asked = len(waiting)
                ids = own.encode(sure).astype("<u4").tobytes()
                yield pa.RecordBatch.from_pylist(
                    [{"key": key, "doc_id": doc_id, "seq": seq, "ids": ids}],
                    pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.int32()), ("ids", pa.binary())]),
                )

    return run


def long_parts(texts: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``key``, ``doc_id``, ``seq``, ``ids`` (32-bit little-endian): a row for each chunk of ``texts`` (``key``, ``doc_id``, ``text``).

    Every chunk is split by a task that sees nothing else. A split depends only on what follows it, so where two
    neighbours have an end in common, both have the true pieces from there if the left one has. A text whose
    neighbours all meet so is encoded chunk by chunk; one with a piece longer than the overlap is split in order.
    """
    rows = map_texts(texts, CHUNKS, _cut_kernel, chunk, overlap).repartition("key", "seq")
    made = "ends array<int>, head array<long>, tail array<long>"
    split = stored(map_texts(rows, f"{CHUNKS}, {made}", _split_kernel, path, chunk, overlap))
    following = split.select("key", (F.col("seq") - 1).alias("seq"), "head")
    met = split.select("key", "seq", "last", "tail").join(following, ["key", "seq"], "left").select(
        "key", "seq", "last", F.array_min(F.array_intersect("tail", "head")).alias("stop"))
    whole = met.groupBy("key").agg(F.bool_and(F.col("last") | F.col("stop").isNotNull()).alias("whole"))
    order = Window.partitionBy("key").orderBy("seq")
    spans = met.withColumn("begin", F.coalesce(F.lag("stop").over(order), F.lit(0))).join(whole, "key")
    spans = stored(spans.select("key", "seq", "begin", "stop", "whole"))
    cut = split.select("key", "doc_id", "seq", "start", "last", "text", "ends").join(spans, ["key", "seq"])
    schema = "key long, doc_id long, seq int, ids binary"
    apart = map_texts(cut.where("whole"), schema, _encode_kernel, path)
    own = F.when(F.col("last"), F.col("text")).otherwise(F.substring("text", 1, chunk))
    rest = cut.where("not whole").select("key", "doc_id", "seq", "last", own.alias("text"))
    ordered = rest.repartition("key").sortWithinPartitions("key", "seq").mapInArrow(_in_order(path, chunk), schema)
    return apart.unionByName(ordered)


# --- whole texts -----------------------------------------------------------------------------------------------------

def _short(docs: DataFrame, chunk: int) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= chunk)


def _long(docs: DataFrame, chunk: int) -> DataFrame:
    """Rows with a ``key`` of their own; it is drawn once and written with the first table made of it."""
    return docs.where(F.length("text") > chunk).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")


def _short_kernel(path: str):
    own = coder(path)

    def step(batch: pa.RecordBatch) -> dict:
        count, ids_sha, text_sha = [], [], []
        for text in batch.column("text").to_pylist():
            ids = own.encode(own.pieces.cut(text)).tolist()
            count.append(len(ids))
            ids_sha.append(hashlib.sha256(" ".join(map(own.digits.__getitem__, ids)).encode()).hexdigest())
            text_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
        return {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(count, pa.int64()),
                "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}

    return step


def _fold(path: str):
    """Digests of the chunks of a text that come one after another; no more than one chunk is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = coder(path), None

        def done():
            return pa.RecordBatch.from_pylist(
                [{"doc_id": at[1], "n_tokens": at[2], "ids_sha256": at[3].hexdigest(), "decoded_sha256": at[4].hexdigest()}],
                pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]),
            )

        for batch in batches:
            for key, doc_id, packed in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "ids"))):
                if at is None or at[0] != key:
                    if at is not None:
                        yield done()
                    at = [key, doc_id, 0, hashlib.sha256(), hashlib.sha256()]
                ids = np.frombuffer(packed, "<u4").tolist()
                if ids:
                    at[3].update((" " * (at[2] > 0) + " ".join(map(own.digits.__getitem__, ids))).encode())
                    at[4].update(own.decode(ids))
                    at[2] += len(ids)
        if at is not None:
            yield done()

    return run


def digests(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` (decimal ids, a space between), ``decoded_sha256``, a row for each row of ``docs``.

    Texts of up to ``chunk`` characters are encoded where they are read; longer ones in chunks that any executor may
    take, by :func:`long_parts`. Null counts as empty: no ids and the digests of nothing. A null doc_id stays null,
    repeated rows each give a row, an empty table gives none, other columns are not read. ``path`` is a file every
    executor has, or ``files:NAME`` for one sent with ``SparkContext.addFile``.
    """
    short = map_texts(_short(docs, chunk), DIGESTS, _short_kernel, path)
    parts = long_parts(_long(docs, chunk), path, chunk, overlap)
    ship(docs.sparkSession)
    folded = parts.repartition("key").sortWithinPartitions("key", "seq").mapInArrow(_fold(path), DIGESTS)
    return short.unionByName(folded)


def _ids_kernel(path: str):
    own = coder(path)

    def step(batch: pa.RecordBatch) -> dict:
        made = [own.encode(own.pieces.cut(t)).astype("<u4").tobytes() for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "ids": pa.array(made, pa.binary())}

    return step


def encode(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``key``, ``seq``, ``ids`` (32-bit little-endian binary): the ids of each text.

    A text of up to ``chunk`` characters is one row with a null ``key``; a longer one is a row for each chunk, of
    one ``key`` and in the order of ``seq``, so no row is larger than a chunk. Cases as in :func:`digests`.
    """
    short = map_texts(_short(docs, chunk), "doc_id long, ids binary", _ids_kernel, path)
    short = short.select("doc_id", F.lit(None).cast("long").alias("key"), F.lit(0).alias("seq"), "ids")
    return short.unionByName(long_parts(_long(docs, chunk), path, chunk, overlap).select("doc_id", "key", "seq", "ids"))


def _back_kernel(path: str):
    own = coder(path)

    def step(batch: pa.RecordBatch) -> dict:
        texts = [None if ids is None else own.decode(np.frombuffer(ids, "<u4").tolist()) for ids in batch.column("ids").to_pylist()]
        return {**{c: batch.column(c) for c in ("doc_id", "key", "seq")}, "raw": pa.array(texts, pa.binary())}

    return step


def decode(parts: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``key``, ``seq``, ``raw``: the bytes of each row of :func:`encode`; a row may end inside a character.

    The raw bytes of a text's rows, put one behind the other, are its UTF-8. Null ids give null.
    """
    return map_texts(parts.select("doc_id", "key", "seq", "ids"), "doc_id long, key long, seq int, raw binary",
                     _back_kernel, path, column="ids")
