"""Token ids in a binary format of directly addressable codes: any token can be read without decoding its block."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from cartwise.llm.common import map_texts, ship, slices

MAGIC, CHUNK, RANK = b"DAC1", 8, 512  # bits of a level; bits of a bitmap that one entry of its rank directory covers
SEGMENT = 1 << 20  # tokens of a segment, at least; a segment ends with a document
END = 2  # id after each document
CACHE = 150_000  # words in each of the two generations a task remembers; a matter of speed only
SCHEMA = "part int, seq int, first long, n_tokens long, doc_ids array<bigint>, doc_tokens array<bigint>, payload binary"


# --- the codes -------------------------------------------------------------------------------------------------------

def pack(ids: np.ndarray) -> bytes:
    """A segment's bytes.

    Level 0 has the low 8 bits of every id, and a bitmap that says which ids go on; level 1 has the next 8 bits of
    those, and so on. A rank directory gives the ones before every 512 bits, so the place of an id in the next level
    is one entry and a short count away. Layout: magic, number of levels, then for each level its length, its bytes,
    its bitmap and its directory (32-bit counts); the last level has no bitmap.
    """
    values = ids if ids.dtype == np.uint16 else np.asarray(ids, np.uint32)
    levels = []
    while True:
        more = values > 0xFF
        last = not more.any()
        levels.append(struct.pack("<QB", len(values), last) + (values & 0xFF).astype(np.uint8).tobytes())
        if last:
            return MAGIC + struct.pack("<B", len(levels)) + b"".join(levels)
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(np.bitwise_count(bits), np.arange(0, len(bits), RANK // 8), dtype=np.uint32)
        levels[-1] += bits.tobytes() + np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4").tobytes()
        values = values[more] >> CHUNK


class Segment:
    """A packed segment, read in place."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.levels: list[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]] = []
        at = 5
        for _ in range(payload[4]):
            length, last = struct.unpack_from("<QB", payload, at)
            at += 9
            low = np.frombuffer(payload, np.uint8, length, at)
            at += length
            bits = ranks = None
            if not last:
                size = -(-length // 8)
                bits = np.frombuffer(payload, np.uint8, size, at)
                at += size
                ranks = np.frombuffer(payload, "<u4", -(-length // RANK), at)
                at += ranks.nbytes
            self.levels.append((low, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, place: int) -> int:
        """One id, from a byte of each level and a rank between them."""
        value = shift = 0
        for low, bits, ranks in self.levels:
            value |= int(low[place]) << shift
            if bits is None or not bits[place >> 3] >> (place & 7) & 1:
                break
            block = place // RANK
            inside = bits[block * RANK // 8:place >> 3]
            rest = int(bits[place >> 3]) & ((1 << (place & 7)) - 1)
            place = int(ranks[block]) + int(np.bitwise_count(inside).sum()) + rest.bit_count()
            shift += CHUNK
        return value

    def all(self) -> np.ndarray:
        """Every id in order."""
        ids, where = self.levels[0][0].astype(np.uint32), None
        for shift, (low, bits, _) in enumerate(self.levels):
            if shift:
                ids[where] |= low.astype(np.uint32) << np.uint32(CHUNK * shift)
            if bits is not None:
                on = np.flatnonzero(np.unpackbits(bits, count=len(low), bitorder="little"))
                where = where[on] if shift else on
        return ids


# --- the tokenizer ---------------------------------------------------------------------------------------------------

TOGETHER = 10_000  # new words that the library is given as one text
SLICE = 12 << 20  # bytes of text coded at once


def _joined(piece: str) -> bool:
    """Does white space run on behind the space or line break that the text was cut at?

    One that stands alone before a letter starts a token of its own or of its word, whatever is before it, so a text
    cut there is encoded piece by piece. Texts with other white space are encoded at a time.
    """
    after = piece[1:2] if piece[:1] == "\n" else piece[:1]
    return piece[:1] != "\0" and (not after or after.isspace())


class Encoder:
    """A byte-level BPE file of the tokenizers library, with a memory for pieces that come again.

    The library encodes all pieces; those new in a slice of texts are handed to it as one text, and its tokens are
    dealt back by their lengths in bytes.
    """

    def __init__(self, path: str):
        self.own = Tokenizer.from_file(path)
        self.own.no_truncation()
        self.own.no_padding()
        vocab = self.own.get_vocab(with_added_tokens=False)
        added = {t.content for t in self.own.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        size = self.own.get_vocab_size()
        self.lengths = np.zeros(size, np.int64)
        for label, token in vocab.items():
            self.lengths[token] = len(label)
        self.dtype = "<u2" if size <= 1 << 16 else "<u4"
        # Words met lately, and those of the time before: what comes again moves to the first, the rest is forgotten.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, self.dtype)] * len(texts)
        special = self.special.search if self.special else lambda text: None
        whole = [i for i, text in enumerate(texts) if not text or "\0" in text or special(text)]  # NUL marks first pieces
        held = set(whole)
        cut = [i for i in range(len(texts)) if i not in held]
        if cut:
            # A piece without the mark has a space before it, but for those that begin with a line break.
            marked = pa.array(["\0" + texts[i] for i in cut], pa.large_string())
            parts = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
            coded = parts.flatten().dictionary_encode()
            pieces, index, offsets = coded.dictionary.to_pylist(), coded.indices.to_numpy(), parts.offsets.to_numpy()
            joined = [code for code, piece in enumerate(pieces) if not piece or (piece[0] <= " " or piece[0] > "~") and _joined(piece)]
            made = self._pieces(pieces, joined)
            flat = np.frombuffer(b"".join(made), self.dtype)
            size = np.fromiter(map(len, made), np.int64, len(made)) // flat.itemsize
            begin = np.cumsum(size) - size
            each = size[index]
            ends = np.cumsum(each)
            ids = flat[np.arange(ends[-1]) + np.repeat(begin[index] - ends + each, each)]
            for place, part in zip(cut, np.split(ids, ends[offsets[1:-1] - 1])):
                out[place] = part
            if joined:
                odd = np.zeros(len(pieces), bool)
                odd[joined] = True
                whole += [cut[i] for i in np.flatnonzero(np.logical_or.reduceat(odd[index], offsets[:-1]))]
        for place, ids in zip(whole, self._ids([texts[i] for i in whole])):
            out[place] = np.frombuffer(ids, self.dtype)
        return out

    def _pieces(self, pieces: list[str], joined: list[int]) -> list[bytes]:
        """Ids of each piece; none for those that the text around them joins."""
        if len(self.cache) > CACHE:
            self.cache, self.older = {}, self.cache
        cache, older = self.cache, self.older
        new = {p for p in pieces if p not in cache}.difference([pieces[i] for i in joined])
        known = new & older.keys()
        cache.update(zip(known, map(older.__getitem__, known)))
        new -= known
        first = [p for p in new if p[0] == "\0"]
        cache.update(zip(first, self._ids([p[1:] for p in first])))
        new.difference_update(first)
        self._learn(list(new))
        made = [cache.get(p, b"") for p in pieces] if joined else list(map(cache.__getitem__, pieces))
        return made

    def _ids(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        made = self.own.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in made]

    def _learn(self, pieces: list[str]) -> None:
        for start in range(0, len(pieces), TOGETHER):
            part = pieces[start:start + TOGETHER]
            shown = [p if p[0] == "\n" else " " + p for p in part]
            ids = np.array(self.own.encode_batch_fast(["".join(shown)], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, shown)), np.int64, len(shown)))
            cuts = ((np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1) * ids.itemsize).tolist()
            raw = ids.tobytes()
            self.cache.update(zip(part, [raw[a:b] for a, b in zip([0, *cuts], cuts)]))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# --- the store -------------------------------------------------------------------------------------------------------

def write(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode each text, add the end id and write segments in ascending doc_id order under ``path``.

    Documents are dealt by ranges of (doc_id, text hash), so an id that many rows share is split as well; null ids
    come first. A segment is a Parquet row: its place in its part, the ids and token counts of its documents, and the
    packed codes. Null text counts as empty, a document of the end id alone. Repeated rows are documents each, in any
    order among themselves; an empty table writes no segment; texts of any length are encoded whole and stay in one
    segment; other columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(tokenizer), TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        counts: list[int] = []
        seq = first = held = 0

        def segment() -> pa.RecordBatch:
            columns = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([first], pa.int64()),
                       pa.array([held], pa.int64()), pa.array([names], pa.list_(pa.int64())),
                       pa.array([counts], pa.list_(pa.int64())), pa.array([pack(np.concatenate(ids))], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])

        for piece in slices(batches, "text", SLICE):
            for name, made in zip(piece.column("doc_id").to_pylist(), coder.encode(piece.column("text").to_pylist())):
                ids.append(np.append(made, np.array([END], made.dtype)))
                names.append(name)
                counts.append(len(made) + 1)
                held += counts[-1]
                if held >= SEGMENT:
                    yield segment()
                    seq, first, held, ids, names, counts = seq + 1, first + held, 0, [], [], []
        if names:
            yield segment()

    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The stored segments with ``start``: ids in all segments before. The driver adds up one number a part."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    totals = sorted(map(tuple, rows.groupBy("part").agg(F.sum("n_tokens")).collect()))
    before = np.cumsum([0, *(n for _, n in totals)]).tolist()
    bases = spark.createDataFrame([(p, b) for (p, _), b in zip(totals, before)], "part int, base long")
    return rows.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("first")).drop("base")


def _read_kernel():
    def step(batch: pa.RecordBatch) -> dict:
        names, starts, counts, crcs = [], [], [], []
        for name, count, payload, start in zip(*(batch.column(c).to_pylist() for c in ("doc_ids", "doc_tokens", "payload", "start"))):
            ids = Segment(payload).all().astype("<u4", copy=False)
            ends = np.cumsum(count)
            for b, e in zip((ends - count).tolist(), ends.tolist()):
                crcs.append(zlib.crc32(ids[b:e]))
                starts.append(start + b)
            names += name
            counts += count
        return {"doc_id": pa.array(names, pa.int64()), "start": pa.array(starts, pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())}

    return step


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of each stored document, read back from its codes."""
    rows = segments(spark, path).select("doc_ids", "doc_tokens", "payload", "start")
    return map_texts(rows, "doc_id long, start long, n_tokens long, ids_crc32 long", _read_kernel, column="payload")


def _access_kernel():
    def step(batch: pa.RecordBatch) -> dict:
        places, found = [], []
        for asked, payload, start in zip(*(batch.column(c).to_pylist() for c in ("places", "payload", "start"))):
            segment = Segment(payload)
            places += asked
            found += [segment[p - start] for p in asked]
        return {"place": pa.array(places, pa.int64()), "token": pa.array(found, pa.int64())}

    return step


def tokens_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """``place``, ``token``: the id at each asked place of the whole sequence; places outside it give no row.

    Places are matched to segments by blocks of SEGMENT places, of which a segment of usual size meets two. A null place gives no row, one asked twice a single row, an empty table of places
    or of documents none; other columns are not read.
    """
    rows = segments(spark, path)
    index = rows.select("part", "seq", "start", (F.col("start") + F.col("n_tokens")).alias("stop"))
    index = index.withColumn("block", F.explode(F.sequence(F.col("start").bitwiseAND(-SEGMENT), F.col("stop") - 1, F.lit(SEGMENT))))
    asked = places.select(F.col("place").cast("long").alias("place")).distinct()
    asked = asked.withColumn("block", F.col("place").bitwiseAND(-SEGMENT))
    hit = asked.join(index, "block").where("place >= start and place < stop").groupBy("part", "seq").agg(F.collect_list("place").alias("places"))
    return map_texts(hit.join(rows, ["part", "seq"]).select("places", "payload", "start"), "place long, token long",
                     _access_kernel, column="payload")
