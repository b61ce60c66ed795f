"""One text longer than every slice a kernel works in, next to short ones."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from cartwise.llm import bpe, common, infill, langid, licenses, mixing, rules, simhash, tokens
from cartwise.llm.common import scratch

from .test_brute import BYTE_FILE, WORD_FILE


@pytest.fixture(scope="module")
def words():
    rng = random.Random(11)
    known = ["".join(rng.choices("abcdefghijklmnoprstuvwéß", k=rng.randint(2, 9))) for _ in range(4000)]
    made = rng.choices(known, k=tokens.SLICE // 6 + 100_000)
    made[70_000:70_006] = "under the mit license mit x".split()
    return made


@pytest.fixture(scope="module")
def docs(spark, words):
    text = " ".join(words)
    assert len(text.encode()) > max(tokens.SLICE, common.SLICE_BYTES)
    rows = [(1, "a short text", "en", "a"), (2, text, "en", "a"), (3, None, "en", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_tokens_of_a_long_text(spark, docs, words):
    path = scratch(spark)
    tokens.write(docs, path, BYTE_FILE)
    made = {r.doc_id: r for r in tokens.read_documents(spark, path).collect()}
    ids = Tokenizer.from_file(BYTE_FILE).encode(" ".join(words), add_special_tokens=False).ids + [2]
    assert (made[2].n_tokens, made[2].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_word_ids_of_a_long_text(docs, words):
    made = {r.doc_id: r for r in bpe.digests(docs, WORD_FILE).collect()}
    ids = Tokenizer.from_file(WORD_FILE).encode(" ".join(words), add_special_tokens=False).ids
    assert made[2].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and made[3].n_tokens == 0


def test_fingerprint_and_counts_of_a_long_text(spark, docs, words):
    raw = [w.encode() for w in words]
    count = np.zeros(64, np.int64)
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(raw[i:i + 3]), 42) for i in range(len(raw) - 2)], np.uint64)
    for bit in range(64):
        count[bit] = int(((hashes >> np.uint64(bit)) & np.uint64(1)).sum())
    want = sum(1 << b for b in range(64) if 2 * count[b] > len(hashes))
    fps = {r.doc_id: r.fp for r in simhash.fingerprints(docs).collect()}
    assert fps[2] % (1 << 64) == want and fps[3] == 0
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    made = {r.doc_id: r for r in rules.quality(docs, empty).collect()}
    assert made[2].n_words == len(words) and made[2].word_chars == sum(map(len, words))
    sizes = {r.doc_id: r["size"] for r in mixing.mix(docs).collect()}
    assert sizes == {1: 3, 2: len(words), 3: 0}


def test_labels_and_language_of_a_long_text(docs, words):
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert found[2].n_words == len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ".join(words)))
    assert found[2].base_labels == "mit" and found[2].first_word == 70_000
    said = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert said[3].lang_pred == "und" and said[2].lang_pred in ("en", "und")


def test_parts_of_a_long_text(docs, words):
    made = {r.doc_id: r for r in infill.digests(docs).collect()}
    assert made[2].n == len(words) and made[2].restored_sha256 == hashlib.sha256(" ".join(words).encode()).hexdigest()
