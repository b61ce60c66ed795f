"""Source divergence, fill-in-the-middle and chunked byte BPE against plain Python, round trips and odd rows."""

import collections
import hashlib
import random
import re
from base64 import b64decode

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cartwise.llm import bytebpe, divergence, infill
from cartwise.llm.common import table
from cartwise.llm.queries import QUERIES

from .conftest import ODD
from .test_brute import FOLDER, LETTERS

RANKS = public_tokenizers.path(bytebpe.FILE)
MORE = [*LETTERS, "'re", "''", "₏", "՘", "\U00011de0", "\0", "１", "<P>", "<S>", "<M>"]


@pytest.fixture(scope="module")
def own():
    with open(RANKS, "rb") as file:
        ranks = {b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- source divergence -----------------------------------------------------------------------------------------------

def plain_audit(rows, support=3, listed=200):
    rows = [(text or "", lang or "", source or "") for _, text, lang, source, *_ in rows]
    found = [(lang, source, collections.Counter(
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)))
        for text, lang, source in rows]
    out = []
    for lang in {r[0] for r in found}:
        mine = [(s, c) for x, s, c in found if x == lang]
        docs = collections.Counter(t for _, c in mine for t in c)
        kept = sorted(t for t, n in docs.items() if n >= support)
        groups = {s: collections.Counter() for s, _ in mine}
        whole = collections.Counter()
        for s, c in mine:
            for t in kept:
                groups[s][t] += c[t]
                whole[t] += c[t]

        def share(count, t):
            return 1 + 1000000000 * (count[t] + 1) // (sum(count.values()) + len(kept))

        for s, count in groups.items():
            p = {t: share(count, t) for t in kept}
            pairs = [(b, sum((p[t] - share(other, t)) ** 2 // share(other, t) for t in kept)) for b, other in groups.items() if b != s]
            named = [(t, (p[t] - share(whole, t)) ** 2 // share(whole, t)) for t in kept if count[t] and p[t] > share(whole, t)]
            for part, found_, most in (("pair", pairs, None), ("term", named, listed)):
                order = sorted(found_, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(order, 1)]
    return sorted(out)


def audited(docs, **options):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in divergence.audit(docs, **options).collect())


WORDS = ["a", "B", "b", "Éa", "éa", "日本", "x1y", "don't", "zz", "İ", "ß", "\x00q"]


def some_rows(seed, count=120, langs=("en", None, "de"), sources=("a", "b", None, "c", "", "é")):
    rng = random.Random(seed)
    return [(i, None if rng.random() < 0.05 else " ".join(rng.choices(WORDS, k=rng.randint(0, 9))), rng.choice(langs), rng.choice(sources))
            for i in range(count)]


@pytest.mark.parametrize("options", [{}, {"sources": 2, "terms_": 3}, {"listed": 2, "support": 9, "sources": 1, "terms_": 1}])
def test_divergence_against_plain_sums(docs_of, options):
    rows = some_rows(len(options))
    want = plain_audit(rows, options.get("support", 3), options.get("listed", 200))
    assert audited(docs_of(rows), **options) == want and want


def test_divergence_of_odd_rows(docs_of):
    assert audited(docs_of(ODD)) == plain_audit(ODD)
    assert audited(docs_of(ODD).where("false")) == []
    lone = [(i, "same words here", "en", "a") for i in range(4)] + [(9, None, "xx", "p"), (9, "", "xx", "q"), (9, "once", "xx", "q")]
    made = audited(docs_of(lone))
    assert made == plain_audit(lone)
    assert [r for r in made if r[0] == "xx"] == [("xx", "p", "pair", "q", 0, 1), ("xx", "q", "pair", "p", 0, 1)]


def test_sums_of_a_task_are_handed_on_in_parts(docs_of, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD", 3)
    rows = [(r[2] or "", r[3] or "", (r[1] or "").encode()) for r in some_rows(5)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows]) for k in range(3)], names=["lang", "source", "text"])
    total = collections.Counter()
    made = list(divergence._summed([batch]))
    for part in made:
        for r in part.to_pylist():
            total[r["lang"], r["source"], r["term"]] += r["count"]
    want = collections.Counter()
    for lang, source, text in rows:
        for term, n in divergence.terms(text).items():
            want[lang, source, term.decode()] += n
    assert total == want and len(made) > 10


def test_shares_of_large_counts_are_exact(spark):
    rows = [(9 * 10**18, 9 * 10**18, 5), (10**12, 3 * 10**12, 7), (0, 0, 0), (0, 0, 3)]
    made = spark.createDataFrame(rows, "n long, total long, v long").select(
        divergence._share(F.col("n"), F.col("total"), F.col("v")).alias("p")).collect()
    assert [r.p for r in made] == [None if t + v == 0 else 1 + 10**9 * (n + 1) // (t + v) for n, t, v in rows]


# --- fill in the middle ----------------------------------------------------------------------------------------------

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_infill(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    n, drawn = len(units), sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(drawn[k:k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    form = "spm" if h[3] % 100 < 80 else "psm"
    output = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return n, form, len(pre), len(mid), sha(output), sha(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(MORE), max_size=30), st.integers(0, 500))
def test_infill_of_any_text(letters, doc_id):
    text = "".join(letters)
    n, form, before, inside, output = infill.rearranged(text.encode(), infill.numbers(doc_id))
    assert (n, form, before, inside, sha(output)) == plain_infill(doc_id, text)[:5]


@given(st.text(max_size=60), st.integers(0, 60))
def test_exceptions_convert_both_ways(text, place):
    raw, place = text.encode("utf-8", "replace"), min(place, len(text))
    text = raw.decode()
    index = infill.Exceptions(raw)
    cut = len(text[:place].encode())
    assert (index.bytes(place), index.chars(cut)) == (cut, place)
    assert len(index.places) == sum(ord(c) > 127 for c in text)


def test_infill_of_tables(spark, docs_of):
    long = [(70, "é " * 300_000 + "日本語 <x>" * 100_000, None, None), (71, "x" * 3_000_000, None, None), (73, "a <P> b", None, None)]
    rows = [*ODD, *long, *((100 + i, "".join(random.Random(i).choices(MORE[:-3], k=40)), None, None) for i in range(200))]
    made = infill.digests(docs_of(rows)).collect()
    want = sorted(((i, *plain_infill(i, t)) for i, t, *_ in rows), key=str)
    assert sorted(map(tuple, made), key=str) == want
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    assert infill.digests(docs_of(rows).where("false")).collect() == []
    kept = infill.transform(docs_of(ODD).withColumn("output", F.lit("own"))).select("row.*", F.col("output").alias("made"))
    assert {(r["row"], r["output"]) for r in kept.collect()} == {("clash", "own")}


# --- byte-level BPE in chunks ----------------------------------------------------------------------------------------

def test_pieces_and_ids_are_the_library_s(own):
    rng, mine = random.Random(4), bytebpe.coder(RANKS)
    for _ in range(6000):
        text = "".join(rng.choices(MORE, k=rng.randint(0, 16)))
        ids = mine.encode(mine.pieces.cut(text)).tolist()
        assert ids == own.encode_ordinary(text)
        assert mine.decode(ids) == text.encode()


def test_every_character_is_classed_as_the_library_classes_it():
    old, single = bytebpe.OLD, {bytes([b]): b for b in range(256)}
    odd = bytebpe.coder(RANKS).pieces.differing()
    assert odd and all(old.search(chr(c)) for c in odd)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        theirs = set(bytes(tiktoken.Encoding("c", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode())
        assert {c for c in every if bytebpe.regex.match(name, odd.get(ord(c), c))} == theirs


def plain_digests(own, text):
    ids = own.encode_ordinary(text or "")
    return len(ids), sha(" ".join(map(str, ids))), sha((text or "").encode())


def long_texts():
    """Texts over many small chunks: words, runs longer than the overlap, white space runs, apostrophes, odd letters."""
    rng = random.Random(7)
    yield from ("".join(rng.choices(MORE, k=rng.randint(20, 300))) for _ in range(150))
    yield from ("x" * 200, "x" * 39 + " " * 90 + "y", "'" * 100, "'s" * 80, "'re " * 60, " \n" * 100, "é" * 41 + "'ll" * 20, "word " * 60,
                "日" * 120 + "1" * 120 + "!" * 120, "a" * 30 + " " * 31 + "b" * 31 + "\n" * 31 + "c")


@pytest.mark.parametrize("chunk, overlap", [(16, 6), (30, 12), (64, 20)])
def test_chunks_are_stitched_to_the_whole_text_s_ids(docs_of, own, chunk, overlap):
    texts = list(long_texts())
    made = bytebpe.digests(docs_of([(i, t, None, None) for i, t in enumerate(texts)]), RANKS, chunk, overlap).collect()
    assert sorted(map(tuple, made)) == [(i, *plain_digests(own, t)) for i, t in enumerate(texts)]


def test_rows_of_long_texts_decode_to_their_bytes(docs_of, own):
    texts = list(long_texts())[:40] + ["short"]
    parts = bytebpe.encode(docs_of([(i, t, None, None) for i, t in enumerate(texts)]), RANKS, 16, 6)
    back = bytebpe.decode(parts, RANKS).collect()
    for i, text in enumerate(texts):
        mine = sorted((r for r in back if r.doc_id == i), key=lambda r: r.seq)
        assert b"".join(r.raw for r in mine) == text.encode() and len(mine) > 1 - (i == 40)
    ids = parts.where("doc_id = 3").orderBy("seq").collect()
    assert np.frombuffer(b"".join(r.ids for r in ids), "<u4").tolist() == own.encode_ordinary(texts[3])


def test_digests_of_whole_tables(spark, docs_of, own):
    made = QUERIES["op13_bytebpe"](spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    assert {r.doc_id: tuple(r)[1:] for r in made} == {i: plain_digests(own, t) for i, t in texts.items()}
    rows = [*ODD, (50, "long words " * 20_000 + "z" * 80_000 + " 日本" * 30_000, None, None), (50, " " * 100_000, None, None)]
    odd = bytebpe.digests(docs_of(rows), RANKS).collect()
    assert sorted(map(tuple, odd), key=str) == sorted(((i, *plain_digests(own, t)) for i, t, *_ in rows), key=str)
    assert bytebpe.digests(docs_of(ODD).where("false"), RANKS).collect() == []
