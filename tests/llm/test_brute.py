"""Operators without an SQL twin, against plain Python, an exact round trip, or held-out accuracy."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwise.llm import bpe, langid, lattice, mixing, pii, repeats, rules, simhash, tokens
from cartwise.llm.common import scratch, stored, table
from cartwise.llm.queries import QUERIES
from plans import executed

FOLDER = "/root/testdata/sf0.001"
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def texts(spark):
    rows = table(spark, FOLDER, "documents").select("doc_id", "text", "lang", "source").collect()
    return {r.doc_id: r for r in rows}


def by_id(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, FOLDER).collect()}


# --- token output ----------------------------------------------------------------------------------------------------

def test_stored_tokens_are_the_library_s(spark, texts):
    own, made, start = Tokenizer.from_file(BYTE_FILE), by_id(spark, "op1_tokens"), 0
    for i in sorted(texts):
        ids = own.encode(texts[i].text, add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (made[i].start, made[i].n_tokens, made[i].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_any_token_can_be_read(spark, texts, monkeypatch):
    path = scratch(spark)
    tokens.write(table(spark, FOLDER, "documents"), path, BYTE_FILE)
    own = Tokenizer.from_file(BYTE_FILE)
    ids = [t for i in sorted(texts) for t in [*own.encode(texts[i].text, add_special_tokens=False).ids, 2]]
    asked = [0, len(ids) - 1, len(ids), -1, *random.Random(1).choices(range(len(ids)), k=200)]
    got = {r.place: r.token for r in tokens.tokens_at(spark, path, spark.createDataFrame([(p,) for p in asked], "place long")).collect()}
    assert got == {p: ids[p] for p in asked if 0 <= p < len(ids)}


@given(st.lists(st.integers(0, 1 << 31), max_size=1300))
def test_codes_round_trip(ids):
    segment = tokens.Segment(tokens.pack(np.array(ids, np.uint32)))
    assert segment.all().tolist() == ids == [segment[i] for i in range(len(ids))]


LETTERS = [*"abcdeghinorstu'0123 !?.,<>|-_ßéÉΣςSİǅ", *" " * 6, *"\x1c\x85\t\n\r\x0b\x0c\n\xa0日語🙂½ﬁ", "<|endoftext|>", "hello",
           "'s", "'LL", "\n\n", "  ", "ing", "Ꟊ", "é"]


def test_pieces_encode_as_whole_texts_do():
    rng, mine, own = random.Random(2), tokens.Encoder(BYTE_FILE), Tokenizer.from_file(BYTE_FILE)
    lines = ["".join(rng.choices(LETTERS, k=rng.randint(0, 14))) for _ in range(6000)]
    assert [x.tolist() for x in mine.encode(lines)] == [own.encode(x, add_special_tokens=False).ids for x in lines]


# --- BPE automaton ---------------------------------------------------------------------------------------------------

def test_automaton_encodes_as_the_library_does(spark, texts):
    rng, own, mine = random.Random(3), Tokenizer.from_file(WORD_FILE), bpe.codec(WORD_FILE)
    lines = ["".join(rng.choices(LETTERS, k=rng.randint(0, 14))) for _ in range(8000)] + [r.text for r in texts.values()]
    for line in lines:
        ids = own.encode(line, add_special_tokens=False).ids
        assert mine.encode(line).tolist() == ids
        assert mine.decode(np.array(ids, int)) == own.decode(ids, skip_special_tokens=False)


def naive_bpe(word, merges):
    parts = list(word)
    for a, b in merges:
        i = 0
        while i < len(parts) - 1:
            if parts[i] == a and parts[i + 1] == b:
                parts[i:i + 2] = [a + b]
            i += 1
    return parts


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12))
def test_automaton_of_random_merges(seed, count):
    rng = random.Random(seed)
    known, merges = ["a", "b"], []
    for _ in range(count):
        a, b = rng.choice(known), rng.choice(known)
        if a + b not in known and naive_bpe(a + b, merges) == [a, b]:
            merges.append((a, b))
            known.append(a + b)
    machine = bpe.Automaton({t: i for i, t in enumerate(known)}, merges)
    for _ in range(20):
        word = "".join(rng.choices("ab", k=rng.randint(1, 14)))
        assert [known[i] for i in machine.encode(word)] == naive_bpe(word, merges)


def test_digests_and_tables_agree(spark, texts):
    own, made = Tokenizer.from_file(WORD_FILE), by_id(spark, "op9_bpe")
    for i, row in texts.items():
        ids = own.encode(row.text, add_special_tokens=False).ids
        text = own.decode(ids, skip_special_tokens=False)
        assert made[i].n_tokens == len(ids)
        assert made[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert made[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    docs = table(spark, FOLDER, "documents").where("doc_id < 20")
    back = bpe.decode(bpe.encode(docs, WORD_FILE), WORD_FILE).collect()
    assert all(r.text == own.decode(own.encode(texts[r.doc_id].text, add_special_tokens=False).ids, skip_special_tokens=False) for r in back)


# --- language --------------------------------------------------------------------------------------------------------

def test_held_out_languages_are_found(spark):
    made = {r.doc_id: r for r in QUERIES["op3_langid"](spark, "/root/testdata/sf0.01").collect()}
    langs = {r.doc_id: r.lang for r in table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in made.items())
    held = [i for i, r in made.items() if r.held_out]
    assert sum(made[i].lang_pred == langs[i] for i in held) >= 0.97 * len(held)


# --- mixing ----------------------------------------------------------------------------------------------------------

def test_mix_meets_its_targets(spark, texts):
    made = by_id(spark, "op4_mixing")
    again = by_id(spark, "op4_mixing")
    assert made == again
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for i, r in texts.items()}
    sizes = collections.Counter()
    for i, r in texts.items():
        sizes[r.source] += size[i]
    want = brute_targets(sizes)
    taken, largest = collections.Counter(), collections.Counter()
    for i, r in made.items():
        source = texts[i].source
        assert (r.size, r.source_size) == (size[i], sizes[source]) and abs(r.target - want[source]) < 1e-6
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in sizes)


def brute_targets(sizes):
    names = sorted(sizes)
    weight = {n: 1 + i % 3 for i, n in enumerate(names)}
    fixed = {}
    while True:
        free = [n for n in names if n not in fixed]
        left = sum(sizes.values()) - sum(fixed.values())
        given = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n: 3.0 * sizes[n] for n in free if given[n] > 3 * sizes[n]}
        if not over:
            return {**fixed, **given}
        fixed |= over


def test_overlapping_sources_share_first_copies(spark):
    flow = mixing.min_cost_flow({"x": 10, "y": 10, "xy": 10}, {"x": ["x"], "y": ["y"], "xy": ["x", "y"]}, {"x": 20, "y": 10})
    assert sum(flow.values()) == 30 and sum(w for (p, _), w in flow.items() if p == "xy") == 10  # nobody is repeated
    rows = [(i, "w " * (1 + i % 7), ["a"] if i % 3 else ["b", "a"]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    made = {r.doc_id: r for r in mixing.mix(docs, docs["of"]).collect()}
    total = sum(1 + i % 7 for i in range(300))
    assert abs(sum(r.taken for r in made.values()) - total) <= 14


# --- repeats ---------------------------------------------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=6), st.integers(1, 6))
def test_suffix_sort(parts, length):
    sizes = [max(0, len(p) - length + 1) for p in parts]
    count = collections.Counter(p[i:i + length] for p, n in zip(parts, sizes) for i in range(n))
    got = [f.tolist() for f in repeats.repeated_starts(parts, sizes, length)]
    assert got == [[count[p[i:i + length]] > 1 for i in range(n)] for p, n in zip(parts, sizes)]
    codes = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int16) + 1, 0) for p in parts])
    order = repeats.suffix_order(codes, codes != 0, 100)
    ends = np.flatnonzero(codes == 0)
    tails = [tuple(codes[i:ends[np.searchsorted(ends, i)]]) for i in order if codes[i]]
    assert tails == sorted(tails)


def test_deep_sorts_hold_little(monkeypatch):
    """Fifteen hundred near-like regions of one anchor: the same order, in memory of a few numbers a suffix."""
    import tracemalloc

    rng = np.random.default_rng(2)
    base = rng.integers(97, 123, 700, dtype=np.uint8)
    parts = []
    for _ in range(1500):
        copy = base.copy()
        copy[rng.integers(0, 700, 2)] = 65
        parts.append(copy.tobytes())
    tracemalloc.start()
    found = repeats.repeated_starts(parts, [301] * 1500)
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    count = collections.Counter(p[i:i + 400] for p in parts for i in range(301))
    assert [f.tolist() for f in found] == [[count[p[i:i + 400]] > 1 for i in range(301)] for p in parts]


@pytest.mark.parametrize("hot, most, folder", [
    (repeats.HOT, repeats.HOT_BYTES, FOLDER), (1, repeats.HOT_BYTES, FOLDER), (repeats.HOT, 3000, FOLDER),
    (repeats.HOT, repeats.HOT_BYTES, "/root/testdata/sf0.01"),
])
def test_repeats_against_all_strings(spark, hot, most, folder):
    """Bytes go just where a string of 400 bytes stands twice, in whole tables; a text over several pieces among them."""
    raw = {r.doc_id: r.text.encode() for r in table(spark, folder, "documents").select("doc_id", "text").collect()}
    long = random.Random(5).randbytes(200_000).hex().encode()
    raw |= {9004: long + b"x" + long[-500:], 9005: long[1000:1700]}
    raw |= {9001: b"ab" * 700, 9002: b"q" * 399, 9003: b"z" * 401}
    count = collections.Counter(hashlib.md5(t[i:i + 400]).digest() for t in raw.values() for i in range(len(t) - 399))
    docs = spark.createDataFrame([(i, t.decode()) for i, t in raw.items()], "doc_id long, text string")
    for r in repeats.remove_repeats(docs, hot, most).collect():
        t = raw[r.doc_id]
        edge = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 399):
            if count[hashlib.md5(t[i:i + 400]).digest()] > 1:
                edge[i] += 1
                edge[i + 400] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        kept = hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), gone.sum(), len(repeats.runs(gone)), kept)


# --- personal data ---------------------------------------------------------------------------------------------------

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for hit in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", hit[0])
            doubled = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
            good = (True, kind == 1 and all(int(p) <= 255 for p in hit[0].split(".")), 12 <= len(digits) <= 19 and doubled % 10 == 0,
                    9 <= len(digits) <= 15)[kind]
            if good:
                found.append((kind, *hit.span()))
    return sorted(found, key=lambda s: (s[1], s[0]))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="0123456789.@ab-+() %é", max_size=40))
def test_pattern_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_tagger_adds_spans_and_keeps_the_patterns(spark, texts):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    tagger = pii.fit(docs)
    made = {r.doc_id: r for r in pii.find(table(spark, FOLDER, "documents"), tagger).collect()}
    for i, row in texts.items():
        base = plain_spans(row.text)
        text = ",".join(f"{pii.KINDS[k]}:{b}:{e}" for k, b, e in base)
        assert made[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(made[i].spans.split(","))
    real = [(r.text, s) for r in texts.values() for s in plain_spans(r.text)]
    hits = sum(s in pii.tagged_spans(tagger, [t])[0] for t, s in real)
    assert hits >= 0.8 * len(real) > 0


def test_spans_run_over_windows():
    tags = {0: np.zeros(pii.WINDOW, np.int8), 1: np.zeros(pii.WINDOW, np.int8)}
    border = pii.MARGIN + pii.STRIDE
    text = "x" * (border - 6) + " 1234 5678 9012 " + "y" * 100
    begin = border - 5
    for place in range(begin, begin + 14):
        tag = 5 if place == begin else 6
        tags[0][place], tags[1][place - pii.STRIDE] = tag, tag
    assert pii._joined(text, tags) == [(2, begin, begin + 14)]
    assert pii.masked("a b@c.d, +1 2", [(0, 2, 7), (3, 9, 13)]) == "a [EMAIL], [PHONE]"


# --- SimHash ---------------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def test_near_duplicates_against_all_pairs(spark, texts):
    extra = "one two three four five six seven eight nine ten " * 40
    docs = {i: r.text for i, r in texts.items()} | {9000 + k: extra + f"end{k}" for k in range(60)} | {9990: "", 9991: " \t"}
    fp = {i: plain_fingerprint(t) for i, t in docs.items()}
    want = groups(sorted(docs), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 2)
    made = simhash.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    got = {r.doc_id: (r.hex, r.component_id) for r in made.select("doc_id", simhash.hex_digits(made.fp).alias("hex"), "component_id").collect()}
    assert got == {i: (f"{fp[i]:016x}", want[i]) for i in docs}


@pytest.mark.parametrize("size, radius", [(simhash.SHINGLE, simhash.RADIUS), (2, 3), (4, 0)])
def test_one_document_of_each_component_stays(spark, texts, size, radius):
    """The pipeline's stage with its settings, and others, against all pairs: the smallest id of each component."""
    extra = "one two three four five six seven eight nine ten " * 40
    docs = {i: r.text for i, r in texts.items()} | {9000 + k: extra + f"end{k}" for k in range(60)} | {9990: "", 9991: " \t"}
    fp = {i: simhash.fingerprint(t.encode(), size) for i, t in docs.items()}
    want = groups(sorted(docs), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= radius)
    table_ = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    made = simhash.survivors(table_, size, radius).collect()
    assert sorted((r.doc_id, r.text) for r in made) == sorted((i, docs[i]) for i in docs if want[i] == i)


def test_links_of_planted_distances(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << x for x in rng.sample(range(64), k)) for b in base for k in (0, 1, 1, 2, 2, 2, 3, 4)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    got = {frozenset((r.a, r.b)) for r in found}
    want = {frozenset((a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert got == want


def test_probes_are_not_broadcast(spark):
    fps = stored(spark.range(1000).select(F.xxhash64("id").alias("fp")))
    made = simhash.links(fps)
    made.collect()
    assert "Broadcast" not in executed(made) and "SortMergeJoin" in executed(made)


def test_long_chains_are_one_component(spark):
    from cartwise.llm.graph import components

    rows = [(i, i + 1) for i in range(500)] + [(1000, 1001), (1001, 1000), (7, 7), (None, 3)]
    made = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert len({made[i] for i in range(501)}) == 1 and made[1000] == made[1001] != made[0] and len(made) == 503


# --- lattice ---------------------------------------------------------------------------------------------------------

def test_lattice_points_are_nearest():
    steps, x = lattice.shortest(), np.random.default_rng(0).normal(size=(400, 8)) * 2
    points = lattice.nearest(x)
    own = ((x - points) ** 2).sum(1)
    assert len(steps) == 240 and (((x[:, None] - points[:, None] - steps) ** 2).sum(2).min(1) >= own - 1e-9).all()


@pytest.mark.parametrize("cosine", [0.98, 0.99])
def test_lattice_recall_at_the_threshold(cosine):
    rng = np.random.default_rng(5)
    a, n = rng.normal(size=(2, 1000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    n -= (n * a).sum(1, keepdims=True) * a
    b = cosine * a + np.sqrt(1 - cosine ** 2) * n / np.linalg.norm(n, axis=1, keepdims=True)
    ka, kb = (lattice.cells(x, np.zeros(1000, int)) for x in (a, b))
    assert ((ka == kb[:, :, :1]).any((1, 2)) | (kb == ka[:, :, :1]).any((1, 2))).mean() >= 0.9


# --- quality ---------------------------------------------------------------------------------------------------------

def test_quality_counts(spark, texts):
    made = by_id(spark, "op10_quality")
    for i, row in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text)
        lines = [x for x in row.text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = collections.Counter(zip(words, words[1:], words[2:]))
        marked = {p + k for p in range(len(words) - 2) if windows[tuple(words[p:p + 3])] > 1 for k in range(3)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", row.text)), len(lines) - len(set(lines)), len(marked))
        r = made[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)


def test_bounds_are_exact():
    from math import comb

    for good, risk, doubt in ((50, 0.1, 0.05), (400, 0.01, 0.1), (1000, 0.02, 0.003)):
        for lost in range(12):
            tail = sum(comb(good, k) * risk ** k * (1 - risk) ** (good - k) for k in range(lost + 1))
            assert rules.certified(lost, good, risk, doubt) == (lost < good * risk and tail <= doubt)
    assert not rules.certified(0, 0, 0.1, 0.1) and not rules.certified(0, 20, 0.01, 0.05)


# --- pipeline --------------------------------------------------------------------------------------------------------

def test_pipeline_is_its_stages(spark):
    import corpus_pipeline

    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, FOLDER).cache()
        assert place == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    rows = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect()))
    assert rows == sorted(map(tuple, docs.collect())) and rows
