"""Fill-in-the-middle training text: documents cut twice between words and put together anew, and the way back."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartwise.llm.common import carried, map_texts, with_row

# The marks, the seed, and how many of a hundred texts are cut, and of those take the suffix first.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, CUT, SUFFIX_FIRST = 42, 50, 80
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
MADE = "n long, form string, prefix_chars long, middle_chars long, output string"
BLOCK = 1 << 20  # bytes looked at at once for letters of several bytes


class Exceptions:
    """Where a UTF-8 text departs from one byte a character: the characters of several bytes, and what they have too many.

    ``places`` are the bytes such characters begin at, ``excess[i]`` the bytes that the first i of them have beyond one
    each. Between two entries a character is a byte, so a place there is found by a difference, and an ASCII text has
    no entries at all.
    """

    def __init__(self, text: bytes):
        raw = np.frombuffer(text, np.uint8)
        found = [np.flatnonzero(raw[at:at + BLOCK] >= 0xC0) + at for at in range(0, 0 if text.isascii() else len(raw), BLOCK)]
        self.places = np.concatenate(found) if found else np.zeros(0, np.int64)
        lead = raw[self.places]
        more = 1 + (lead >= 0xE0) + (lead >= 0xF0).astype(np.int64)
        self.excess = np.concatenate(([0], np.cumsum(more)))
        self.letters = self.places - self.excess[:-1]  # the same characters, by their number in the text

    def chars(self, cut: int) -> int:
        """Characters before a byte that begins one, or before the end."""
        return int(cut - self.excess[np.searchsorted(self.places, cut)])

    def bytes(self, cut: int) -> int:
        """Bytes before the character of this number."""
        return int(cut + self.excess[np.searchsorted(self.letters, cut)])


def unit_ends(text: bytes) -> np.ndarray:
    """The byte after each unit: a word with the white space before it, or white space that ends the text."""
    if not text:
        return np.zeros(0, np.int64)
    space = SPACE[np.frombuffer(text, np.uint8)]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(text))


def numbers(doc_id: int | None, seed: int = SEED) -> tuple[int, ...]:
    """Four numbers drawn from the seed and the document's id, of a null id from the seed alone."""
    drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(drawn[at:at + 8], 16) for at in range(0, 32, 8))


def rearranged(text: bytes, drawn: tuple[int, ...], cut: int = CUT, suffix_first: int = SUFFIX_FIRST):
    """Units, form, characters of prefix and middle (None if plain), and the bytes of the output."""
    ends = unit_ends(text)
    n = len(ends)
    if n == 0 or drawn[2] % 100 >= cut or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    low, high = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (low, high))
    index = Exceptions(text)
    before, inside = index.chars(a), index.chars(b) - index.chars(a)
    if drawn[3] % 100 < suffix_first:
        return n, "spm", before, inside, b"".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]))
    return n, "psm", before, inside, b"".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]))


def _kernel(seed: int, cut: int, suffix_first: int):
    def step(batch: pa.RecordBatch) -> dict:
        ids = batch.column("row").field("doc_id").to_pylist()
        texts = batch.column("text").to_pylist()
        made = [rearranged(t or b"", numbers(i, seed), cut, suffix_first) for i, t in zip(ids, texts)]
        n, form, before, inside, output = zip(*made)
        return {
            "row": batch.column("row"), "n": pa.array(n, pa.int64()), "form": pa.array(form, pa.string()),
            "prefix_chars": pa.array(before, pa.int64()), "middle_chars": pa.array(inside, pa.int64()),
            "output": pa.array(output, pa.binary()).cast(pa.string()),
        }

    return step


def transform(docs: DataFrame, keep: list[str] | None = None, seed: int = SEED, cut: int = CUT,
              suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``row`` (the columns ``keep``, all if none are named), ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    A text is cut into ``n`` units at two places drawn from ``seed`` and its id, and put together as prefix, suffix,
    middle (``psm``) or suffix, prefix, middle (``spm``), each behind its mark. ``plain`` texts come out as they are:
    ``100 - cut`` of a hundred, empty ones, and those that hold a mark. Null counts as empty. A null id draws
    from the seed alone. Repeated rows give equal rows, an empty table none; texts of any length are cut whole, in
    memory of a few times their bytes. Columns of other names, also of those made here, are in ``row`` unharmed.
    """
    columns = docs.columns if keep is None else keep
    held = carried(docs, columns if "doc_id" in columns else [*columns, "doc_id"])
    return map_texts(held, with_row(held, MADE), _kernel, seed, cut, suffix_first)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``form`` was made of: its parts between the marks, in their old order.

    A text that was cut holds no mark, and no mark can begin inside another, so there are three marks and four parts.
    """
    part = F.split(output, "<[PSM]>", -1)
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts of :func:`transform`, and the SHA-256 of each output and of the text restored from it."""
    made = transform(docs, ["doc_id"])
    return made.select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


# The same result as DuckDB SQL over ``documents``; the text before a cut is that of its units.
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS drawn,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT doc_id, text, w, len(w)::BIGINT AS n, ('0x' || drawn[1:8])::BIGINT AS h1, ('0x' || drawn[9:16])::BIGINT AS h2,
      ('0x' || drawn[17:24])::BIGINT AS h3, ('0x' || drawn[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
      CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {CUT} THEN 'plain'
           WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:], '') AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p"""
