"""Texts that hold the NUL character, which marks first pieces, encode as the library does."""

import random

from tokenizers import Tokenizer

from cartwise.llm import tokens

from .test_brute import BYTE_FILE, LETTERS


def test_nul_is_text():
    rng, mine, own = random.Random(8), tokens.Encoder(BYTE_FILE), Tokenizer.from_file(BYTE_FILE)
    lines = ["a \0b", "\0", "\0\0", " \0", "a\0 b", "\n\0x", "plain text", *("".join(rng.choices([*LETTERS, "\0", "\0"], k=rng.randint(0, 14))) for _ in range(3000))]
    assert [x.tolist() for x in mine.encode(lines)] == [own.encode(x, add_special_tokens=False).ids for x in lines]
