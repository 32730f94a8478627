"""Byte-level vocabularies: tokenizers loaded once a worker, and the bytes that each id stands for."""

from __future__ import annotations

import os
from functools import cache


@cache
def load_tokenizer(path: str):
    """The tokenizer of a file; strings of its special tokens inside texts are plain text. One thread, as Spark has its own tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.encode_special_tokens = True
    return out


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable bytes stand for themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@cache
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; a special token stands for its own string."""
    letters = byte_alphabet()
    tokens = load_tokenizer(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(tokens.values(), default=-1) + 1)
    for token, i in tokens.items():
        out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return out
