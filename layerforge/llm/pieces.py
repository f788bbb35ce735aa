"""Byte-level BPE vocabularies, and token counts by pieces of a text.

A piece is what lies between two single spaces with no white space beside them.
The pre-tokenizer pattern of the GPT-2 family always starts a token at such a
space, so a text's tokens are those of its pieces (each but the first with the
space in front), and a piece that was seen before need not be encoded again.
"""

from __future__ import annotations

import base64
import re
from functools import partial

from .common import worker_cache

#: Pieces that a worker remembers; beyond it the memory starts anew.
MEMORY = 400_000

_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoding(path: str):
    """The tiktoken encoding of a rank file, once a worker."""
    cache = worker_cache()
    if ("encoding", path) not in cache:
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        cache["encoding", path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                                    mergeable_ranks=ranks, special_tokens={})
    return cache["encoding", path]


def split_pieces(text: str) -> list[str]:
    """The pieces of a text; ``" ".join`` restores it."""
    parts = text.split(" ")
    for p in parts:
        if not p or p[0].isspace() or p[-1].isspace():
            return _SAFE_SPACE.split(text)
    return parts


class Counts(dict):
    """piece -> number of tokens of the piece with a space in front."""

    def __init__(self, path: str):
        self.encode = encoding(path).encode_ordinary

    def __missing__(self, piece: str) -> int:
        if len(self) >= MEMORY:
            self.clear()
        self[piece] = n = len(self.encode(" " + piece))
        return n

    def first(self, piece: str) -> int:
        return len(self.encode(piece)) if piece else 0


def counts(path: str) -> Counts:
    cache = worker_cache()
    if ("counts", path) not in cache:
        cache["counts", path] = Counts(path)
    return cache["counts", path]


def count_tokens(text: str, path: str) -> int:
    if not text:
        return 0
    c = counts(path)
    parts = split_pieces(text)
    return c.first(parts[0]) + sum(map(c.__getitem__, parts[1:]))


def counter(path: str):
    return partial(count_tokens, path=path)
