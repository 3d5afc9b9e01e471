"""Token ids of whole texts by the public byte-level BPE, and a cache that makes repeated words cheap.

A text without two white-space characters in a row is cut at its single spaces: no pre-token of the pattern spans
such a cut, so each piece can be encoded by itself and looked up when it comes again. Any other text is encoded
in one go. Strings of special tokens are ordinary text here. Vocabulary files are read where they are installed.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import public_tokenizers
import tiktoken

VOCABULARY = "byte_bpe_50k.tiktoken"
#: The vocabulary's end-of-document id. Ordinary text never gives it.
END = 50256
CACHE = 400_000
_RUN = re.compile(r"\s\s")


class _Pieces(dict):
    """Ids as bytes, by what follows a space."""

    def __init__(self, encode, kind: str):
        super().__init__()
        self.encode, self.kind = encode, kind

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        ids = array(self.kind, self.encode(" " + piece)).tobytes()
        if len(piece) < 40:
            self[piece] = ids
        return ids


class Encoder:
    """Text to little-endian ids: kind 'I' has 4 bytes an id, 'H' has 2."""

    def __init__(self, path: str, kind: str = "I"):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode, self.kind = own.encode_ordinary, kind
        self.pieces = _Pieces(self.encode, kind)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _RUN.search(text):
            return array(self.kind, self.encode(text)).tobytes()
        first, *rest = text.split(" ")
        return array(self.kind, self.encode(first)).tobytes() + b"".join(map(self.pieces.__getitem__, rest))


@lru_cache(maxsize=4)
def encoder(path: str, kind: str = "I") -> Encoder:
    """One encoder per worker process."""
    return Encoder(path, kind)


def vocabulary() -> str:
    return public_tokenizers.path(VOCABULARY)
