"""Word shingles of whole texts as sorted 64-bit hashes, by array operations over the text's bytes.

A-Z are lowered, words are runs without ASCII white space. A text's set holds its distinct runs of SIZE words; a
text with fewer words has one shingle, the whole sequence; a text without words has none.
"""

from __future__ import annotations

import numpy as np

SIZE = 5
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Odd multipliers by place, without small sums that agree.
_WEIGHTS = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(SIZE)], np.uint64)
_powers = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}
#: Powers are kept up to this length; longer texts are hashed in blocks that start anew.
_BLOCK = 1 << 16


def _power(sign: int) -> np.ndarray:
    if len(_powers[sign]) < _BLOCK:
        factors = np.full(_BLOCK + 1, _BASE if sign > 0 else _INVERSE, np.uint64)
        factors[0] = 1
        _powers[sign] = np.cumprod(factors, dtype=np.uint64)
    return _powers[sign]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo 2 ** 64: prefix sums of weighted bytes, cut at the words and shifted back."""
    out = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        done = 0
        while done < len(starts):
            low = starts[done]
            upto = max(int(np.searchsorted(ends, low + _BLOCK, "right")), done + 1)
            part, high = slice(done, upto), ends[upto - 1]
            if high - low > _BLOCK:  # one word longer than a block
                h = np.uint64(0)
                for at in range(low, high, _BLOCK):
                    piece = data[at : min(at + _BLOCK, high)].astype(np.uint64) + np.uint64(1)
                    h = mix(np.array([h + (piece * _power(1)[: len(piece)]).sum(dtype=np.uint64)], np.uint64))[0]
                out[done] = h
            else:
                sums = np.zeros(high - low + 1, np.uint64)
                np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * _power(1)[: high - low], dtype=np.uint64, out=sums[1:])
                out[part] = (sums[ends[part] - low] - sums[starts[part] - low]) * _power(-1)[starts[part] - low]
            done = upto
        return mix(out + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    word = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    n = len(starts)
    if not n:
        return np.zeros(0, np.uint64)
    words = _word_hashes(data, starts, ends)
    with np.errstate(over="ignore"):
        if n < SIZE:
            h = (words * _WEIGHTS[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)
        else:
            h = words[: n - SIZE + 1] * _WEIGHTS[0]
            for k in range(1, SIZE):
                h = h + words[k : n - SIZE + 1 + k] * _WEIGHTS[k]
        return np.unique(mix(h))
