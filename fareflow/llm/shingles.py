"""Sets of five-word shingles as 64-bit hashes, and their MinHash signatures."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from fareflow.llm.common import words

SIZE = 5
MEMO = 100_000
#: Shingles that are hashed at a time: bounds the memory of a long text.
BLOCK = 4096

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_memo: dict[bytes, int] = {}


def _word_hashes(found: list[bytes]) -> np.ndarray:
    if len(_memo) > MEMO:
        _memo.clear()
    try:
        return np.fromiter(map(_memo.__getitem__, found), np.uint64, len(found))
    except KeyError:
        for word in found:
            if word not in _memo:
                _memo[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(_memo.__getitem__, found), np.uint64, len(found))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingles of the words, A-Z lower-cased; of under five words, all as one."""
    found = [w.lower() for w in words(text)] if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = _word_hashes(found)
    width = min(SIZE, len(found))
    total = np.full(len(found) - width + 1, width, np.uint64)
    for i in range(width):
        total = total * _MULTIPLIER + hashes[i : len(found) - width + 1 + i]
    return np.unique(_mixed(total))


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that name the set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class MinHash:
    """``size`` minima of a set under as many hash functions, as little-endian unsigned 32-bit integers."""

    def __init__(self, size: int, seed: int = 1):
        random = np.random.RandomState(seed)
        draw = lambda: random.randint(0, 2**32, (size, 1), np.uint64)
        self.factor = (draw() << np.uint64(32) | draw()) | np.uint64(1)
        self.offset = draw() << np.uint64(32) | draw()

    def signature(self, shingles: np.ndarray) -> bytes:
        least = None
        for at in range(0, len(shingles), BLOCK):
            hashed = self.factor * shingles[at : at + BLOCK]
            hashed += self.offset
            block = hashed.min(axis=1)
            least = block if least is None else np.minimum(least, block)
        return (least >> np.uint64(32)).astype("<u4").tobytes()
