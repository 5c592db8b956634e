"""The binary Golay code [23, 12, 7]: every 23-bit word lies within three bits of exactly one codeword."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
BITS, CHECK = 23, 11


def _remainder(word: int) -> int:
    for k in range(BITS - 1, CHECK - 1, -1):
        if word >> k & 1:
            word ^= GENERATOR << (k - CHECK)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the 4096 heads, and the error of up to three bits for each of the 2048 remainders."""
    heads = np.array([_remainder(h << CHECK) for h in range(1 << (BITS - CHECK))], dtype=np.uint32)
    errors = np.zeros(1 << CHECK, dtype=np.uint32)
    for weight in range(4):
        for bits in combinations(range(BITS), weight):
            e = sum(1 << b for b in bits)
            errors[_remainder(e)] = e
    return heads, errors


def index(words: np.ndarray) -> np.ndarray:
    """Index (0..4095) of the codeword nearest to each word (uint32)."""
    heads, errors = _tables()
    remainder = heads[words >> CHECK] ^ (words & ((1 << CHECK) - 1))
    return (words ^ errors[remainder]) >> CHECK


def near_indices(words: np.ndarray, width: int = BITS) -> np.ndarray:
    """[n, width + 1]: the index of each word and of its neighbours at one bit, among the lowest `width` bits."""
    flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint32)
    return index(words[:, None] ^ flips[None, :])
