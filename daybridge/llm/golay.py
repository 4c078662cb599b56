"""Fuzzy keys from the binary Golay code [23, 12, 7].

The code is perfect: each 23-bit word has exactly one codeword within three bits. A word three bits
off has five more codewords four bits off, and the six error patterns part the positions, so two
words that differ in two bits or fewer always have a codeword within four bits in common.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

# Fixed value: generator polynomial of the code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
LENGTH, CHECK_BITS = 23, 11


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@cache
def fuzzy_keys(bits: int) -> np.ndarray:
    """For each segment of so many bits (23 at most) the 12-bit indices of the codewords near it.

    A row has one or six indices, then -1. Shorter segments are words that begin with zeros.
    """
    columns = [_remainder(1 << b) for b in range(LENGTH)]
    errors: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            syndrome = 0
            for b in places:
                syndrome ^= columns[b]
            errors[syndrome].append(sum(1 << b for b in places))
    near = np.full((1 << CHECK_BITS, 6), -1, np.int32)
    for syndrome, patterns in enumerate(errors):
        near[syndrome, :len(patterns)] = patterns
    words = np.arange(1 << bits, dtype=np.int32)
    syndromes = np.zeros(len(words), np.int32)
    for b in range(bits):
        syndromes ^= (words >> b & 1) * columns[b]
    patterns = near[syndromes]
    return np.where(patterns < 0, -1, (words[:, None] ^ patterns) >> CHECK_BITS).astype(np.int16)
