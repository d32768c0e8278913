"""The perfect binary Golay code of length 23, as keys for words that nearly agree.

Every 23-bit word lies within three bits of exactly one codeword.  A word's keys are the codewords it decodes to, itself
or with any one bit turned: one key if it lies within two bits of its codeword, else six.  If two words differ in at
most two bits, the word between them decodes to a key of both, so they share a key.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS, CHECK_BITS, KEYS = 23, 11, 6
GENERATOR = 0b101011100011  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _remainder(word: int) -> int:
    for at in range(BITS - 1, CHECK_BITS - 1, -1):
        if word >> at & 1:
            word ^= GENERATOR << (at - CHECK_BITS)
    return word


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the lower 12 and of the upper 11 bits, and for each syndrome the patterns that lead to the keys."""
    low = np.array([_remainder(x) for x in range(1 << 12)], dtype=np.uint32)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], dtype=np.uint32)
    leader = np.zeros(1 << CHECK_BITS, dtype=np.uint32)
    for n in range(4):
        for where in combinations(range(BITS), n):
            pattern = sum(1 << at for at in where)
            leader[_remainder(pattern)] = pattern
    single = [(1 << at, _remainder(1 << at)) for at in range(BITS)]
    patterns = np.zeros((1 << CHECK_BITS, KEYS), dtype=np.uint32)
    for syndrome in range(1 << CHECK_BITS):
        near = {int(leader[syndrome]), *(bit ^ int(leader[syndrome ^ s]) for bit, s in single)}
        assert len(near) in (1, KEYS)
        patterns[syndrome] = (sorted(near) * KEYS)[:KEYS]
    return low, high, patterns


def keys(words: np.ndarray) -> np.ndarray:
    """``(n, 6)`` codeword indices of 12 bits; a word with one key has it six times."""
    low, high, patterns = tables()
    words = words.astype(np.uint32)
    syndrome = low[words & np.uint32(0xFFF)] ^ high[words >> np.uint32(12)]
    return (words[:, None] ^ patterns[syndrome]) >> np.uint32(CHECK_BITS)
