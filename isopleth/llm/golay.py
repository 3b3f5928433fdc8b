"""The binary Golay code [23, 12, 7] as a fuzzy hash of 23-bit words.

The code is perfect: each word lies within 3 bits of exactly one codeword.  The keys of a
word are the codewords within 4 bits, at most six.  If two words differ in at most
one bit, the codeword nearest to the one lies within 4 bits of the other, so they share a key.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH = 23
CHECK_BITS = 11
#: Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
MOST_KEYS = 6


def syndrome(word: np.ndarray) -> np.ndarray:
    """Remainder by the generator; 0 for codewords."""
    rest = word.astype(np.int64)
    for k in range(LENGTH - 1, CHECK_BITS - 1, -1):
        rest = np.where((rest >> k) & 1, rest ^ (GENERATOR << (k - CHECK_BITS)), rest)
    return rest


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error patterns of weight 4 or less (rows padded by the first), and how many."""
    patterns = np.array([sum(1 << b for b in bits) for w in range(5) for bits in combinations(range(LENGTH), w)])
    by = syndrome(patterns)
    table = np.zeros((1 << CHECK_BITS, MOST_KEYS), np.int64)
    count = np.bincount(by, minlength=1 << CHECK_BITS)
    for s in range(1 << CHECK_BITS):
        own = patterns[by == s]
        table[s] = np.resize(own, MOST_KEYS) if len(own) < MOST_KEYS else own
        table[s, len(own) :] = own[0]
    return table, count


def keys(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) indices of the codewords within 4 bits, and (n, 6) which of them are not padding.

    A codeword is named by its upper 12 bits, which determine it.
    """
    table, count = _tables()
    s = syndrome(word)
    return (word.astype(np.int64)[:, None] ^ table[s]) >> CHECK_BITS, np.arange(MOST_KEYS)[None, :] < count[s][:, None]
