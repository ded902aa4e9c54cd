"""The perfect binary Golay code of 23 bits as a fuzzy hash.

Every 23-bit word lies within three bits of exactly one codeword, whose twelve
information bits are its index. A word at full distance three also gets the indices of
the five codewords at distance four. Two words that differ in at most two bits then
always share an index.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

BITS, INFORMATION, CHECK = 23, 12, 11
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _remainder(word: int) -> int:
    for i in range(BITS - 1, CHECK - 1, -1):
        if word >> i & 1:
            word ^= GENERATOR << (i - CHECK)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the error pattern; the index changes that lead to each codeword in
    reach (the first is 0), and how many there are. At last the syndrome of each bit."""
    of_bit = [_remainder(1 << i) for i in range(BITS)]
    error = np.zeros(1 << CHECK, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(BITS), weight):
            s = 0
            for b in bits:
                s ^= of_bit[b]
            error[s] = sum(1 << b for b in bits)
    words = [i << CHECK | _remainder(i << CHECK) for i in range(1 << INFORMATION)]
    sevens = [w for w in words if w.bit_count() == 7]
    change = np.zeros((1 << CHECK, 6), np.int64)
    count = np.ones(1 << CHECK, np.int64)
    for s, e in enumerate(error.tolist()):
        if e.bit_count() == 3:
            near = [w >> CHECK for w in sevens if w & e == e]
            change[s, 1 : 1 + len(near)] = near
            count[s] += len(near)
    return error, change, count


ERROR, CHANGE, COUNT = _tables()


def syndromes(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64)
    for i in range(BITS - 1, CHECK - 1, -1):
        rest = rest ^ ((rest >> i & 1) * (GENERATOR << (i - CHECK)))
    return rest


def indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words: six index columns, and how many of them count in each row."""
    s = syndromes(words)
    own = (words.astype(np.int64) ^ ERROR[s]) >> CHECK
    return own[:, None] ^ CHANGE[s], COUNT[s]
