"""The binary Golay code of length 23: nearby codewords of a word, by table.

The code is perfect: any 23-bit word is within three bits of exactly one
codeword. A word at distance three has five more codewords at distance four;
nearer words have none. ``nearby`` gives the indices (12 bits) of all codewords
within four bits, so two words that differ in one bit always share one: the
codeword nearest to the first is within four bits of the second.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
# x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
GENERATOR = 0b101011100011


def remainders(words: np.ndarray) -> np.ndarray:
    """Words modulo the generator: zero for codewords."""
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - CHECKS), 0)
    return rest


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """For each remainder the error of weight three at most, and what leads from the
    nearest codeword to the five at distance four (-1 where there are none)."""
    errors = np.zeros(1 << CHECKS, np.int64)
    for weight in (1, 2, 3):
        masks = np.array([sum(1 << b for b in bits) for bits in combinations(range(LENGTH), weight)])
        errors[remainders(masks)] = masks
    info = np.arange(1 << (LENGTH - CHECKS)) << CHECKS
    codewords = info | remainders(info)
    sevens = codewords[np.bitwise_count(codewords) == 7]
    further = np.full((1 << CHECKS, 5), -1, np.int64)
    for rest in np.flatnonzero(np.bitwise_count(errors) == 3):
        further[rest] = sevens[(sevens & errors[rest]) == errors[rest]]
    return errors, further


def nearby(words: np.ndarray) -> np.ndarray:
    """Six columns of codeword indices for each word, -1 where there are fewer."""
    errors, further = tables()
    rest = remainders(words)
    nearest = words ^ errors[rest]
    others = np.where(further[rest] < 0, -1, nearest[:, None] ^ further[rest])
    found = np.concatenate([nearest[:, None], others], axis=1)
    return np.where(found < 0, -1, found >> CHECKS)
