"""Keys of 23-bit words from the binary Golay code: words at most two bits apart share one."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, MESSAGE = 23, 12
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, a generator of the code.
GENERATOR = 0b110001110101


def remainder(word: int) -> int:
    for bit in range(LENGTH - 1, LENGTH - MESSAGE - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << bit - (LENGTH - MESSAGE)
    return word


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes by byte and value, error patterns by syndrome, and how many of these hold.

    The code is perfect: each word has one codeword within three bits. A word exactly three bits off
    has five more codewords at four bits, and all six count as near it.
    """
    by_byte = np.array([[remainder(v << 8 * b) if v << 8 * b < 1 << LENGTH else 0 for v in range(256)] for b in range(3)], np.int32)
    single = [1 << b for b in range(LENGTH)]
    one = [remainder(x) for x in single]
    found: dict[int, list[int]] = {}
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            syndrome = pattern = 0
            for b in bits:
                syndrome ^= one[b]
                pattern |= single[b]
            if weight < 4 or found[syndrome][0].bit_count() == 3:
                found.setdefault(syndrome, []).append(pattern)
    patterns = np.zeros((1 << LENGTH - MESSAGE, 6), np.int32)
    for syndrome, errors in found.items():
        patterns[syndrome, : len(errors)] = errors
    return by_byte, patterns, np.array([len(found[s]) for s in range(len(patterns))], np.int64)


def indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all codewords near each word, and the position of the word that each is for."""
    by_byte, patterns, count = tables()
    words = words.astype(np.int32)
    syndrome = by_byte[0][words & 255] ^ by_byte[1][words >> 8 & 255] ^ by_byte[2][words >> 16 & 255]
    many = count[syndrome]
    of = np.repeat(np.arange(len(words)), many)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    return (words[of] ^ patterns[syndrome[of], nth]) >> LENGTH - MESSAGE, of
