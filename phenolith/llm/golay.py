"""The perfect binary Golay code of 23 bits: every word is within 3 bits of exactly one of 4096 codewords.

Two words that differ in one bit have a codeword in common among those within 4 bits of the one and the nearest of the
other, which makes codeword numbers of 12 bits usable as fuzzy keys. Shorter words are padded with zero bits.
"""

from __future__ import annotations

import functools

import numpy as np

#: Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 (a fixed value).
GENERATOR = 0b110001110101
BITS = 23


@functools.cache
def nearest() -> np.ndarray:
    """The number of the nearest codeword of each 23-bit word."""
    codes = np.zeros(1 << 12, np.uint32)
    numbers = np.arange(1 << 12, dtype=np.uint32)
    for bit in range(12):
        codes ^= np.where(numbers >> bit & 1, np.uint32(GENERATOR << bit), np.uint32(0))
    table = np.zeros(1 << BITS, np.uint16)
    bits = [1 << i for i in range(BITS)]
    errors = [0] + bits
    errors += [a | b for i, a in enumerate(bits) for b in bits[:i]]
    errors += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
    for error in errors:
        table[codes ^ np.uint32(error)] = numbers
    return table


@functools.cache
def within_four() -> tuple[np.ndarray, np.ndarray]:
    """For each 16-bit word: the numbers of the codewords within 4 bits (rows of 6, the nearest first), and how many
    there are: 1, or 6 where the nearest is 3 bits away."""
    near = nearest()
    words = np.arange(1 << 16, dtype=np.uint32)
    around = np.stack([near[words], *(near[words ^ np.uint32(1 << i)] for i in range(BITS))], 1)
    own = around[:, :1]
    rest = np.sort(np.where(around == own, np.uint16(0xFFFF), around), 1)
    first = np.concatenate([np.ones((len(rest), 1), bool), rest[:, 1:] != rest[:, :-1]], 1) & (rest != 0xFFFF)
    counts = first.sum(1)
    out = np.zeros((len(words), 1 + int(counts.max())), np.uint16)
    out[:, 0] = own[:, 0]
    row, column = np.nonzero(first)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    out[row, 1 + place] = rest[row, column]
    return out, 1 + counts
