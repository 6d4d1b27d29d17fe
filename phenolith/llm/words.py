"""Hashes of words and word shingles, vectorised over whole texts.

A word is a run of anything but ASCII white space, A-Z folded. Its 64-bit hash is a polynomial over its
UTF-8 bytes (each byte first mapped to a random 64-bit value), mixed at the end together with its length.
"""

from __future__ import annotations

import numpy as np

from phenolith.llm.common import mix64

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_BYTES[65:91] = _BYTES[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes hashed at once; a longer text is cut at white space.
CHUNK = 1 << 16
_POWERS = np.cumprod(np.full(CHUNK, _ODD, np.uint64)) * _INVERSE
_BACK = np.cumprod(np.full(CHUNK, _INVERSE, np.uint64)) * _ODD


def _hash(raw: np.ndarray) -> np.ndarray:
    """Word hashes of up to CHUNK bytes, in order."""
    space = _SPACE[raw]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[raw] * _POWERS[: len(raw)])])
    return mix64((sums[ends] - sums[starts]) * _BACK[starts] + (ends - starts).astype(np.uint64))


def word_hashes(raw: bytes) -> np.ndarray:
    """Hash of each word of a UTF-8 text, in order (uint64)."""
    data = np.frombuffer(raw, np.uint8)
    if len(data) <= CHUNK:
        return _hash(data)
    out, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        if end < len(data) and not _SPACE[data[end]]:
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # a word longer than a chunk: its pieces' hashes are folded into one
                stop = np.flatnonzero(_SPACE[data[at:]])
                stop = at + int(stop[0]) if len(stop) else len(data)
                value = np.uint64(stop - at)
                for k in range(at, stop, CHUNK):
                    value = mix64(np.array([value]) * _ODD + _hash(data[k : min(k + CHUNK, stop)]))[0]
                out.append(np.array([value], np.uint64))
                at = stop
                continue
        out.append(_hash(data[at:end]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


_ORDER = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def shingles(raw: bytes, k: int) -> np.ndarray:
    """The set of k-word shingles as sorted distinct 64-bit hashes. With fewer words the whole sequence is the
    one shingle; without words the set is empty."""
    words = word_hashes(raw)
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total += mix64(words[i : i + n] * _ORDER[i] + np.uint64(i))
    total = np.sort(mix64(total))
    return total[np.concatenate([[True], total[1:] != total[:-1]])]
