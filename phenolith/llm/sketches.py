"""MinHash sketches of sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from phenolith.llm.common import mix64

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64((1 << 40) - 1)


def _salts(n: int, seed: int) -> np.ndarray:
    return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(0x8CB92BA72F3D8DD7))


def fast_similarity_sketch(values: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Fast similarity sketching: in round i below ``size`` every element is hashed to a bin and a value, and a
    bin keeps the smallest (round, value); it stops after the first round that leaves no bin empty. From round
    ``size`` on all elements go to bin i - ``size``, so every coordinate is filled after 2 * ``size`` rounds.
    Two sets agree in a coordinate with the probability of their Jaccard similarity, and the number of
    agreements is concentrated as for independent coordinates. ``values`` must not be empty."""
    out = np.full(size, _EMPTY)
    salts = _salts(2 * size, seed)
    i = 0
    while i < size:
        many = min(size - i, max(1, 1024 // len(values)))
        h = mix64(values[None, :] ^ salts[i : i + many, None])
        bins = ((h >> np.uint64(40)) * np.uint64(size)) >> np.uint64(24)
        tagged = (np.arange(i, i + many, dtype=np.uint64)[:, None] << np.uint64(40)) | (h & _LOW)
        np.minimum.at(out, bins.ravel().astype(np.int64), tagged.ravel())
        i += many
        if (out != _EMPTY).all():
            return out
    for b in np.flatnonzero(out == _EMPTY):
        i = size + int(b)
        out[b] = (np.uint64(i) << np.uint64(40)) | (mix64(values ^ salts[i]) & _LOW).min()
    return out


def band_hashes(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash for each band of ``rows`` coordinates."""
    own = sketch[: bands * rows].reshape(bands, rows)
    value = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + own[:, k])
    return value


def one_permutation(values: np.ndarray, bins: int, seed: int = 2) -> np.ndarray:
    """One-permutation MinHash: each element is hashed once, the high bits choose its bin and a bin keeps its
    smallest hash. An empty bin takes the value of a bin drawn by hashing (bin, attempt) until it meets one
    that was not empty (optimal densification). ``values`` must not be empty."""
    h = mix64(values ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
    out = np.full(bins, _EMPTY)
    np.minimum.at(out, (((h >> np.uint64(40)) * np.uint64(bins)) >> np.uint64(24)).astype(np.int64), h & _LOW)
    filled = out != _EMPTY
    empty = np.flatnonzero(~filled)
    attempt = 0
    while len(empty):
        drawn = mix64((empty.astype(np.uint64) << np.uint64(20)) + np.uint64(attempt + (seed << 52)))
        source = ((drawn >> np.uint64(40)) * np.uint64(bins) >> np.uint64(24)).astype(np.int64)
        met = filled[source]
        out[empty[met]] = out[source[met]]
        empty = empty[~met]
        attempt += 1
    return out
