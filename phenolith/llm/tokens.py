"""Token ids of whole texts by a public tokenizer file, word by word with a cache.

A word-level BPE that drops white space gives a text the ids of its white-space pieces in order, so each
distinct piece is encoded once by the ``tokenizers`` library and looked up afterwards. Pieces are cut at
spaces and line ends, and between a Latin letter and common punctuation (a boundary of the tokenizer's own
word pattern, which never joins letters with these marks); ASCII capitals are folded, as the tokenizer
does. Texts with ``<|`` could hold special tokens and are encoded whole. ``tests/llm`` holds the result
against encoding whole texts.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from phenolith.llm.common import slices

_SPLIT = r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,!?;:*#$%&])"


class WordEncoder:
    """Encodes arrays of texts; keeps the ids of up to ``cache_words`` distinct pieces."""

    def __init__(self, path: str, cache_words: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache_words = cache_words
        self.index: dict[str, int] = {"": 0}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 16, np.int64)
        self.lens = np.zeros(1 << 16, np.int64)

    def _room(self, name: str, n: int) -> np.ndarray:
        a = getattr(self, name)
        if n > len(a):
            a = np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])
            setattr(self, name, a)
        return a

    def _codes(self, words: list[str]) -> np.ndarray:
        """The place of each distinct word's ids; words beyond the cache hold for this call only."""
        get = self.index.get
        codes = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(codes < 0)
        if not len(new):
            return codes
        known, at = len(self.index), self.used
        encoded = self.tokenizer.encode_batch_fast([words[i] for i in new], add_special_tokens=False)
        found = [e.ids for e in encoded]
        lens = np.fromiter(map(len, found), np.int64, len(found))
        total = int(lens.sum())
        flat = self._room("ids", at + total)
        flat[at : at + total] = np.fromiter((i for x in found for i in x), np.uint32, total)
        self._room("starts", known + len(new))[known : known + len(new)] = at + np.cumsum(lens) - lens
        self._room("lens", known + len(new))[known : known + len(new)] = lens
        codes[new] = known + np.arange(len(new))
        keep = max(0, min(len(new), self.cache_words - known))
        for k, i in enumerate(new[:keep]):
            self.index[words[i]] = known + k
        self.used = at + int(lens[:keep].sum())
        return codes

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat = pc.replace_substring(texts, "\n", " ")
        flat = pc.replace_substring_regex(pc.ascii_lower(flat), _SPLIT, r"\1 \2")
        parts = pc.split_pattern(flat, " ")
        words = parts.flatten().dictionary_encode()
        codes = self._codes(words.dictionary.to_pylist())[words.indices.to_numpy()]
        bounds = parts.offsets.to_numpy().astype(np.int64)
        starts, lens = self.starts[codes], self.lens[codes]
        ends = np.cumsum(lens)
        at = np.concatenate([[0], ends])
        total = int(at[-1])
        ids = self.ids[np.repeat(starts - at[:-1], lens) + np.arange(total)]
        return ids, at[bounds - bounds[0]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) in text order, and each text's bounds within them; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        if not special.any():
            return self._pieces(texts)
        out, bounds = [], [0]
        for i, text in enumerate(texts):
            if special[i]:
                ids = np.array(self.tokenizer.encode(text.as_py(), add_special_tokens=False).ids, np.uint32)
            else:
                ids, _ = self._pieces(texts.slice(i, 1))
            out.append(ids)
            bounds.append(bounds[-1] + len(ids))
        return np.concatenate(out), np.array(bounds, np.int64)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process; reused workers keep their cache."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encode_batch(path: str, batch: pa.RecordBatch, text: str):
    """Yields (rows of the batch, ids, bounds) by slices of bounded size."""
    column = batch.column(batch.schema.get_field_index(text))
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64)
    for lo, hi in slices(lengths):
        ids, bounds = encoder(path).encode(column.slice(lo, hi - lo))
        yield batch.slice(lo, hi - lo), ids, bounds
