"""Cross-tokenizer alignment by lockstep merging.

A text is encoded by two tokenizers: A, a byte-level BPE (``tokenizers`` file), of space + text, and B, a sentencepiece BPE
with byte fallback that adds the space itself. Tokens are byte ranges; where an A and a B token end at the same byte is a
cut, and every A-B pair whose ranges overlap is a link.

``lockstep`` merges the token ends of many units at once: one state vector holds each unit's A and B pointer, a step emits
each unit's current link and, where both tokens end, its cut, advances the pointers whose token ends first, and drops
finished units from the vector. Units are the distinct words of a batch (a space and what follows it up to the next one)
and whole texts where words do not stand alone. Both tokenizers always cut at a single space (A starts a token there, and no
piece of B holds the space mark behind another character), so a text's tokens, links and cuts are those of its words in
order. A text with a space at its edges or next to other white space is one unit, as is one where the bytes of a word's
tokens differ from the word. ``tests/llm`` holds this against encoding and merging whole texts.

Counts over the corpus: each slice of a task (``SLICE`` characters, or one longer text) lists its distinct linked id pairs with
the number of its texts that hold them; these lists are summed by pair, and the sums joined back to the lists. Texts keep
places in their slice's list instead of pairs, so that no row for each text and pair is ever shuffled.

Texts that are null or empty, or whose tokens' bytes do not give space + text (in B: texts with U+2581), have no tokens: empty
arrays, zeros and ''. Very long texts are one slice in one task, in memory linear in their length. Ties: all id pairs of the
highest count of an A id are best. Each row counts as a document of its own, so repeated rows and repeated or null doc_ids each
get their row. Empty tables give empty tables, extra columns of the input don't matter.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.llm.common import materialise, pick, slices

#: Characters of text in a slice; a longer text is a slice of its own.
SLICE = 6_000_000
#: Distinct words whose tokens a worker keeps.
MOST_WORDS = 300_000

#: White space as the pattern of tokenizer A has it; a space beside it, or at an edge of the text, joins no words.
_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_JOINED = rf"^ | $|  |{_SPACE} {_SPACE}"


def lockstep(bounds_a: np.ndarray, ends_a: np.ndarray, bounds_b: np.ndarray, ends_b: np.ndarray):
    """Merges the token ends of all units at once. ``bounds_x``: where each unit's tokens start in ``ends_x`` (one more at the
    end); ``ends_x``: the byte after each token, counted within its unit; in each unit both end at the same byte.
    Returns links (unit, A token, B token) and cuts (unit, A token, B token: the last ones before the cut), each by unit and
    place; tokens are numbered through all units."""
    unit = np.flatnonzero(np.diff(bounds_a) > 0)
    a, b = bounds_a[unit].copy(), bounds_b[unit].copy()
    stop = bounds_a[unit + 1]
    links, cuts = [], []
    while len(unit):
        links.append(np.stack([unit, a, b]))
        left, right = ends_a[a], ends_b[b]
        both = left == right
        if both.any():
            cuts.append(np.stack([unit[both], a[both], b[both]]))
        a = a + (left <= right)
        b = b + (right <= left)
        going = a < stop
        if not going.all():
            unit, a, b, stop = unit[going], a[going], b[going], stop[going]
    none = np.zeros((3, 0), np.int64)
    links, cuts = (np.concatenate([none, *x], axis=1) for x in (links, cuts))
    return tuple(x[:, np.argsort(x[0], kind="stable")] for x in (links, cuts))


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The numbers of all ranges (start, length), one after another."""
    at = np.cumsum(lens) - lens
    return np.repeat(starts - at, lens) + np.arange(int(lens.sum()))


def _bounds(lens: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)


class Units:
    """Tokens, links and groups of units of text, in one flat array each; ``bounds`` arrays have one more element."""

    def __init__(self, ids_a, bounds_a, ids_b, bounds_b, ends_a, ends_b, whole: np.ndarray):
        self.ids_a, self.bounds_a, self.ids_b, self.bounds_b, self.whole = ids_a, bounds_a, ids_b, bounds_b, whole
        links, cuts = lockstep(bounds_a, ends_a, bounds_b, ends_b)
        n = len(whole)
        self.ends_a, self.ends_b = ends_a, ends_b
        self.links, self.cuts = links, cuts
        self.n_a, self.n_b = np.diff(bounds_a), np.diff(bounds_b)
        self.n_links, self.n_groups = np.bincount(links[0], minlength=n), np.bincount(cuts[0], minlength=n)
        self.groups = self._group_texts(cuts)
        pair = ids_a[links[1]].astype(np.int64) << 32 | ids_b[links[2]].astype(np.int64)
        order = np.lexsort((pair, links[0]))
        pair, of = pair[order], links[0][order]
        first = np.ones(len(pair), bool)
        first[1:] = (pair[1:] != pair[:-1]) | (of[1:] != of[:-1])
        at = np.flatnonzero(first)
        self.pairs, self.times = pair[at], np.diff(np.append(at, len(pair)))
        self.pair_bounds = _bounds(np.bincount(of[at], minlength=n))

    def _group_texts(self, cuts: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each unit."""
        sides = []
        for ids, at in ((self.ids_a, cuts[1]), (self.ids_b, cuts[2])):
            last = np.zeros(len(ids) + 1, np.int64)
            last[at + 1] = 1
            sides.append((ids, np.cumsum(last)[:-1], last[1:].astype(bool)))
        ids = np.concatenate([s[0] for s in sides]).astype(np.int64)
        group = np.concatenate([s[1] for s in sides])
        ends = np.concatenate([s[2] for s in sides])
        side = np.repeat([0, 1], [len(s[0]) for s in sides])
        order = np.argsort(group * 2 + side, kind="stable")
        ids, side, ends = ids[order], side[order], ends[order]
        of_unit = self.n_a + self.n_b
        mark = np.where(ends, np.where(side == 0, 2, 3), 1)
        mark[(np.cumsum(of_unit) - 1)[of_unit > 0]] = 0  # nothing behind a unit's last token
        signs = pa.array(["", ",", "|", ";"])
        parts = pc.binary_join_element_wise(pa.array(ids).cast(pa.string()), signs.take(pa.array(mark)), "")
        lists = pa.ListArray.from_arrays(pa.array(_bounds(of_unit).astype(np.int32)), parts)
        return pc.binary_join(lists, "").cast(pa.binary()).to_pylist()


class Aligner:
    """Both tokenizers, and the tokens of the distinct words met so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = self._bytes_of_a(path_a)
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.lens_a, self.lens_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))

    def _bytes_of_a(self, path: str) -> list[bytes]:
        """The bytes of each id: byte-level BPE writes printable bytes as themselves, the rest from U+0100 on."""
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        char = {chr(c): c for c in plain}
        char.update({chr(0x100 + i): c for i, c in enumerate(c for c in range(256) if c not in set(plain))})
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        out = [b""] * (max([self.a.get_vocab_size() - 1, *vocabulary.values()]) + 1)
        for entry, i in vocabulary.items():
            out[i] = bytes(char[c] for c in entry)
        return out

    def units(self, texts: list[str]) -> Units:
        """Encodes each of ``texts`` (behind a space) whole; those whose bytes differ get no tokens."""
        found_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        found_b = self.b.encode(texts, num_threads=1) if texts else []
        whole = np.zeros(len(texts), bool)
        for i, (text, x, y) in enumerate(zip(texts, found_a, found_b)):
            raw = b" " + text.encode()
            whole[i] = b"".join([self.bytes_a[t] for t in x]) == raw and b"".join([self.bytes_b[t] for t in y]) == raw
            if not whole[i]:
                found_a[i], found_b[i] = [], []
        flat = []
        for found, lens in ((found_a, self.lens_a), (found_b, self.lens_b)):
            n = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter((t for x in found for t in x), np.int32, int(n.sum()))
            bounds = _bounds(n)
            ends = np.cumsum(lens[ids])
            before = np.concatenate([[0], ends])[bounds[:-1]]
            flat += [ids, bounds, ends - np.repeat(before, n)]
        ids_a, bounds_a, ends_a, ids_b, bounds_b, ends_b = flat
        return Units(ids_a, bounds_a, ids_b, bounds_b, ends_a, ends_b, whole)


class Words:
    """Units of the distinct words of a worker, kept over batches up to ``MOST_WORDS``."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.numbers = np.zeros((5, 0), np.int64)  # n_a, n_b, n_groups, n_links, whole
        self.groups: list[bytes] = []
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pair_bounds = np.zeros(1, np.int64)

    def places(self, words: list[str]) -> np.ndarray:
        """The place of each of the distinct ``words``; places hold until the next call."""
        if len(self.index) > MOST_WORDS:
            self.forget()
        get = self.index.get
        at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            own = [words[i] for i in new]
            u = self.aligner.units(own)
            known = len(self.index)
            self.index.update(zip(own, range(known, known + len(own))))
            at[new] = known + np.arange(len(new))
            self.numbers = np.concatenate([self.numbers, np.stack([u.n_a, u.n_b, u.n_groups, u.n_links, u.whole.astype(np.int64)])], axis=1)
            self.groups += u.groups
            self.pair_bounds = np.concatenate([self.pair_bounds, self.pair_bounds[-1] + u.pair_bounds[1:]])
            self.pairs, self.times = np.concatenate([self.pairs, u.pairs]), np.concatenate([self.times, u.times])
        return at


_WORDS: dict[tuple[str, str], Words] = {}


def words_of(path_a: str, path_b: str) -> Words:
    """One table of words per worker process and pair of tokenizers."""
    if (path_a, path_b) not in _WORDS:
        _WORDS[path_a, path_b] = Words(Aligner(path_a, path_b))
    return _WORDS[path_a, path_b]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between bounds; empty ranges give 0."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


def _planes(x: np.ndarray) -> bytes:
    """Small numbers as bytes, all lowest bytes first: compresses well."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class Slice:
    """The alignment of some texts: totals, group digests, and linked id pairs by places in one list."""

    def __init__(self, texts: pa.Array, table: Words):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        alone = empty | pc.match_substring_regex(texts, _JOINED).to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(texts, " ")
        coded = parts.flatten().dictionary_encode()
        bounds = parts.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        # words of texts that are one unit are not looked up
        of = np.repeat(np.arange(n), np.diff(bounds))
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        used = np.zeros(len(coded.dictionary), bool)
        used[codes[~alone[of]]] = True
        used = np.flatnonzero(used)
        place = np.full(len(coded.dictionary), -1, np.int64)
        place[used] = table.places(coded.dictionary.take(pa.array(used)).to_pylist())
        at = place[codes]
        alone |= _sums((at >= 0) & (table.numbers[4][np.maximum(at, 0)] == 0) if len(table.index) else np.zeros(len(at), np.int64), bounds) > 0
        one = np.flatnonzero(alone & ~empty)
        units = table.aligner.units([texts[int(i)].as_py() for i in one])
        in_words = ~alone[of]
        word_at, word_of = at[in_words], of[in_words]
        word_bounds = _bounds(np.bincount(word_of, minlength=n))
        self.numbers = np.stack([_sums(table.numbers[k][word_at], word_bounds) for k in range(4)])
        self.numbers[:, one] = np.stack([units.n_a, units.n_b, units.n_groups, units.n_links])
        texts_of = [[] if a else word_at[lo:hi].tolist() for a, lo, hi in zip(alone, word_bounds[:-1], word_bounds[1:])]
        groups = [b";".join([table.groups[k] for k in own]) for own in texts_of]
        for i, own in zip(one.tolist(), units.groups):
            groups[i] = own
        self.digests = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]

        # distinct (text, word) with their numbers, then (text, pair)
        size = max(1, len(table.groups))
        distinct, times = np.unique(word_of * size + word_at, return_counts=True)
        text, word = distinct // size, distinct % size
        lens = np.diff(table.pair_bounds)[word]
        at = _ranges(table.pair_bounds[word], lens)
        of_unit = np.repeat(one, np.diff(units.pair_bounds))
        pair = np.concatenate([table.pairs[at], units.pairs])
        times = np.concatenate([np.repeat(times, lens) * table.times[at], units.times])
        text = np.concatenate([np.repeat(text, lens), of_unit])
        self.pairs, local = np.unique(pair, return_inverse=True)
        key = text * max(1, len(self.pairs)) + local
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
        self.times = np.add.reduceat(times, first) if len(first) else np.zeros(0, np.int64)
        self.local = key[first] % max(1, len(self.pairs))
        self.bounds = _bounds(np.bincount(key[first] // max(1, len(self.pairs)), minlength=n))
        self.texts_with = np.bincount(self.local, minlength=len(self.pairs))


_ROW = pa.schema([
    ("slice", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("places", pa.binary()), ("times", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("texts", pa.list_(pa.int64()))])
_ROW_DDL = ("slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, "
            "times binary, pairs array<long>, texts array<long>")


def _sliced(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per text, and one per slice with its list of pairs (rows with ``pairs``)."""

    def run(batches):
        context, count = TaskContext.get(), 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in slices(lengths, SLICE):
                s = Slice(batch.column(1).slice(lo, hi - lo), words_of(path_a, path_b))
                n, number = hi - lo, (context.partitionId() if context else 0) << 32 | count
                count += 1
                places, times = [], []
                for a, b in zip(s.bounds[:-1], s.bounds[1:]):
                    places.append(_planes(np.diff(s.local[a:b], prepend=0)))
                    times.append(_planes(s.times[a:b]))
                columns = [
                    pa.array(np.full(n + 1, number)), pa.concat_arrays([batch.column(0).slice(lo, n), pa.nulls(1, pa.int64())]),
                    *(pa.array(np.append(s.numbers[k], 0)) for k in range(4)), pa.array([*s.digests, None], pa.string()),
                    pa.array([*places, None], pa.binary()), pa.array([*times, None], pa.binary()),
                    pa.array([None] * n + [s.pairs], _ROW.field("pairs").type), pa.array([None] * n + [s.texts_with], _ROW.field("texts").type)]
                yield pa.RecordBatch.from_arrays(columns, schema=_ROW)

    return docs.mapInArrow(run, _ROW_DDL)


_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _counted(texts: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """The totals of a slice's texts over the counts of its pairs."""
    n, best = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
    n[counts["place"]], best[counts["place"]] = counts["n"], counts["best"]
    n_best, count_sum = [], []
    for places, times in zip(texts["places"], texts["times"]):
        at, m = np.cumsum(_from_planes(places)), _from_planes(times)
        n_best.append(int((m * best[at]).sum()))
        count_sum.append(int((m * n[at]).sum()))
    return texts[["doc_id", "n_a", "n_b", "n_groups", "n_links"]].assign(
        doc_id=texts["doc_id"].astype("Int64"), n_best=np.array(n_best, np.int64), count_sum=np.array(count_sum, np.int64), groups_sha256=texts["groups_sha256"])


def alignment_digest(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose id pair has its A id's highest count of
    texts), count_sum (of all links), groups_sha256."""
    rows = materialise(_sliced(pick(docs, doc_id=doc_id, text=text), path_a, path_b), "alignment")
    lists = rows.where("pairs is not null").select(
        "slice", F.posexplode(F.arrays_zip("pairs", "texts")).alias("place", "x")).select(
        "slice", "place", F.col("x.pairs").alias("pair"), F.col("x.texts").alias("texts"))
    counts = materialise(lists.groupBy("pair").agg(F.sum("texts").alias("n")).withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("top"))
    counts = counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best"))
    answers = lists.join(counts, "pair").select("slice", "place", "n", "best")
    texts = rows.where("pairs is null").select(F.col("slice").alias("of"), *rows.columns[1:9])
    return texts.groupBy("of").cogroup(answers.groupBy("slice")).applyInPandas(_counted, _OUT)


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids_a, ids_b, cuts and links of every row: cuts are (A tokens, B tokens) counted up to each common end, links the
    (A place, B place) of tokens that overlap, both in order. Whole texts are merged in lockstep, a slice at a time."""
    pairs = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def nested(units: Units, of: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
        inner = pa.StructArray.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        return pa.ListArray.from_arrays(pa.array(_bounds(np.bincount(of, minlength=len(units.whole))).astype(np.int32)), inner).cast(pairs)

    def run(batches):
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in slices(lengths, SLICE):
                texts = pc.fill_null(batch.column(1).slice(lo, hi - lo), "").to_pylist()
                units = words_of(path_a, path_b).aligner.units(texts)
                # the empty text has no tokens, though A would give it the space
                of, a, b = units.cuts
                cuts = nested(units, of, a - units.bounds_a[of] + 1, b - units.bounds_b[of] + 1)
                of, a, b = units.links
                links = nested(units, of, a - units.bounds_a[of], b - units.bounds_b[of])
                ids = [pa.ListArray.from_arrays(pa.array(x.astype(np.int32)), pa.array(y, pa.int32()))
                       for x, y in ((units.bounds_a, units.ids_a), (units.bounds_b, units.ids_b))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *ids, cuts, links],
                                                 names=["doc_id", "ids_a", "ids_b", "cuts", "links"])

    return pick(docs, doc_id=doc_id, text=text).mapInArrow(
        run, "doc_id long, ids_a array<int>, ids_b array<int>, cuts array<struct<a: long, b: long>>, links array<struct<a: long, b: long>>")
