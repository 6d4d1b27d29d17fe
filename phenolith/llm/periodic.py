"""Periodic runs of words: recursive frequency splitting, then a scan over lags.

A run is a stretch of consecutive words with smallest period q and at least ``max(least, times * q)`` words that no
neighbouring word extends keeping period q. Each of its words stands in it at least ``times`` times, so

1. words that stand fewer than ``times`` times in a segment belong to no run within it: they split the segment, pieces of
   fewer than ``least`` words go, and the rest is split again by its own counts until nothing changes. Splitting only
   rules words out; it ends after ``ROUNDS`` rounds at the latest, as the scan is exact on any segment;
2. the segments left are scanned lag by lag. A run of period q covers two whole neighbouring blocks of q words that start
   at a multiple of q, and these are equal: at each lag only the blocks at multiples of the lag are compared (n/q of
   them, by polynomial hashes), which is n log n for all lags. Hits are extended word by word on the words themselves.
   Hits inside a run whose period divides the lag are that run again and go.

Words are runs of anything but ASCII white space. Null and empty texts, texts without words and texts with fewer than
``least`` words have no runs; very long texts are one row in one task, in memory linear in their words. Runs may overlap,
and all are returned, ordered by start, then period: there are no ties. Repeated rows each get their row, null doc_ids
stay as they are, empty tables give empty tables, and extra columns of the input don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolith.llm.common import mix64, pick, slices

#: Rounds of splitting after which the segments are scanned as they are.
ROUNDS = 64
#: Pairs of blocks compared at once.
PAIRS = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_WHITE = r"[\x20\x09-\x0D]+"


def split_by_frequency(words: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Segments (start, stop) of at least ``least`` words that hold every run; ``words`` are small integers."""
    done: list[tuple[int, int]] = []
    todo = [(0, len(words))] if len(words) >= least else []
    for _ in range(ROUNDS):
        if not todo:
            break
        starts, stops = np.array(todo, np.int64).T
        lens = stops - starts
        at = np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
        segment = np.repeat(np.arange(len(todo)), lens)
        _, inverse, counts = np.unique(segment * (int(words.max()) + 1) + words[at], return_inverse=True, return_counts=True)
        rare = counts[inverse] < times
        broken = np.zeros(len(todo), bool)
        broken[segment[rare]] = True
        done += [s for s, b in zip(todo, broken) if not b]
        # stretches without rare words in the segments that have some
        keep = ~rare & broken[segment]
        joined = np.zeros(len(at), bool)
        joined[1:] = keep[1:] & keep[:-1] & (segment[1:] == segment[:-1])
        first = np.flatnonzero(keep & ~joined)
        last = np.flatnonzero(keep & ~np.append(joined[1:], False))
        long = last - first + 1 >= least
        todo = list(zip(at[first[long]].tolist(), (at[last[long]] + 1).tolist()))
    return sorted(done + todo)


def _first_difference(words: np.ndarray, i: int, q: int, step: int) -> int:
    """The first place from ``i`` on, in the direction of ``step``, where words q apart differ (or the text ends)."""
    size = 64
    while True:
        if step > 0:
            end = min(i + size, len(words) - q)
            same = words[i:end] == words[i + q : end + q]
            if not same.all():
                return i + int(np.argmin(same))
            if end == len(words) - q:
                return end
            i = end
        else:
            start = max(0, i - size + 1)
            same = words[start : i + 1] == words[start + q : i + 1 + q]
            if not same.all():
                return i - int(np.argmin(same[::-1]))
            if start == 0:
                return -1
            i = start - 1
        size *= 2


def scan_lags(words: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in ``words``."""
    n = len(words)
    top = n // times
    found: list[tuple[int, int, int]] = []
    spans: dict[tuple[int, int], list[int]] = {}

    def add(start: int, stop: int, q: int) -> None:
        own = spans.setdefault((start, stop), [])
        if stop - start >= max(least, times * q) and not any(q % p == 0 for p in own):
            own.append(q)
            found.append((start, stop - start, q))

    # lags below ``small``: the shortest run need not hold blocks enough, and all places are compared
    small = min(top + 1, -(-least // times))
    for q in range(1, small):
        same = np.concatenate([[False], words[:-q] == words[q:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        starts, stops = edge[::2], edge[1::2] + q
        for i in np.flatnonzero(stops - starts >= least):
            add(int(starts[i]), int(stops[i]), q)
    if top < small:
        return found
    powers = np.cumprod(np.full(n, _ODD, np.uint64))
    value = mix64(words.astype(np.uint64) * _ODD + np.uint64(1))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(value * powers)])
    low = small
    while low <= top:
        # no lag of [low, high) is a multiple of another one of it
        high = min(2 * low, top + 1)
        hits_q, hits_b, q = [], [], low
        while q < high:
            lags = np.arange(q, high, dtype=np.int64)
            blocks = n // lags - 1
            many = max(1, int(np.searchsorted(np.cumsum(blocks), PAIRS, side="right")))
            lags, blocks = lags[:many], blocks[:many]
            lag = np.repeat(lags, blocks)
            b = (np.arange(len(lag)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * lag
            equal = (sums[b + lag] - sums[b]) * powers[lag - 1] == sums[b + 2 * lag] - sums[b + lag]
            hits_q.append(lag[equal])
            hits_b.append(b[equal])
            q += many
        lag, b = np.concatenate(hits_q), np.concatenate(hits_b)
        order = np.argsort(b, kind="stable")
        lag, b = lag[order], b[order]
        known = np.zeros(len(b), bool)
        for start, length, p in found:
            if length >= 2 * low:
                lo, hi = np.searchsorted(b, [start, start + length - 2 * low + 1])
                known[lo:hi] |= (lag[lo:hi] % p == 0) & (b[lo:hi] + 2 * lag[lo:hi] <= start + length)
        lag, b = lag[~known], b[~known]
        order = np.lexsort((b, lag))
        lag, b = lag[order], b[order]
        i = 0
        while i < len(b):
            own, at = int(lag[i]), int(b[i])
            stop = _first_difference(words, at, own, 1) + own
            start = _first_difference(words, at, own, -1) + 1
            add(start, stop, own)
            # the next hit that this stretch does not hold
            j = int(np.searchsorted(lag, own, side="right"))
            i = max(i + 1, i + int(np.searchsorted(b[i:j], stop - 2 * own, side="right")))
        low = high
    return found


def word_runs(words: np.ndarray, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start, then period."""
    out = []
    for lo, hi in split_by_frequency(words, least, times):
        out += [(lo + start, length, q) for start, length, q in scan_lags(words[lo:hi], least, times)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(words: pa.Array, runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by one space."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return " ".join(words.filter(pa.array(np.cumsum(change[:-1]) == 0)).to_pylist())


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, runs (array of start, length, period in words; by start, then period), collapsed (the text's words without
    those that a run repeats, joined by one space) of every row."""

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in slices(lengths):
                parts = pc.split_pattern_regex(texts.slice(lo, hi - lo), _WHITE)
                flat = parts.flatten()
                coded = flat.dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                empty = coded.dictionary.index("").as_py()
                bounds = parts.offsets.to_numpy().astype(np.int64)
                bounds -= bounds[0]
                runs, texts_out = [], []
                for a, b in zip(bounds[:-1], bounds[1:]):
                    # white space at either end leaves an empty part there
                    a, b = a + (b > a and codes[a] == empty), b - (b > a and codes[b - 1] == empty)
                    b = max(a, b)
                    own = word_runs(codes[a:b], least, times)
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
                    words = flat.slice(a, b - a)
                    texts_out.append(_collapsed(words, own) if own else " ".join(words.to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(runs, _RUNS), pa.array(texts_out, pa.string())],
                    names=["doc_id", "runs", "collapsed"])

    return pick(docs, doc_id=doc_id, text=text).mapInArrow(
        run, "doc_id long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text: in a document with h = crc32(decimal doc_id) and h % 10 = 0 the words from a = g % n on repeat the
    first p = 1 + floor((n - a) / (3 + g % 8)) of them (g = floor(h / 10), n words). Texts of rows without a doc_id stay."""
    docs = pick(docs, doc_id="doc_id", text="text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", _WHITE), lambda w: w != "")
    chosen = docs.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    a = F.when(n > 0, g % n)
    p = 1 + F.floor((n - a) / (3 + g % 8))
    places = chosen.withColumn("n", n).withColumn("a", a).withColumn("p", p)

    def place(i: Column) -> Column:
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))

    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
                                       lambda i: F.get("words", place(i).cast("int"))), " ")
    return places.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def run_digest(docs: DataFrame) -> DataFrame:
    """One row per document: its runs after planting, the run of the greatest exponent, and digests."""
    found = periodic_runs(with_planted_tails(docs))

    def above(x: Column, y: Column) -> Column:
        """x comes before y: greater exponent (compared exactly), smaller start, smaller period."""
        left, right = x["length"] * y["period"], y["length"] * x["period"]
        return (left > right) | ((left == right) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))

    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda x, y: F.when(above(y, x), y).otherwise(x))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.lit(1000).cast("long") * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))
