"""Removal of byte strings that occur more than once (suffix-array dedup by column-wise construction).

A byte goes if a string of ``min_bytes`` bytes that covers it also starts anywhere else, in another document or
in the same one. Strings are judged on the input; matches never cross documents.

1. Anchors. In every string of ``min_bytes`` bytes the substring of ``GRAM`` bytes with the smallest hash (the
   leftmost of equal ones) is its anchor, so two equal strings have equal anchors at the same place. All anchors
   of a text are found by one sliding minimum, about one in 80 bytes. An anchor's context is what strings with
   this anchor can cover, ``min_bytes - GRAM`` bytes to either side.
2. Only anchors that occur twice matter: a count per anchor, combined before the shuffle, and one join.
3. Contexts that are equal as a whole repeat throughout; those of one text are found with its anchors, and only
   one of them goes on. Of the others, and one of each of the equal ones, the
   bytes are read, and the contexts are dealt by anchor into shards of bounded size.
4. In a shard all contexts are aligned at their anchors and built column by column from the last one: each round
   inserts one symbol of every context, sorts the contexts by (symbol, order of the round before) and updates
   the common prefix with the predecessor, 1 + the minimum over the stretch between the two in the order before.
   The symbols in the order of a round are its column of the collection's Burrows-Wheeler transform, by which
   the next round sorts. As equal strings are aligned, suffixes of different columns need no comparison, so only
   one column of order and prefixes is kept at a time, in place of a file for each symbol. A common prefix of
   ``min_bytes`` with a neighbour marks a repeated string.
   Anchors with more than ``most_contexts`` different contexts are resolved by counting the hashes of their
   strings over all executors instead: exact too, and without a shard of unbounded size.
5. The marked stretches are united per document.

Null texts count as empty. Every row is a text of its own: repeated rows repeat each other, and one doc_id on different
texts, or no doc_id, makes no difference. Texts under ``min_bytes`` bytes lose nothing. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenolith.llm.common import fresh, materialise, mix64, pick, with_row_ids

GRAM = 40
#: Windows handled at once; a longer text is taken in pieces that overlap by a window.
CHUNK = 1 << 20
#: Contexts in a shard of step 4.
SHARD = 20_000
_ODD = np.uint64(0xC2B2AE3D27D4EB4F)
_BACK = np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))


class _Powers:
    """Powers of the hash's base and of its inverse, made once per process."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 1 << 14)
            cls.up = np.cumprod(np.full(n, _ODD, np.uint64)) * _BACK
            cls.down = np.cumprod(np.full(n, _BACK, np.uint64)) * _ODD
        return cls.up, cls.down


class _Hashes:
    """Hashes of any substrings of some bytes from one running sum."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _Powers.of(len(raw) + 1)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[raw] * up[: len(raw)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * _ODD)

    def grams(self, n: int) -> np.ndarray:
        m = len(self.sums) - n
        return mix64((self.sums[n:] - self.sums[:-n]) * self.down[:m] + np.uint64(n * int(_ODD) % 2**64))


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima within blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(backward[:m], forward[width - 1 : width - 1 + m])


def anchors(raw: np.ndarray, min_bytes: int) -> tuple[np.ndarray, ...]:
    """(hash, context hash, position, bytes of context left of it, bytes right of its end) of all anchors, by position."""
    gram, width = min(GRAM, min_bytes), min_bytes - min(GRAM, min_bytes) + 1
    out = []
    for at in range(0, max(1, len(raw) - min_bytes + 1), CHUNK):
        piece = raw[max(0, at - width) : at + CHUNK + 2 * min_bytes]
        shift = at - max(0, at - width)  # context of the first anchors
        hashes = _Hashes(piece)
        grams = hashes.grams(gram)
        windows = min(CHUNK, len(raw) - min_bytes + 1 - at)
        own = grams[shift : shift + windows + width - 1]
        tagged = (own & ~np.uint64((1 << 21) - 1)) | np.arange(len(own), dtype=np.uint64)
        least = _sliding_minimum(tagged, width)
        found = np.sort(np.unique(least) & np.uint64((1 << 21) - 1)).astype(np.int64) + shift
        position = found + (at - shift)
        left = np.minimum(position, width - 1)
        right = np.minimum(len(raw) - position - gram, width - 1)
        context = hashes.of(found - np.minimum(left, found), np.minimum(found + gram + right, len(piece)))
        out.append((grams[found], mix64(context + left.astype(np.uint64) * _BACK), position, left, right))
    if len(out) == 1:
        return out[0]
    found = [np.concatenate(c) for c in zip(*out)]
    _, first = np.unique(found[2], return_index=True)
    return tuple(c[first] for c in found)


def _within(raw: np.ndarray, uid: int, min_bytes: int) -> list[np.ndarray]:
    """Columns of one text's rows: each context once, with its number of occurrences in the text (``times``).
    What repeats within the text is known here: its stretches are rows with ``times`` 0, from ``position`` to
    ``reach``."""
    anchor, context, position, left, right = anchors(raw, min_bytes)
    order = np.lexsort((context, anchor))
    new = np.concatenate([[True], (np.diff(anchor[order]) != 0) | (np.diff(context[order]) != 0)])
    times = np.diff(np.append(np.flatnonzero(new), len(order)))
    one = order[new]
    again = order[np.repeat(times > 1, times)]
    start, stop = position[again] - left[again], position[again] + min(GRAM, min_bytes) + right[again]
    long = stop - start >= min_bytes
    gone = np.array(united(zip(start[long].tolist(), stop[long].tolist())), np.int64).reshape(-1, 2)
    none = np.zeros(len(gone), np.int64)
    return [np.concatenate(c) for c in (
        (anchor[one].astype(np.int64), none), (context[one].astype(np.int64), none), (np.full(len(one), uid), none + uid),
        (position[one], gone[:, 0]), (left[one] << 16 | right[one], gone[:, 1]), (times, none))]


def _anchor_rows(docs: DataFrame, min_bytes: int) -> DataFrame:
    names = ["anchor", "context", "uid", "position", "reach", "times"]

    def run(batches):
        for batch in batches:
            parts, size = [], 0
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
                if len(raw) < min_bytes:
                    continue
                parts.append(_within(raw, uid, min_bytes))
                size += len(parts[-1][0])
                if size > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=names)
                    parts, size = [], 0
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=names)

    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def aligned_repeats(group: np.ndarray, symbols: np.ndarray, length: int, starts: int) -> np.ndarray:
    """For each row of ``symbols`` (aligned contexts; 0: outside the text) and each of the first ``starts``
    columns: whether ``length`` symbols from there also stand in another row of the same group."""
    rows, columns = symbols.shape
    kind = np.uint8 if length < 256 else np.uint16 if length < 65536 else np.uint32
    group = group.astype(np.uint16 if len(group) < 65536 else np.int64)
    order = np.argsort(group, kind="stable")
    common = np.zeros(rows, kind)
    marks = np.zeros((rows, starts), bool)
    by_column = np.ascontiguousarray(symbols.T)
    for column in range(columns - 1, -1, -1):
        before = np.argsort(by_column[column][order], kind="stable")
        before = before[np.argsort(group[order[before]], kind="stable")]
        moved = order[before]
        symbol, own = by_column[column][moved], group[moved]
        same = np.flatnonzero((own[1:] == own[:-1]) & (symbol[1:] == symbol[:-1]) & (symbol[1:] > 0)) + 1
        lo, hi = before[same - 1] + 1, before[same]
        level = np.frexp(hi - lo + 1)[1] - 1
        prefix = np.zeros(len(same), kind)
        minima = common
        for k in range(int(level.max(initial=-1)) + 1):
            now = level == k
            prefix[now] = np.minimum(minima[lo[now]], minima[hi[now] - (1 << k) + 1])
            minima = np.minimum(minima[: -(1 << k)], minima[1 << k :])
        order, common = moved, np.zeros(rows, kind)
        common[same] = np.minimum(prefix, length - 1) + 1
        if column < starts:
            hit = common >= length
            hit[:-1] |= hit[1:]
            marks[order[hit], column] = True
    return marks


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first column, last column) of every run of marks."""
    edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def _shard(pdf: pd.DataFrame, min_bytes: int) -> pd.DataFrame:
    width = min_bytes - min(GRAM, min_bytes) + 1
    _, group = np.unique(pdf["anchor"].to_numpy(), return_inverse=True)
    symbols = np.zeros((len(pdf), min_bytes + width - 1), np.uint8)
    left = pdf["reach"].to_numpy() >> 16
    for i, (raw, skip) in enumerate(zip(pdf["bytes"], width - 1 - left)):
        symbols[i, skip : skip + len(raw)] = np.frombuffer(raw, np.uint8)
    # bytes of UTF-8 are under 0xFF: one up, and 0 is free for what lies outside the text
    outside = np.arange(symbols.shape[1])[None, :]
    inside = (outside >= (width - 1 - left)[:, None]) & (outside < (width - 1 - left + pdf["bytes"].str.len().to_numpy())[:, None])
    marks = aligned_repeats(group, np.where(inside, symbols + np.uint8(1), np.uint8(0)), min_bytes, width)
    marks[pdf["times"].to_numpy() > 1] = False  # known to repeat as a whole
    row, first, last = _runs(marks)
    at = pdf["position"].to_numpy()[row] - (width - 1)
    return pd.DataFrame({"uid": pdf["uid"].to_numpy()[row], "start": at + first, "stop": at + last + min_bytes})


def _hot(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """The stretches in contexts of very frequent anchors, by counting the hashes of their strings by their place
    at the anchor (as in a shard: two contexts with one string at one place are two occurrences of it)."""
    schema = "anchor long, place long, a long, b long, uid long, start long, times long"

    def strings(batches):
        for batch in batches:
            for row in batch.to_pylist():
                raw = np.frombuffer(row["bytes"], np.uint8)
                if len(raw) < min_bytes:
                    continue
                a = _Hashes(raw).grams(min_bytes)
                b = _Hashes(raw ^ np.uint8(0x55)).grams(min_bytes)
                place = np.arange(len(a)) - (row["reach"] >> 16)
                start = row["position"] + place
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), row["anchor"])), pa.array(place), pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)),
                     pa.array(np.full(len(a), row["uid"])), pa.array(start), pa.array(np.full(len(a), row["times"]))],
                    names=["anchor", "place", "a", "b", "uid", "start", "times"])

    rows = contexts.mapInArrow(strings, schema)
    repeated = rows.groupBy("anchor", "place", "a", "b").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.where("times = 1").join(repeated, ["anchor", "place", "a", "b"]).select("uid", "start", (F.col("start") + min_bytes).alias("stop"))


def repeated_spans(docs: DataFrame, min_bytes: int = 200, most_contexts: int = 50_000) -> DataFrame:
    """uid, spans: for each document that loses bytes the stretches [start, stop) it loses, which may overlap.
    ``docs``: uid, text."""
    gram = min(GRAM, min_bytes)
    found = materialise(_anchor_rows(docs, min_bytes), "anchors")
    rows = found.where("times > 0")
    own = found.where("times = 0").select("uid", F.col("position").alias("start"), F.col("reach").alias("stop"))
    shared = rows.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor")
    rows = materialise(rows.join(shared, "anchor"), "shared-anchors")
    # one of each context, by the smallest place; both packed into one number would not hold all ids
    kinds = rows.groupBy("anchor", "context").agg(
        F.sum("times").alias("times"), F.min(F.struct("uid", "position", "reach")).alias("one"))
    kinds = materialise(kinds.select("anchor", "context", "times", "one.*"), "contexts")
    many = kinds.where("times > 1").select("anchor", "context")
    left, right = F.shiftright("reach", 16), F.col("reach").bitwiseAND(0xFFFF)
    whole = rows.where("times = 1").join(many, ["anchor", "context"]).select(
        "uid", (F.col("position") - left).alias("start"), (F.col("position") + gram + right).alias("stop")
    ).where(F.col("stop") - F.col("start") >= min_bytes)
    differ = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = kinds.join(differ, "anchor").groupBy("uid").agg(
        F.collect_list(F.struct("anchor", "position", "reach", "times", "kinds")).alias("wanted"))

    def cut(batches):
        for batch in batches:
            out, size = [], 0
            for uid, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                raw = text.as_buffer()
                for p in places.as_py():
                    lo, hi = p["position"] - (p["reach"] >> 16), p["position"] + gram + (p["reach"] & 0xFFFF)
                    out.append((uid, p["anchor"], p["position"], p["reach"], p["times"], p["kinds"], raw[lo:hi].to_pybytes()))
                    size += hi - lo
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    names = ["uid", "anchor", "position", "reach", "times", "kinds", "bytes"]
    cut_schema = T.StructType([T.StructField(n, T.BinaryType() if n == "bytes" else T.LongType()) for n in names])
    texts = docs.dropDuplicates(["uid"]).join(wanted, "uid").select("uid", "text", "wanted")
    contexts = materialise(texts.mapInArrow(cut, cut_schema), "context-bytes")
    ordinary = contexts.where(F.col("kinds") <= most_contexts)
    shards = max(1, -(-ordinary.count() // SHARD))
    spans_schema = "uid long, start long, stop long"
    dealt = ordinary.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    partial = dealt.groupBy("shard").applyInPandas(lambda pdf: _shard(pdf, min_bytes), spans_schema)
    spans = own.unionByName(whole).unionByName(partial)
    if not (often := contexts.where(F.col("kinds") > most_contexts)).isEmpty():
        spans = spans.unionByName(_hot(often, min_bytes))
    return materialise(spans, "spans").groupBy("uid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def united(spans) -> list[tuple[int, int]]:
    """Sorted stretches without overlap; touching ones are one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _with_spans(docs: DataFrame, doc_id: str, text: str, min_bytes: int) -> DataFrame:
    """All columns of ``docs`` and, as the last one, the document's spans (null: loses nothing)."""
    pick(docs)
    key, gone = fresh(docs, "__uid"), fresh(docs, "__spans")
    keyed = with_row_ids(docs, key, doc_id, text)
    spans = repeated_spans(keyed.select(F.col(key).alias("uid"), F.col(f"`{text}`").alias("text")), min_bytes)
    found = keyed.join(spans.select(F.col("uid").alias(key), F.col("spans").alias(gone)), key, "left")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], gone)


def _kept(text, spans) -> tuple[bytes, list[tuple[int, int]]]:
    raw = text.as_buffer().to_pybytes() if text.is_valid else b""
    gone = united((s["start"], s["stop"]) for s in spans.as_py()) if spans.is_valid else []
    out, at = [], 0
    for start, stop in gone:
        out.append(raw[at:start])
        at = stop
    return b"".join([*out, raw[at:]]), gone


def repeat_digest(docs: DataFrame, min_bytes: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed stretches of every row."""
    joined = _with_spans(docs.select("doc_id", "text"), "doc_id", "text", min_bytes)

    def run(batches):
        for batch in batches:
            out = []
            for key, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                kept, gone = _kept(text, spans)
                lost = sum(b - a for a, b in gone)
                out.append((key, len(kept) + lost, lost, len(gone), hashlib.sha256(kept).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    kinds = [pa.int64()] * 4 + [pa.string()]
    return joined.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, min_bytes: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; where a cut splits a character its rest goes too.
    All rows stay, with an empty text if nothing is left; null texts stay null."""
    joined = _with_spans(docs, doc_id, text, min_bytes)
    at, last = docs.columns.index(text), len(docs.columns)

    def run(batches):
        for batch in batches:
            texts = [_kept(t, s)[0].decode("utf-8", "ignore") if t.is_valid else None
                     for t, s in zip(batch.column(at), batch.column(last))]
            columns = list(batch.columns)[:last]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:last])

    return joined.mapInArrow(run, docs.schema)
