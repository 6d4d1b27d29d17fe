"""Best-fit packing of documents into sequences of at most ``capacity`` tokens (best-two-fit).

A document is its token ids and one end id; only a longer one is cut, into pieces of ``capacity``. A bin is
filled greedily with the longest unpacked pieces that fit; then its smallest piece gives way to the two
unpacked pieces that together fill the gap it leaves more tightly, if there are such.

The choice of a bin needs only how many pieces of each length are left, at most ``capacity`` numbers however
many documents there are. So the driver packs lengths, not documents: it repeats a bin as long as its pieces
last, which gives a short list of bin patterns, and the executors then place each piece by its rank among
the pieces of its length. No shard packs on its own, so no shard leaves a half-empty rest.

Null texts count as empty (a piece with the end id alone); repeated rows are packed once each; an empty table
gives no rows. Ties: among equal lengths the place goes by partition of the scan and order in it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from phenolith.llm.common import materialise, pick
from phenolith.llm.tokens import encode_batch


def best_two_fit(counts: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Packs ``counts[length]`` pieces of each length. Returns segments, ordered by length and rank: the
    pieces of ``length`` with rank ``base`` to ``base + size - 1`` go ``each`` to a bin, from bin ``bin`` on,
    the first of a bin at ``offset``."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not in 1..{capacity}")
        left[length] = n
    lengths = np.arange(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    out: list[tuple[int, int, int, int, int, int]] = []
    bins = 0
    while left.any():
        longest = np.maximum.accumulate(np.where(left > 0, lengths, 0))
        used: dict[int, int] = {}
        spare, gap = left, capacity
        while (length := int(longest[gap])) > 0:
            n = min(gap // length, int(spare[length]))
            used[length] = used.get(length, 0) + n
            gap -= n * length
            if spare is left:
                spare = left.copy()
            spare[length] -= n
            longest = np.maximum.accumulate(np.where(spare > 0, lengths, 0))
        if gap:
            smallest = min(used)
            pair = _tighter_pair(spare, longest, gap + smallest, smallest)
            if pair:
                used[smallest] -= 1
                for x in pair:
                    used[x] = used.get(x, 0) + 1
                used = {k: n for k, n in used.items() if n}
        times = min(int(left[k]) // n for k, n in used.items())
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            out.append((length, int(taken[length]), times * n, n, bins, offset))
            taken[length] += times * n
            left[length] -= times * n
            offset += n * length
        bins += times
    columns = np.array(sorted(out), np.int64).reshape(-1, 6).T
    return dict(zip(("length", "base", "size", "each", "bin", "offset"), columns))


def _tighter_pair(spare: np.ndarray, longest: np.ndarray, room: int, smallest: int) -> tuple[int, int] | None:
    """The two unpacked pieces with the largest sum in (smallest, room], or None."""
    a = np.flatnonzero(spare[: room + 1] > 0)
    if not len(a):
        return None
    b = longest[room - a]
    twin = (b == a) & (spare[a] < 2)
    b = np.where(twin, longest[np.maximum(np.minimum(a, room - a) - 1, 0)], b)
    total = np.where(b > 0, a + b, 0)
    best = int(np.argmax(total))
    return (int(a[best]), int(b[best])) if total[best] > smallest else None


_PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("nth", T.LongType()),
])
_IDS = T.StructField("ids", T.BinaryType())


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keep_ids: bool) -> DataFrame:
    """Pieces of every document with the crc32 of their ids; ``nth`` numbers the pieces of a length within a
    task (``part``). ``ids``: little-endian unsigned 32-bit, where ``keep_ids`` asks for them."""

    def cut(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows, ids, bounds in encode_batch(tokenizer, batch, "text"):
                out = []
                for i, key in enumerate(rows.column(0).to_pylist()):
                    own = np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, at in enumerate(range(0, len(own), capacity)):
                        piece = own[at : at + capacity]
                        raw = piece.tobytes()
                        out.append((key, k, at, len(piece), zlib.crc32(raw), part, int(seen[len(piece)]))
                                   + ((raw,) if keep_ids else ()))
                        seen[len(piece)] += 1
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=schema.names)

    schema = T.StructType(_PIECES.fields + ([_IDS] if keep_ids else []))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    return docs.mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, doc_id: str = "doc_id",
         text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    and, with ``keep_ids``, ids. ``assemble`` makes the sequences of it."""
    pieces = materialise(cut_pieces(pick(docs, doc_id=doc_id, text=text), tokenizer, end_id, capacity, keep_ids), "pieces")
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    # at most ``capacity`` rows
    counts = {r.length: r.n for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_two_fit(counts, capacity)
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    ranked = (
        pieces.join(per_part.select("part", "length", F.coalesce(before, F.lit(0)).alias("before")), ["part", "length"])
        .withColumn("nth", F.col("before") + F.col("nth"))
        .drop("part", "before")
    )
    columns = [c for c in pieces.columns if c not in ("part", "nth")]

    def place(batches):
        # segments of one length lie together, by rank: one sorted key finds a piece's segment
        reach = int(plan["base"].max(initial=0) + plan["size"].max(initial=0)) + 1
        if reach * (capacity + 1) >= 2**63:
            raise OverflowError("too many pieces of one length for 64-bit keys")
        keys = plan["length"] * reach + plan["base"]
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            nth = batch.column(batch.schema.get_field_index("nth")).to_numpy()
            at = np.searchsorted(keys, length * reach + nth, side="right") - 1
            row, slot = np.divmod(nth - plan["base"][at], plan["each"][at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in columns]
                + [pa.array(plan["bin"][at] + row), pa.array(plan["offset"][at] + slot * length)],
                names=[*columns, "sequence_id", "offset"])

    schema = T.StructType([f for f in pieces.schema.fields if f.name in columns]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)


def assemble(placed: DataFrame) -> DataFrame:
    """The sequences: sequence_id, length, doc_ids (in order), ids (binary, little-endian unsigned 32-bit).
    A group holds one sequence, so at most ``capacity`` tokens."""
    items = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), items.alias("items")).select(
        "sequence_id", "length", F.col("items.doc_id").alias("doc_ids"),
        F.aggregate("items.ids", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x)).alias("ids"))
