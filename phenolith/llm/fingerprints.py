"""Document fingerprints: one-permutation MinHash with optimal densification, packed to low-order bits.

A fingerprint is the lowest 8 bits of ``bins`` coordinates as a hex string; two fingerprints agree by chance in
a share c = 2**-8 of them, so the likeness is (agreeing share - c) / (1 - c), not under 0. Sets are k-word
shingles (five words unless stated; fewer words: the whole sequence is the one shingle). A text without words
has the fingerprint "-", like only to itself. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from phenolith.llm.common import materialise, pick
from phenolith.llm.sketches import one_permutation
from phenolith.llm.words import shingles

BINS, WORDS, NONE = 256, 5, "-"
_CHANCE = 1 / 256


def fingerprint(text: str, bins: int = BINS, words: int = WORDS) -> str:
    own = shingles(text.encode("utf-8", "surrogatepass"), words)
    return one_permutation(own, bins).astype(np.uint8).tobytes().hex() if len(own) else NONE


def likeness(a: str, b: str) -> float:
    if a == NONE or b == NONE:
        return float(a == b)
    x, y = np.frombuffer(bytes.fromhex(a), np.uint8), np.frombuffer(bytes.fromhex(b), np.uint8)
    share = np.count_nonzero(x == y) / len(x)
    return max(0.0, (share - _CHANCE) / (1 - _CHANCE))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bins: int = BINS, words: int = WORDS) -> DataFrame:
    """doc_id, fingerprint of every row; null texts count as empty."""

    def run(batches):
        for batch in batches:
            prints = [fingerprint(t.as_py() or "", bins, words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    return pick(docs, doc_id=doc_id, text=text).mapInArrow(run, "doc_id long, fingerprint string")


def half_replaced(text: str, other: str) -> str:
    """``text`` with its last floor(n/2) characters replaced by the first as many of ``other``."""
    n = len(text) // 2
    return text[: len(text) - n] + other[:n]


_COLUMNS = [("doc_id", pa.int64(), "long"), ("n_chars", pa.int64(), "long"), ("edited_sha256", pa.string(), "string"),
            ("fingerprint", pa.string(), "string"), ("edited_fingerprint", pa.string(), "string"),
            ("near_edited", pa.float64(), "double"), ("near_next", pa.float64(), "double")]


_HEX = ("edited_sha256", "fingerprint", "edited_fingerprint")


def _packed(columns: list[str]) -> list:
    """Hex columns as bytes, half as long on disk."""
    return [F.unhex(F.when(F.col(c) != NONE, F.col(c)).otherwise(F.col(c).substr(1, 0))).alias(c) if c in _HEX else F.col(c) for c in columns]


def _hexed(columns: list[str]) -> list:
    none = lambda c: F.when(F.octet_length(c) == 0, F.lit(NONE)).otherwise(F.lower(F.hex(c)))
    return [none(c).alias(c) if c in _HEX else F.col(c) for c in columns]


def _compared(key, text: str, own: str, following: str, next_print: str) -> tuple:
    edited = half_replaced(text, following)
    changed = fingerprint(edited)
    return (key, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own, changed,
            likeness(own, changed), likeness(own, next_print))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint against that of its edited form and of the next document by doc_id (after the
    last: the first; null ids first; equal ids in text order; a lone document is its own next).

    Texts are range-partitioned by doc_id and streamed in order. Only the first and last text of a partition
    need a neighbour from another task: these, two for each partition, are written and joined."""
    docs = pick(docs, doc_id="doc_id", text="text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def stream(batches):
        part, held, n = TaskContext.get().partitionId(), None, 0
        empty = (None,) * len(_COLUMNS)
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = fingerprint(text)
                if held is None:
                    out.append((*empty, part, "first", key, text))
                else:
                    out.append((*_compared(*held, text, own), part, None, None, None))
                held = (key, text, own)
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
        if held is not None:
            out = [(*empty, part, "last", held[0], held[1])]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    names = [n for n, _, _ in _COLUMNS] + ["part", "edge", "edge_id", "edge_text"]
    kinds = [k for _, k, _ in _COLUMNS] + [pa.int32(), pa.string(), pa.int64(), pa.string()]
    own_schema = ", ".join(f"{n} {s}" for n, _, s in _COLUMNS)
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(stream, f"{own_schema}, part int, edge string, edge_id long, edge_text string")
    rows = materialise(rows.select(*_packed(rows.columns)), "compared")
    rows = rows.select(*_hexed(rows.columns))
    first = rows.where("edge = 'first'").select(F.col("part").alias("to"), F.col("edge_text").alias("following"))
    # one row for each partition that holds rows
    parts = first.select("to").withColumn("part", F.lag("to").over(W.orderBy("to")))
    parts = parts.withColumn("part", F.coalesce("part", F.max("to").over(W.partitionBy())))
    edges = rows.where("edge = 'last'").select("part", "edge_id", "edge_text").join(parts, "part").join(first, "to")

    def close(batches):
        for batch in batches:
            out = [_compared(k, t, fingerprint(t), f, fingerprint(f)) for k, t, f in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names[: len(_COLUMNS)])

    closed = edges.select("edge_id", "edge_text", "following").mapInArrow(close, own_schema)
    return rows.where("edge is null").select(*[n for n, _, _ in _COLUMNS]).unionByName(closed)
