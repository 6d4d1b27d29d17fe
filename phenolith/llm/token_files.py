"""Token-ID output: id arrays in block files with one shared zstandard dictionary.

A dictionary is trained on the serialized id arrays of a bounded sample of documents (``sample_docs``
documents by smallest hash of the id, ``sample_bytes`` of each; only the compression ratio depends on it).
Every document is compressed on its own with it, so one short document is read without its neighbours.

The files, one folder, all written and read by Spark's own Parquet readers and writers:

``dictionary``  dict_hash (sha256 of the bytes), content; one row
``blocks``      part, block, first_doc_id, last_doc_id, first_token (ids of the part before the block),
                dict_hash, id_bytes (2 or 4), doc_ids, n_tokens, offsets (one more than documents: frame i
                is payload[offsets[i]:offsets[i+1]]), payload. Parts ascend, blocks ascend within a part and
                documents within a block, all by doc_id; repeated ids stay side by side.

Null or empty texts give the end id alone; null ids sort first; an empty table gives no blocks.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from phenolith.llm.common import materialise, pick
from phenolith.llm.tokens import encode_batch
from phenolith.session import scratch_path

BLOCK_BYTES = 4_000_000

_FRAMES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("frame", T.BinaryType()),
])
_BLOCKS = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("block", T.IntegerType()),
    T.StructField("first_doc_id", T.LongType()),
    T.StructField("last_doc_id", T.LongType()),
    T.StructField("first_token", T.LongType()),
    T.StructField("dict_hash", T.StringType()),
    T.StructField("id_bytes", T.IntegerType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("n_tokens", T.ArrayType(T.LongType())),
    T.StructField("offsets", T.ArrayType(T.LongType())),
    T.StructField("payload", T.BinaryType()),
])


def _dictionary(content: bytes, kind: str) -> zstandard.ZstdCompressionDict | None:
    if not content:
        return None
    full = kind == "trained"
    return zstandard.ZstdCompressionDict(
        content, dict_type=zstandard.DICT_TYPE_FULLDICT if full else zstandard.DICT_TYPE_RAWCONTENT)


def _serialized(path: str, end_id: int, id_bytes: int):
    """Batches of (doc_id, text) to (doc_id, n_tokens, serialized ids)."""
    kind = np.dtype("<u2" if id_bytes == 2 else "<u4")

    def rows(batch):
        for part, ids, bounds in encode_batch(path, batch, "text"):
            if id_bytes == 2 and len(ids) and int(ids.max()) > 0xFFFF:
                raise ValueError("token ids need id_bytes=4")
            keys = part.column(0).to_pylist()
            for i, key in enumerate(keys):
                own = np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id)).astype(kind)
                yield key, len(own), own.tobytes()

    return rows


def _window(raw: bytes, size: int, step: int) -> bytes:
    """``size`` bytes at a whole id chosen by the array's hash, so that no part of long arrays is preferred."""
    at = zlib.crc32(raw) % ((len(raw) - size) // step + 1) * step if len(raw) > size else 0
    return raw[at : at + size]


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, id_bytes: int, sample_docs: int = 512,
                     sample_bytes: int = 16_384, dict_bytes: int = 65_536) -> tuple[bytes, str]:
    """The dictionary's bytes and kind (trained; raw where the sample is too small to train on; none)."""
    serialize = _serialized(tokenizer, end_id, id_bytes)

    def sample(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"frame": [_window(x, sample_bytes, id_bytes) for _, _, x in serialize(batch)]})

    # ids alone are sorted; their texts (one of each id) are fetched afterwards
    filled = docs.where(F.col("text") != "")
    ids = filled.where("doc_id is not null").select("doc_id", F.xxhash64("doc_id").alias("h")).distinct().orderBy("h", "doc_id").limit(sample_docs)
    chosen = filled.join(F.broadcast(ids.select("doc_id")), "doc_id").groupBy("doc_id").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")).select("doc_id", "x.text")
    got = sorted(bytes(r.frame) for r in chosen.mapInArrow(sample, "frame binary").collect())
    if not got:
        return b"", "none"
    try:
        return zstandard.train_dictionary(dict_bytes, got).as_bytes(), "trained"
    except zstandard.ZstdError:
        raw = b"".join(got)[-dict_bytes:]
        return (raw, "raw") if len(raw) >= 8 else (b"", "none")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id",
                      text: str = "text", id_bytes: int = 2, block_bytes: int = BLOCK_BYTES, level: int = 3) -> None:
    """Encode every whole text of ``docs``, append ``end_id`` and write the files to the folder ``path``."""
    spark = docs.sparkSession
    docs = pick(docs, doc_id=doc_id, text=text)
    content, kind = train_dictionary(docs, tokenizer, end_id, id_bytes)
    digest = hashlib.sha256(content).hexdigest()
    serialize = _serialized(tokenizer, end_id, id_bytes)

    def compress(batches):
        shared = _dictionary(content, kind)
        if shared is not None:
            shared.precompute_compress(level)
        packer = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=False)
        for batch in batches:
            keys, counts, frames = [], [], []
            for key, n, raw in serialize(batch):
                keys.append(key)
                counts.append(n)
                frames.append(packer.compress(raw))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(frames, pa.binary())],
                names=_FRAMES.names)

    # written before the range partitioning, which samples its input and would otherwise encode twice
    frames = materialise(docs.mapInArrow(compress, _FRAMES), "frames")

    def block(batches):
        part, number, before = TaskContext.get().partitionId(), 0, 0
        keys, counts, offsets, payload = [], [], [0], []

        def flush():
            nonlocal number, before, keys, counts, offsets, payload
            ids = [k for k in keys if k is not None]
            row = {"part": part, "block": number, "first_doc_id": min(ids, default=None),
                   "last_doc_id": max(ids, default=None), "first_token": before, "dict_hash": digest,
                   "id_bytes": id_bytes, "doc_ids": keys, "n_tokens": counts, "offsets": offsets,
                   "payload": b"".join(payload)}
            number, before = number + 1, before + sum(counts)
            keys, counts, offsets, payload = [], [], [0], []
            return pa.RecordBatch.from_pylist([row], schema=_ARROW_BLOCKS)

        for batch in batches:
            for key, n, frame in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys.append(key)
                counts.append(n)
                payload.append(frame)
                offsets.append(offsets[-1] + len(frame))
                if offsets[-1] >= block_bytes:
                    yield flush()
        if keys:
            yield flush()

    ordered = frames.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "n_tokens", "frame")
    ordered.mapInArrow(block, _BLOCKS).write.parquet(f"{path}/blocks")
    spark.createDataFrame([(digest, kind, bytearray(content))], "dict_hash string, kind string, content binary") \
        .coalesce(1).write.parquet(f"{path}/dictionary")


_ARROW_BLOCKS = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first_doc_id", pa.int64()), ("last_doc_id", pa.int64()),
    ("first_token", pa.int64()), ("dict_hash", pa.string()), ("id_bytes", pa.int32()),
    ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
    ("payload", pa.binary()),
])


def _read(blocks: DataFrame, path: str, convert, schema: T.StructType, wanted: set | None = None) -> DataFrame:
    """Rows of ``convert(doc_id, start in the part, ids)`` for the documents of ``blocks``."""
    row = blocks.sparkSession.read.parquet(f"{path}/dictionary").first()
    digest, kind, content = row.dict_hash, row.kind, bytes(row.content)
    if hashlib.sha256(content).hexdigest() != digest:
        raise ValueError("the dictionary is not the one the files were written with")

    def read(batches):
        unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(content, kind))
        for batch in batches:
            for i in range(batch.num_rows):
                b = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                if b["dict_hash"] != digest:
                    raise ValueError("a block names another dictionary")
                kind_of = np.dtype("<u2" if b["id_bytes"] == 2 else "<u4")
                out, start = [], b["first_token"]
                for k, key in enumerate(b["doc_ids"]):
                    if wanted is None or key in wanted:
                        raw = unpacker.decompress(b["payload"][b["offsets"][k] : b["offsets"][k + 1]])
                        out.append((b["part"], key, start, *convert(np.frombuffer(raw, kind_of))))
                    start += b["n_tokens"][k]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    full = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("doc_id", T.LongType()),
                         T.StructField("start", T.LongType()), *schema.fields])
    names = full.names
    out = blocks.mapInArrow(_typed(read, full), full)
    return out


def _typed(read, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = to_arrow_schema(schema)

    def cast(batches):
        for b in read(batches):
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.columns, kind)], schema=kind)

    return cast


def _starts(blocks: DataFrame) -> DataFrame:
    """Ids of all parts before each part; one row per part, of which there are as many as shuffle partitions."""
    totals = blocks.groupBy("part").agg(
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), ids."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    rows = _read(blocks, path, lambda ids: (ids.astype(np.int64).tolist(),),
                 T.StructType([T.StructField("ids", T.ArrayType(T.LongType()))]))
    return rows.join(_starts(blocks), "part").select("doc_id", (F.col("part_start") + F.col("start")).alias("start"), "ids")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Some documents: only blocks whose id range holds one are read, only their own frames decompressed."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    near = F.lit(False)
    for i in doc_ids:
        near = near | ((F.col("first_doc_id") <= F.lit(i)) & (F.col("last_doc_id") >= F.lit(i)))
    rows = _read(blocks.where(near), path, lambda ids: (ids.astype(np.int64).tolist(),),
                 T.StructType([T.StructField("ids", T.ArrayType(T.LongType()))]), set(doc_ids))
    return rows.select("doc_id", "ids")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit, from the files."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    rows = _read(blocks, path, lambda ids: (len(ids), zlib.crc32(ids.astype("<u4").tobytes())),
                 T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]))
    return rows.join(_starts(blocks), "part").select(
        "doc_id", (F.col("part_start") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def op4_token_files(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end_id=1)
    return token_digests(spark, path)
