"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors, one for each feature of its text: every word, every character
n-gram of a word (with its boundary marks), every repetition of the word before it, and one end mark. The
features are hashed into ``buckets`` rows of an embedding table; the average goes through a linear layer and
a softmax. Embeddings and layer are trained together by stochastic gradient descent in numpy.

Training takes a bounded sample of the labelled rows: per label the ``sample_per_label`` rows with the smallest
hash of the id. Their hashed features come to the driver (at most ``sample_per_label`` sparse rows per label);
all documents are scored on the executors, by whole texts. As the softmax reads a linear function of the
average, a bucket needs one number for scoring, the two logits' difference.

Null and empty texts have the end mark alone; with no usable labels every score is 0.5; null ids count as not
held out; labels other than 0 and 1 are not used; repeated rows are scored one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenolith.llm.common import mix64, pick, slices

NGRAMS = (3, 4, 5)
_MARK = {"end": 1, "repeat": 2}
_SALT = mix64(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _word_features(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of each word's own hash and its character n-grams."""
    marked = [f"<{w}>" for w in words]
    lens = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), lens)
    mask = np.uint64(buckets - 1)
    first = np.cumsum(lens) - lens
    # the whole word: a sum over its characters and their places
    place = (np.arange(len(codes)) - first[owner]).astype(np.uint64)
    spread = mix64(codes * _SALT[0] + place * _SALT[1])
    owners, found = [np.arange(len(marked))], [mix64(np.add.reduceat(spread, first)) & mask] if len(marked) else [np.zeros(0, np.uint64)]
    for n in NGRAMS:
        if len(codes) < n:
            continue
        m = len(codes) - n + 1
        value = np.full(m, np.uint64(n), np.uint64)
        for i in range(n):
            value = value * _SALT[2] + (codes[i : i + m] + np.uint64(1)) * _SALT[3 + i]
        whole = owner[:m] == owner[n - 1 :]
        owners.append(owner[:m][whole])
        found.append(mix64(value[whole]) & mask)
    return np.concatenate(owners), np.concatenate(found).astype(np.int64)


def _split(texts: pa.Array):
    """(distinct words, number of the word at each place, bounds of the texts in places)."""
    flat = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.string()), ""), "[\t\n\r]", " ")
    parts = pc.split_pattern(flat, " ")
    flat_words = parts.flatten()
    kept = pc.not_equal(flat_words, "").to_numpy(zero_copy_only=False)
    words = flat_words.filter(pa.array(kept)).dictionary_encode()
    bounds = parts.offsets.to_numpy().astype(np.int64)
    before = np.concatenate([[0], np.cumsum(kept)])
    return words.dictionary.to_pylist(), words.indices.to_numpy().astype(np.int64), before[bounds - bounds[0]]


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeats(places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    same = np.concatenate([[False], places[1:] == places[:-1]]) if len(places) else np.zeros(0, bool)
    same[bounds[:-1][bounds[:-1] < len(places)]] = False
    return same


@dataclass
class Model:
    """``weights[bucket]``: the difference of the two logits that a document made of this feature alone has."""

    weights: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        buckets = len(self.weights)
        words, places, bounds = _split(texts)
        owner, bucket = _word_features(words, buckets)
        value = np.bincount(owner, self.weights[bucket], len(words))
        count = np.bincount(owner, minlength=len(words))
        same = _repeats(places, bounds)
        total = _per_text(value[places] + same * self.weights[_MARK["repeat"]], bounds) + self.weights[_MARK["end"]]
        n = _per_text(count[places] + same, bounds) + 1
        return 1 / (1 + np.exp(-np.clip(total / n, -500, 500)))


def sparse_features(texts: pa.Array, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct buckets and their shares of all its features."""
    words, places, bounds = _split(texts)
    owner, bucket = _word_features(words, buckets)
    order = np.argsort(owner, kind="stable")
    bucket = bucket[order]
    ends = np.cumsum(np.bincount(owner, minlength=len(words)))
    same = _repeats(places, bounds)
    out = []
    for i in range(len(bounds) - 1):
        own = places[bounds[i] : bounds[i + 1]]
        used, times = np.unique(own, return_counts=True)
        n = ends[used] - np.concatenate([[0], ends])[used]
        at = np.repeat(ends[used] - n, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        ids = np.concatenate([bucket[at], [_MARK["end"], _MARK["repeat"]]])
        counts = np.concatenate([np.repeat(times, n), [1, int(same[bounds[i] : bounds[i + 1]].sum())]])
        distinct, where = np.unique(ids, return_inverse=True)
        share = np.bincount(where, counts)
        distinct, share = distinct[share > 0], share[share > 0]
        out.append((distinct.astype(np.int32), (share / share.sum()).astype(np.float32)))
    return out


def sgd(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int, dim: int = 16, epochs: int = 6,
        rate: float = 4.0, seed: int = 7) -> Model:
    """Trains embeddings and output layer on (buckets, shares, label) rows, one document a step, with a
    linearly falling learning rate."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (buckets, dim))
    layer = np.zeros((2, dim))
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            ids, share, label = rows[k]
            step = rate * (1 - done / steps)
            done += 1
            mean = share @ table[ids]
            logits = layer @ mean
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ layer
            layer -= step * p[:, None] * mean
            table[ids] -= (step * share)[:, None] * back
    return Model(table @ (layer[1] - layer[0]))


def train(docs: DataFrame, labels: DataFrame, sample_per_label: int = 1500, buckets: int = 1 << 17,
          doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    marked = pick(labels, doc_id=doc_id, label=label).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    # two bounded top lists: at most 2 * sample_per_label rows
    chosen = [marked.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_per_label) for v in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])
    # one row of each chosen id, however often it occurs: what is collected below is bounded by the sample
    texts = pick(docs, doc_id=doc_id, text=text).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")).select("doc_id", "x.text", "label")

    def features(batches):
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            for lo, hi in slices(lengths):
                got = sparse_features(batch.column(1).slice(lo, hi - lo), buckets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                     pa.array([i.tobytes() for i, _ in got], pa.binary()), pa.array([s.tobytes() for _, s in got], pa.binary())],
                    names=["doc_id", "label", "ids", "shares"])

    got = texts.mapInArrow(features, "doc_id long, label int, ids binary, shares binary").collect()
    got.sort(key=lambda r: (r.doc_id, r.label, r.ids))  # the sample in an order of its own: reruns agree
    return sgd([(np.frombuffer(r.ids, np.int32), np.frombuffer(r.shares, np.float32).astype(float), r.label) for r in got], buckets)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in the column ``into`` (replaced if there)."""
    pick(docs)
    docs = docs.drop(into)
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)  # buckets * 8 bytes

    def run(batches):
        own = Model(shared.value)
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy()
            found = [own.score(batch.column(at).slice(lo, hi - lo)) for lo, hi in slices(lengths)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(found) if found else [], pa.float64())], names=[*batch.schema.names, into])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
