"""The quality classifier against a plain version: features one by one, dense steps of gradient descent, a softmax."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from phenolith.llm import quality

BUCKETS, DIM, EPOCHS, RATE, SEED = 1 << 10, 16, 6, 4.0, 7
M64 = (1 << 64) - 1


def mixed(x):
    """splitmix64's finaliser on Python integers."""
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M64
    return x ^ (x >> 31)


SALT = [mixed(i * 0xD6E8FEB86659FD93 & M64) | 1 for i in range(1, 17)]


def plain_features(text):
    """Every feature of a text, repeats included, as bucket numbers."""
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    out = [1]
    for k, word in enumerate(words):
        codes = [ord(c) for c in f"<{word}>"]
        out.append(mixed(sum(mixed((c * SALT[0] + i * SALT[1]) & M64) for i, c in enumerate(codes)) & M64) % BUCKETS)
        for n in (3, 4, 5):
            for at in range(len(codes) - n + 1):
                value = n
                for i in range(n):
                    value = (value * SALT[2] + (codes[at + i] + 1) * SALT[3 + i]) & M64
                out.append(mixed(value) % BUCKETS)
        if k and word == words[k - 1]:
            out.append(2)
    return out


def plain_model(rows):
    """The table and layer after training on (text, label) in the given order; shares are kept in single precision."""
    rng = np.random.default_rng(SEED)
    table, layer = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)), np.zeros((2, DIM))
    done = 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            text, label = rows[k]
            counts = np.bincount(plain_features(text), minlength=BUCKETS)
            share = (counts / counts.sum()).astype(np.float32).astype(float)
            rate = RATE * (1 - done / (EPOCHS * len(rows)))
            done += 1
            mean = sum(share[b] * table[b] for b in np.flatnonzero(share))
            e = [math.exp(layer[c] @ mean) for c in (0, 1)]
            error = np.array([e[c] / sum(e) - (label == c) for c in (0, 1)])
            gradient = error[0] * layer[0] + error[1] * layer[1]
            for c in (0, 1):
                layer[c] -= rate * error[c] * mean
            table -= rate * np.outer(share, gradient)
    return table, layer


def plain_score(text, table, layer):
    features = plain_features(text)
    mean = sum(table[b] for b in features) / len(features)
    e = [math.exp(layer[c] @ mean) for c in (0, 1)]
    return e[1] / sum(e)


@pytest.fixture(scope="module")
def sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    return docs, labels


def test_features_and_scores_of_a_plain_version(spark, sample):
    docs, labels = sample
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    marks = sorted({(r.doc_id, r.quality) for r in labels.collect() if r.quality in (0, 1) and r.doc_id in texts
                    and zlib.crc32(str(r.doc_id).encode()) % 5})
    table, layer = plain_model([(texts[i], label) for i, label in marks])
    model = quality.train(docs, labels, buckets=BUCKETS)
    assert np.allclose(model.weights, table @ (layer[1] - layer[0]), rtol=0, atol=1e-9)
    odd = [None, "", " ", "a", "a a a", "Ünï \U0001F600", "tab\tand\nline\r\nend", "x" * 300, "two  spaces"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*odd, *list(texts.values())[:50]])], "doc_id long, text string")
    for r in quality.score(rows, model).collect():
        assert abs(r.score - plain_score(r.text, table, layer)) < 1e-9


def test_sparse_features_hold_every_feature():
    texts = [None, "", "a", "a a a b", "Ünï \U0001F600 ünï", "one\ttwo\nthree one", "long " * 40]
    for text, (ids, shares) in zip(texts, quality.sparse_features(pa.array(texts, pa.string()), BUCKETS)):
        counts = np.bincount(plain_features(text), minlength=BUCKETS)
        assert ids.tolist() == np.flatnonzero(counts).tolist()
        assert np.array_equal(shares, (counts[ids] / counts.sum()).astype(np.float32))
