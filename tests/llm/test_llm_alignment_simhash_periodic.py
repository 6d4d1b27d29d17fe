"""Cross-tokenizer alignment, SimHash groups and periodic runs against plain versions."""

from __future__ import annotations

import collections
import hashlib
import itertools
import json
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from phenolith.llm import align, golay, periodic, simhash

PATHS = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
SCHEMA = "doc_id long, text string, lang string, slice long, place int, fp string, key long, pairs string, runs int, words string"
LONG = "alpha beta gamma delta " * 700
COPY = " ".join(f"word{i}" for i in range(120))
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def edge_docs(spark):
    texts = [
        (1, COPY), (2, COPY), (3, COPY.replace("word7 ", "changed ")), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, LONG),
        (9, "Ünïcödé " + COPY[100:500] + " \U0001F600 tail"), (10, "<|endoftext|> x <s> <unk> <0x41> 1234"), (10, "other text, same id"),
        (11, "a" * 1000), (12, "b b " * 30), (13, "b  b " * 30), (None, "no id"), (None, COPY), (14, "x" * 70_000 + " y " + "z" * 70_000),
        (15, "a▁b c"), (16, "é ́x \xa0 y  z \n w\n v\x00\x01 \x85q ﻿"), (17, " lead"), (18, "trail "), (19, "ABC abc Éé"),
        (20, "ABC abc Éé"), (21, "a\n\n  b\t c \x1c d"), (90, "x y " * 40), (107, " ".join(f"w{i}" for i in range(300))), (-5, "p q r " * 10),
    ]
    return spark.createDataFrame([(i, t, "en", 1, 2, "f", 3, "p", 4, "w") for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- alignment ---


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(sorted(set(range(256)) - set(plain)))}
    entries = {i: bytes(char[c] for c in e) for e, i in json.load(open(PATHS[0], encoding="utf-8"))["model"]["vocab"].items()}
    return a, b, entries


def plain_alignment(text, tokenizers):
    """(ids a, ids b, cuts, links) of one text, token by token."""
    a, b, entries = tokenizers
    if not text:
        return [], [], [], []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    pieces = [b.id_to_piece(i) for i in ids_b]
    raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
    raw_a = [entries[i] for i in ids_a]
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return [], [], [], []
    spans = [[(end - len(x), end) for x, end in zip(raw, itertools.accumulate(map(len, raw)))] for raw in (raw_a, raw_b)]
    links = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
    ends = [{e: i + 1 for i, (_, e) in enumerate(x)} for x in spans]
    cuts = [(ends[0][e], ends[1][e]) for e in sorted(set(ends[0]) & set(ends[1]))]
    return ids_a, ids_b, cuts, links


def plain_digest(rows, tokenizers):
    found = [plain_alignment(t, tokenizers) for _, t in rows]
    count = collections.Counter()
    for a, b, _, links in found:
        count.update({(a[i], b[j]) for i, j in links})
    top = collections.defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = collections.Counter()
    for (key, _), (a, b, cuts, links) in zip(rows, found):
        groups = ";".join(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])) for (i, j), (k, m) in zip([(0, 0), *cuts], cuts))
        pairs = [(a[i], b[j]) for i, j in links]
        out[key, len(a), len(b), len(cuts), len(links), sum(count[p] == top[p[0]] for p in pairs), sum(count[p] for p in pairs),
            hashlib.sha256(groups.encode()).hexdigest() if a else ""] += 1
    return out


@pytest.mark.parametrize("which", ["docs", "edge_docs", "no_docs"])
def test_alignment_digest(which, request, tokenizers):
    table = request.getfixturevalue(which)
    rows = [(k, t) for k, t in rows_of(table) if not t or len(t) < 20_000]
    kept = table.where("text is null or length(text) < 20000")
    got = collections.Counter(map(tuple, align.alignment_digest(kept, *PATHS).collect()))
    assert got == plain_digest(rows, tokenizers)


def test_alignment_of_long_texts(edge_docs, tokenizers):
    got = {r.doc_id: r for r in align.alignment_digest(edge_docs, *PATHS).collect()}
    ids = [tokenizers[0].encode(" " + t, add_special_tokens=False).ids for k, t in rows_of(edge_docs) if k == 14][0]
    assert got[14].n_a == len(ids) and got[14].n_links >= max(got[14].n_a, got[14].n_b) >= got[14].n_groups > 1000


def test_align_gives_tokens_cuts_and_links(edge_docs, tokenizers):
    kept = edge_docs.where("text is null or length(text) < 1500")
    got = collections.Counter((r.doc_id, str(r.ids_a), str(r.ids_b), str([tuple(x) for x in r.cuts]), str([tuple(x) for x in r.links]))
                              for r in align.align(kept, *PATHS).collect())
    assert got == collections.Counter((k, *map(str, plain_alignment(t, tokenizers))) for k, t in rows_of(kept))


def test_words_stand_alone_in_mixed_scripts(tokenizers, monkeypatch):
    """Word by word (and by a table that is forgotten all the time) equals whole texts."""
    monkeypatch.setattr(align, "MOST_WORDS", 50)
    rng = np.random.default_rng(3)
    parts = ["a", "The", "naïve", "'s", "don't", "12", "3.5", "\n", "\t", "\xa0", "日本", "語", "é", "é", "́", "😀", "!!", "...", "<s>", " ", "x_y", "Ω", " "]
    texts = []
    for _ in range(400):
        n = int(rng.integers(1, 14))
        texts.append("".join(str(rng.choice(parts)) + (" " if rng.random() < 0.6 else "") for _ in range(n)))
    table = align.Words(align.Aligner(*PATHS))
    for lo in range(0, 400, 100):
        own = align.Slice(pa.array(texts[lo : lo + 100]), table)
        for i, text in enumerate(texts[lo : lo + 100]):
            a, b, cuts, links = plain_alignment(text, tokenizers)
            assert own.numbers[:, i].tolist() == [len(a), len(b), len(cuts), len(links)], repr(text)
            pairs = collections.Counter((a[x], b[y]) for x, y in links)
            s, e = own.bounds[i], own.bounds[i + 1]
            assert {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(t) for p, t in zip(own.pairs[own.local[s:e]], own.times[s:e])} == pairs
    pieces = [tokenizers[1].id_to_piece(i) for i in range(tokenizers[1].get_piece_size())]
    assert not [p for p in pieces if "▁" in p.lstrip("▁")]


# --- simhash ---


def plain_fingerprint(text, k):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    k = min(k, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(fps, most=4):
    """The smallest place of each one's component."""
    at = np.array(fps, np.uint64)
    label = np.arange(len(at))
    while True:
        new = np.array([label[np.bitwise_count(at ^ x) <= most].min() for x in at] or label, dtype=label.dtype)
        if (new == label).all():
            return label
        label = np.minimum(new, new[new])


@pytest.mark.parametrize("which", ["docs", "edge_docs", "no_docs"])
def test_simhash_groups(which, request):
    table = request.getfixturevalue(which)
    rows = rows_of(table)
    fps = [plain_fingerprint(t, 4) for _, t in rows]
    label = plain_groups(fps)
    least = {}
    for (key, _), c in zip(rows, label.tolist()):
        if key is not None:
            least[c] = min(key, least.get(c, key))
    expected = collections.Counter((k, f"{f:016x}", least.get(c)) for (k, _), f, c in zip(rows, fps, label.tolist()))
    assert collections.Counter(map(tuple, simhash.simhash_digest(table).collect())) == expected


def test_fuzzy_keys_meet_for_all_patterns_of_errors():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    for most in range(5):
        y = x.copy()
        for i in range(len(y)):
            for bit in rng.choice(64, most, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(bit)
        own, other = ({(p, k): s for p, k, s in zip(*(z.tolist() for z in simhash.fuzzy_keys(v)))} for v in (x, y))
        assert len({at[0] for at, side in own.items() if at in other and (side != other[at] or side == 2)}) == len(x)
    assert len(simhash.fuzzy_keys(x)[0]) / len(x) < 70


def test_golay_code_is_perfect():
    near = golay.nearest()
    assert (np.bincount(near, minlength=4096) == 2048).all()
    table, counts = golay.within_four()
    assert set(counts.tolist()) <= {1, 6}
    for word in range(0, 1 << 16, 257):
        for bit in range(16):
            even, odd = sorted((word, word ^ 1 << bit), key=lambda w: w.bit_count() % 2)
            assert table[odd, 0] in table[even, : counts[even]]


def test_large_key_with_chains(spark, monkeypatch):
    """A dense group over many blocks, with chains that no hub shows, and vertices that meet by chance only."""
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rng = np.random.default_rng(8)
    center = int(rng.integers(0, 2**63))
    fps = {center}
    for _ in range(150):
        fps.add(center ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 8)), replace=False)))
    far = center ^ 0xFFFF000000000000
    for _ in range(60):
        far ^= sum(1 << int(b) for b in rng.choice(48, 5, replace=False))
        fps.add(far)
        fps.add(far ^ (1 << int(rng.integers(0, 64))))
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).astype(np.int64).tolist()
    vertices = spark.createDataFrame([(f, 1 + i % 3, i) for i, f in enumerate(signed)], "fp long, copies long, least long")
    found = {r.fp: r.component for r in simhash.fingerprint_groups(vertices).collect()}
    groups, expected = collections.defaultdict(set), collections.defaultdict(set)
    for f, c in zip(signed, plain_groups(fps).tolist()):
        groups[found.get(f, f)].add(f)
        expected[c].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


# --- periodic runs ---


def plain_runs(words, least=24, times=3):
    found = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            stop = i + q
            if i > start and stop - start >= max(least, times * q):
                if not any(all(words[k] == words[k + p] for k in range(start, stop - p)) for p in range(1, q)):
                    found.append((start, stop - start, q))
            i = max(i, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(key, text):
    words = re.findall(WORD, text or "")
    n = len(words)
    h = None if key is None else zlib.crc32(str(key).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (key, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


@pytest.mark.parametrize("which", ["docs", "edge_docs", "no_docs"])
def test_run_digest(which, request):
    table = request.getfixturevalue(which)
    got = periodic.run_digest(table)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(plain_row(*r) for r in rows_of(table))
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2


def test_word_runs_on_dense_sequences():
    rng = np.random.default_rng(11)
    for _ in range(400):
        words = rng.integers(0, int(rng.integers(1, 4)), int(rng.integers(0, 150)))
        for _ in range(int(rng.integers(0, 4))):
            p, s = int(rng.integers(1, 30)), int(rng.integers(0, max(1, len(words))))
            own = np.tile(rng.integers(0, 6, p), 8)[: min(int(rng.integers(0, 120)), len(words) - s, 8 * p)]
            words[s : s + len(own)] = own
        assert periodic.word_runs(words) == plain_runs(words.tolist())


def test_splitting_only_rules_words_out(monkeypatch):
    rng = np.random.default_rng(12)
    words = np.concatenate([rng.integers(0, 900, 2000), np.tile(rng.integers(0, 40, 31), 5), rng.integers(0, 900, 500), np.zeros(60, int)])
    whole = periodic.word_runs(words)
    assert len(whole) >= 2 and len(periodic.split_by_frequency(words, 24, 3)) >= 2
    monkeypatch.setattr(periodic, "ROUNDS", 0)
    assert periodic.word_runs(words) == whole


def test_long_texts_are_scanned_in_time():
    for words in (np.zeros(300_000, np.int64), np.tile(np.arange(1000), 300), np.random.default_rng(1).integers(0, 2, 300_000)):
        assert periodic.word_runs(words)
