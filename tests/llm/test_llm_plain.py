"""Whole queries and the pipeline's stages against plain versions on the smallest tables."""

from __future__ import annotations

import collections
import hashlib
import html
import re
import zlib

import corpus_pipeline
import numpy as np
from test_llm_operators import TOKENIZER, removed, word_sets
from tokenizers import Tokenizer

from phenolith.llm import mixing, quality, queries

SF = "/root/testdata/sf0.001"


def test_main_text_of_all_pages(spark):
    expected = collections.Counter()
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.sub(r"<!--.*?-->", "", re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1], flags=re.DOTALL)
        blocks = [re.sub(r"<[^>]*>", "", re.sub(r"<br[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)(?=[\s>])[^>]*>", inner)]
        text = "\n\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)
        expected[r.page_id, r.url, text, len(text)] += 1
    assert collections.Counter(map(tuple, queries.op5_main_text(spark, SF).collect())) == expected


def test_preference_digest_of_all_conversations(spark):
    least = lambda x: (x is not None, x if x is not None else 0)
    own = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").where("conv_id is not null").collect():
        own[r.conv_id].append((r.turn, r.role, r.text))
    own = {c: [t[1:] for t in sorted(x, key=lambda t: (least(t[0]), t[1] or "", t[2] or ""))] for c, x in own.items()}
    last = {c: max(i for i, (role, _) in enumerate(x) if role == "assistant") for c, x in own.items() if any(t[0] == "assistant" for t in x)}
    ids = sorted(last)
    pairs = []
    for k, c in enumerate(ids):
        following = ids[(k + 1) % len(ids)]
        copy = [(role, own[following][last[following]][1] if i == last[c] else text) for i, (role, text) in enumerate(own[c])]
        pairs.append(("swapped", c, own[c], c, copy))
    openings = collections.defaultdict(list)
    for c, x in own.items():
        openings[x[0]].append(c)
    for group in openings.values():
        # ids are compared as strings here
        best = min(group, key=lambda c: (-sum(len(t or "") for role, t in own[c] if role == "assistant"), str(c)))
        pairs += [("opening", best, own[best], c, own[c]) for c in group if c != best]
    expected = collections.Counter()
    for kind, a, chosen, b, rejected in pairs:
        common = next((i for i, (x, y) in enumerate(zip(chosen, rejected)) if x != y), min(len(chosen), len(rejected)))
        for side, c, turns in (("chosen", a, chosen), ("rejected", b, rejected)):
            start = 0
            for i, (role, text) in enumerate(turns):
                shown = f"<|{'unknown' if role is None else role}|>\n{text or ''}<|end|>\n"
                if side == "chosen" or i >= common:
                    expected[kind, b, c, "prompt" if i < common else side, i, role, start, len(shown), i >= common and role == "assistant",
                             hashlib.sha256(shown.encode()).hexdigest()] += 1
                start += len(shown)
    assert collections.Counter(map(tuple, queries.op6_preference_pairs(spark, SF).collect())) == expected


def kept_of_near_copies(rows):
    sets = word_sets(rows, 5)
    parent = {key: key for key, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {key for key in parent if root(key) == key}


def test_pipeline_keeps_the_rows_of_a_plain_version(spark):
    """Every stage on what the stage before left; the model's scores and the mix's copies are taken as given."""
    stage = dict(corpus_pipeline.STAGES)
    rows = lambda df: collections.Counter(map(tuple, df.select(*corpus_pipeline.COLUMNS).collect()))
    run = lambda name, df: corpus_pipeline.materialise(stage[name](spark, df, SF), "plain")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    score = {r.doc_id: r.score for r in quality.quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    good = run("quality classifier", docs)
    assert rows(good) == collections.Counter({r: n for r, n in rows(docs).items() if score[r[0]] >= 0.3})
    single = run("near-duplicates", good)
    left = kept_of_near_copies([(r[0], r[1] or "") for r in rows(good).elements()])
    assert rows(single) == collections.Counter({r: n for r, n in rows(good).items() if r[0] in left})
    cut = run("repeated strings", single)
    before = sorted(rows(single).elements())
    digests = {key: (size - gone, sha) for key, size, gone, _, sha in removed([(r[0], r[1] or "") for r in before])}
    after = {r[0]: r for r in rows(cut).elements()}
    assert set(after) == {r[0] for r in before}
    for r in before:
        key, text, lang, source, n = after[r[0]]
        assert (lang, source, n) == (r[2], r[3], len(text))
        # where a cut splits a character its rest goes too
        assert digests[key] == (len(text.encode()), hashlib.sha256(text.encode()).hexdigest()) or 0 < digests[key][0] - len(text.encode()) < 12
    mixed = run("mixing", cut)
    copies = {r.doc_id: r.copies for r in mixing.mix(cut).collect()}
    assert rows(mixed) == collections.Counter({r: n * copies[r[0]] for r, n in rows(cut).items() if copies[r[0]]})
    tokenizer, expected = Tokenizer.from_file(TOKENIZER), collections.Counter()
    for r in rows(mixed).elements():
        ids = tokenizer.encode(r[1], add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            expected[r[0], k, at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())] += 1
    packed = stage["packing"](spark, mixed, SF).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected
