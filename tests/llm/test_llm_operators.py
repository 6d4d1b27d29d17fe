"""The corpus operators against plain versions, on a small table and on edge rows."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from phenolith.llm import chat, components, fingerprints, hnsw, html_text, mixing, near_dup, packing, quality, repeats, sketches, token_files
from phenolith.llm.words import shingles
from phenolith.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid long, score string, part int, __spans string"
LONG = "alpha beta gamma delta " * 700
COPY = " ".join(f"word{i}" for i in range(120))


@pytest.fixture(scope="module")
def edge_docs(spark):
    texts = [
        (1, COPY), (2, COPY), (3, COPY.replace("word7 ", "changed ")), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, LONG),
        (9, "Ünïcödé " + COPY[100:500] + " \U0001F600 tail"), (10, "<|endoftext|> x <|STARTOFTEXT|>, it's 5.5!! a.b"), (10, "<|endoftext|> x <|STARTOFTEXT|>, it's 5.5!! a.b"),
        (11, "a" * 1000), (12, "b" * 199), (13, "b" * 199), (None, "no id"), (14, "x" * 70_000 + " y " + "z" * 70_000),
    ]
    rows = [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 3}", None if t is None else len(t), 0, "s", 1, "")
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def same_ids(spark):
    """One doc_id on different texts, on equal ones, and none."""
    other = " ".join(f"thing{i}" for i in range(90))
    texts = [(1, COPY), (1, other), (2, other + " more"), (3, COPY + " more"), (3, "short"), (4, other), (4, other), (5, None), (5, "x y z"), (None, COPY)]
    return spark.createDataFrame([(i, t, "en", "s", 1, 0, "s", 1, "") for i, t in texts], SCHEMA).repartition(4)


def test_one_of_each_keeps_other_texts_of_an_id(same_ids):
    kept = collections.Counter((r.doc_id, (r.text or "")[:6]) for r in near_dup.one_of_each(same_ids).collect())
    assert kept == {(1, "word0 "): 1, (1, "thing0"): 1, (3, "short"): 1, (5, ""): 1, (5, "x y z"): 1, (None, "word0 "): 1}
    assert near_dup.one_of_each(same_ids).columns == same_ids.columns


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")


def texts_of(df):
    return sorted(((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


@pytest.mark.parametrize("which", ["docs", "edge_docs", "no_docs"])
def test_token_files_round_trip(spark, which, request, tokenizer):
    table = request.getfixturevalue(which)
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table, path, TOKENIZER, block_bytes=2000)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.token_digests(spark, path).collect()), key=lambda x: x[0])
    expected, start = [], 0
    ids = {}
    for key, text in texts_of(table):
        own = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        ids[key] = own
        expected.append((start, key, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert got == expected
    wanted = [k for k in list(ids)[:3] if k is not None]
    if wanted:
        some = {r.doc_id: r.ids for r in token_files.read_documents(spark, path, wanted).collect()}
        assert some == {k: ids[k] for k in wanted}
        whole = {r.doc_id: r.ids for r in token_files.read_token_files(spark, path).collect()}
        assert whole == ids


def test_dictionary_is_not_trained_on_heads_only(spark, tokenizer):
    rng = np.random.default_rng(6)
    heads, tails = "alpha beta gamma delta house water light stone".split(), "winter summer music paper green river table horse".split()
    rows = [(i, " ".join([*rng.choice(heads, 10_000), *rng.choice(tails, 30_000)])) for i in range(40)]
    content, kind = token_files.train_dictionary(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER, 1, 2)
    ids = lambda words: set(tokenizer.encode(" " + " ".join(words), add_special_tokens=False).ids)
    held = set(np.frombuffer(content[len(content) % 2 :], "<u2").tolist())
    assert kind == "trained" and ids(tails) - ids(heads) <= held


@pytest.mark.parametrize("which", ["docs", "edge_docs", "no_docs"])
def test_packing(which, request, tokenizer):
    table = request.getfixturevalue(which)
    rows = packing.pack(table, TOKENIZER, keep_ids=True).collect()
    expected = collections.Counter()
    for key, text in texts_of(table):
        own = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(own), 2048)):
            expected[key, k, at, len(own[at : at + 2048]), zlib.crc32(np.array(own[at : at + 2048], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(r.length for r in rows) // 2048)
    assert len(bins) <= least * 1.02 + 1


def test_assembled_sequences(edge_docs):
    placed = packing.pack(edge_docs, TOKENIZER, keep_ids=True)
    whole = {r.sequence_id: (r.length, bytes(r.ids)) for r in packing.assemble(placed).collect()}
    for r in placed.collect():
        length, ids = whole[r.sequence_id]
        assert ids[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids) and len(ids) == 4 * length


def test_best_two_fit_replaces_the_smallest():
    # greedy gives 6 + 3, gap 1; the 3 gives way to 2 + 2, which fill the gap of 4
    plan = packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)
    first = {int(x) for x, b in zip(plan["length"], plan["bin"]) if b == 0}
    assert first == {6, 2}
    rng = np.random.default_rng(1)
    counts = collections.Counter(int(x) for x in rng.integers(1, 2049, 5000))
    plan = packing.best_two_fit(counts, 2048)
    assert {k: int(plan["size"][plan["length"] == k].sum()) for k in counts} == dict(counts)
    used = int((plan["bin"] + plan["size"] // plan["each"]).max())
    assert used <= 1.01 * sum(k * n for k, n in counts.items()) / 2048 + 1


@pytest.mark.parametrize("which", ["docs", "edge_docs", "no_docs"])
def test_mixing(which, request):
    table = request.getfixturevalue(which)
    rows = mixing.mix(table).collect()
    sizes = collections.defaultdict(int)
    expected = []
    for r in table.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] += n
        expected.append((r.doc_id, n, r.source))
    assert collections.Counter((r.doc_id, r["size"]) for r in rows) == collections.Counter((i, n) for i, n, _ in expected)
    if not expected:
        return
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level >= 3 * sizes[s]}
        if not above:
            target.update({s: weight[s] * level for s in open_})
            break
        for s in above:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= above
    by_target = collections.defaultdict(int)
    for r in rows:
        by_target[round(r.target, 3), r.source_size] += r["copies"] * r["size"]
        assert 0 <= r.copies <= 3
    largest = max(n for _, n, _ in expected)
    wanted = collections.defaultdict(float)
    for s in names:
        wanted[round(target[s], 3), sizes[s]] += target[s]
    assert set(wanted) == set(by_target)
    assert all(abs(by_target[k] - wanted[k]) <= max(0.02 * wanted[k], largest) for k in wanted)
    again = mixing.mix(table.repartition(5)).collect()
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r["size"], r["copies"])
    assert sorted(map(tuple, sorted(again, key=key)), key=str) == sorted(map(tuple, sorted(rows, key=key)), key=str)


def test_mixed_rows(edge_docs):
    out = mixing.repeated(edge_docs)
    assert out.columns == edge_docs.columns and out.count() > 0


def word_sets(rows, k):
    out = []
    for key, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        out.append((key, frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()))
    return out


@pytest.mark.parametrize("which,k,above", [("docs", 3, 85), ("edge_docs", 3, 85), ("edge_docs", 5, 80), ("same_ids", 3, 85), ("no_docs", 5, 80)])
def test_near_duplicates(which, k, above, request):
    table = request.getfixturevalue(which)
    sets = word_sets(texts_of(table), k)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for j, (b, t) in enumerate(sets[:i]):
            if s and t and a is not None and b is not None and 100 * len(s & t) >= above * len(s | t):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)  # rows are in ascending order of doc_id
    got = collections.Counter(map(tuple, near_dup.near_duplicates(table, k, above, 100).collect()))
    assert got == collections.Counter((a, len(s), sets[root(i)][0]) for i, (a, s) in enumerate(sets))


def test_blocks_find_links_that_hubs_miss(spark, monkeypatch):
    """A chain of texts, each near the next only: the ends reach each other through the middle."""
    monkeypatch.setattr(near_dup, "BLOCK", 50)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([f"x{j}" for j in range(6 * i)] + words[6 * i :])) for i in range(12)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(table, 3, 85, 100).collect()}
    assert set(got.values()) == {0}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.vertex: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160))


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(3)
    a, b = [], []
    for seed in range(40):
        x = rng.integers(0, 2**63, 400).astype(np.uint64)
        y = np.concatenate([x[:200], rng.integers(0, 2**63, 200).astype(np.uint64)])
        a.append((sketches.fast_similarity_sketch(x, 120, seed + 1) == sketches.fast_similarity_sketch(y, 120, seed + 1)).mean())
        b.append((sketches.one_permutation(x, 256, seed + 1) == sketches.one_permutation(y, 256, seed + 1)).mean())
    assert abs(np.mean(a) - 1 / 3) < 0.03 and abs(np.mean(b) - 1 / 3) < 0.03
    tiny = sketches.fast_similarity_sketch(np.array([5], np.uint64), 120)
    assert len(tiny) == 120 and (tiny != sketches._EMPTY).all()


def removed(rows, length=200):
    starts = collections.Counter()
    raws = [(k, t.encode()) for k, t in rows]
    for _, raw in raws:
        starts.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for key, raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if starts[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((key, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("which", ["docs", "edge_docs", "same_ids", "no_docs"])
def test_repeated_strings(which, request):
    table = request.getfixturevalue(which)
    got = collections.Counter(map(tuple, repeats.repeat_digest(table).collect()))
    assert got == collections.Counter(removed(texts_of(table)))


def test_very_frequent_anchors_go_by_hashes(edge_docs, docs):
    table = edge_docs.select("doc_id", "text").where("doc_id < 10").unionByName(docs.select((docs.doc_id + 1000).alias("doc_id"), "text"))
    same = table.selectExpr("doc_id as uid", "text")
    a, b = (repeats.repeated_spans(same, most_contexts=m).collect() for m in (50_000, 2))
    united = lambda rows: {r.uid: repeats.united((s.start, s.stop) for s in r.spans) for r in rows}
    assert united(a) == united(b)


def test_texts_without_repeats(edge_docs):
    out = repeats.without_repeats(edge_docs)
    assert out.columns == edge_docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[1] == "" and got[4] is None and got[7] == "one" and got[9].startswith("Ünïcödé ")


def test_anchors_do_not_depend_on_chunks(monkeypatch):
    raw = np.random.default_rng(2).integers(97, 123, 9000).astype(np.uint8)
    whole = repeats.anchors(raw, 200)
    monkeypatch.setattr(repeats, "CHUNK", 700)
    for a, b in zip(whole, repeats.anchors(raw, 200)):
        assert (a == b).all()


@pytest.mark.parametrize("which", ["docs", "edge_docs", "no_docs"])
def test_fingerprints(which, request):
    table = request.getfixturevalue(which)
    rows = texts_of(table)
    expected = collections.Counter()
    for k, (key, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, other = (fingerprints.fingerprint(t) for t in (text, edited, following))
        expected[key, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed,
                 fingerprints.likeness(own, changed), fingerprints.likeness(own, other)] += 1
    assert collections.Counter(map(tuple, fingerprints.compare_with_next(table).collect())) == expected


def test_likeness_follows_jaccard(docs):
    rows = [t for _, t in texts_of(docs) if len(t) > 2000][:30]
    for text in rows:
        edited = fingerprints.half_replaced(text, rows[0])
        x, y = set(shingles(text.encode(), 5).tolist()), set(shingles(edited.encode(), 5).tolist())
        assert abs(fingerprints.likeness(fingerprints.fingerprint(text), fingerprints.fingerprint(edited)) - len(x & y) / len(x | y)) < 0.15


def test_quality_classifier(spark, edge_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels, sample_per_label=200)
    kept = docs.join(labels.where(quality.held_out(labels.doc_id)), "doc_id").select("doc_id", "text", "quality")
    rows = quality.score(kept, model).collect()
    assert np.mean([(r.score >= 0.3) == (r.quality == 1) for r in rows]) > 0.95
    out = quality.score(edge_docs, model).collect()
    assert len(out) == 16 and all(0 <= r.score <= 1 for r in out)
    assert quality.score(no_docs, model).count() == 0
    assert set(r.score for r in quality.quality_scores(docs.limit(3), labels.limit(0)).collect()) == {0.5}


def test_nearest_neighbours(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in table.collect()}
    extra = [(100_000 + i, rows[0], None) for i in range(40)] + [(200_000, None, None), (200_020, [0.0] * 64, None), (200_040, [float("nan")] * 64, None),
             (200_060, [None] * 64, None), (200_080, [1.0], None), (None, rows[0], None), (0, rows[0], None)]
    table = table.unionByName(spark.createDataFrame(extra, table.schema))
    valid = rows | {i: v for i, v, _ in extra[:40]}
    ids = np.array(sorted(valid))
    vectors = np.array([valid[i] for i in ids], float)
    got = collections.defaultdict(list)
    for r in hnsw.nearest(table, vector="embedding").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i in valid if i % 20 == 0}
    hits = 0
    for q, own in got.items():
        score = vectors @ np.array(valid[q], float)
        best = [int(ids[i]) for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        assert [r for r, _, _ in sorted(own)] == list(range(1, 21))
        hits += len(set(best) & {v for _, v, _ in own})
        assert all(abs(s - score[np.searchsorted(ids, v)]) < 1e-12 for _, v, s in own)
    assert hits / (20 * len(got)) >= 0.95
    assert [v for _, v, _ in sorted(got[0])] == [100_000 + i for i in range(20)]
    assert hnsw.nearest(table.limit(0), vector="embedding").count() == 0


def test_recall_of_a_shard_of_the_largest_size(spark):
    """20,000 vectors: those of the largest test table, and copies of them with noise."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("size(embedding) = 64").select("embedding").distinct()
    own = np.array(sorted(r.embedding for r in rows.collect()), np.float32)
    rng = np.random.default_rng(1)
    more = own[rng.integers(0, len(own), hnsw.SHARD_ROWS - len(own))]
    vectors = np.concatenate([own, more + rng.normal(0, 0.7 * own.std(), more.shape).astype(np.float32)])
    vectors = vectors[rng.permutation(len(vectors))]
    asked = vectors[:200]
    found, _ = hnsw.search(vectors, hnsw.build(vectors), asked, 21)
    best = np.argsort(-asked @ vectors.T, axis=1, kind="stable")[:, :21]
    assert np.mean([len(set(a) & set(b)) / 21 for a, b in zip(found, best)]) >= 0.93


PAGE = """<html><head><title>T words</title><style>p{}</style></head><body><header>Site name</header><nav><ul><li><a href="/">one two</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>Head&amp;line</h1><p>First  <b>bold</b>&nbsp;text<br>line<p>Second<aside>side words</aside>
<p class="share">share me</p><script>var t="</p>";</script><ul><li>item <i>a</i></li></ul><form><input>send</form></article>
<section id="comments"><p>A reader says things that go on and on</p></section><footer>&copy; foot</footer>"""


def test_main_text(spark, no_docs):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = html_text.learn(pages)
    assert html_text.main_text(PAGE, weights) == "Head&line\n\nFirst bold text line\n\nSecond\n\nshare me\n\nitem a"
    for page in ("", "<", "<p", "plain words", "<div>a</div>", "<!-- x", "<script>x", "<a title='>'>b</a>", "</p></p>"):
        html_text.main_text(page, weights)
    assert html_text.main_text("plain words", weights) == "plain words"
    odd = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (None, "u", PAGE, 2)], "page_id long, url string, html string, n_chars int")
    assert sorted(r.n_chars for r in html_text.extract(odd, weights).collect())[:2] == [0, 0]
    assert html_text.extract(pages.limit(0), html_text.learn(pages.limit(0))).count() == 0


def test_plain_pages_beside_labelled_ones(spark):
    """Words beside an article do not empty pages whose text stands in the same kinds of elements."""
    words = " ".join(f"word{i}" for i in range(40))
    byline = "<div>By A Writer on some day of May</div><p>back to top</p>"
    articles = [f"<body>{byline}<article><h1>Head {i}</h1><p>{words}</p></article>{byline}</body>" for i in range(6)]
    articles += [f"<body><main><div class=content>{byline}<article><p>{words}</p></article>{byline}</div>{byline}<figure>A view</figure></main></body>"] * 6
    plain = [f"<body><div>{words}</div><div><p>{words} end</p></div></body>", f"<table><tr><td>{words}</td></tr></table>",
             f"<div class=content><p>{words}</p></div>", f"<section class=content>{words}</section>", f"<figure>{words}</figure>",
             f"<body><main><p>{words}</p></main></body>", f"<article><div class=content><p>{words}</p></div></article>",
             f"<article>Card</article><div>{words}</div>", f"<main></main><div>{words}</div>"]
    pages = spark.createDataFrame([(i, "u", x) for i, x in enumerate(articles + plain)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages, html_text.learn(pages)).collect()}
    assert [got[i] for i in range(6)] == [f"Head {i}\n\n{words}" for i in range(6)]
    assert [got[i] for i in range(6, 12)] == [words] * 6
    assert got[12] == f"{words}\n\n{words} end"
    assert [got[i] for i in range(13, 19)] == [words] * 6
    assert got[19].endswith(words) and got[20] == words


def test_sections_with_telling_names_stay(spark):
    """Ids, and classes of anything but containers, don't take text out of an article; comments and cards are no articles."""
    words = " ".join(f"word{i}" for i in range(30))
    weights = html_text.learn(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    inner = (f"<h2 id=related-work>Related work</h2><section id=discussion><p>{words}</p></section><p class=alert>A warning</p><p id=search>Find</p>"
             f"<h2 id=legal-basis>Legal basis</h2><table class=side-by-side><tr><td>cell</td></tr></table><p>E = <math><mi>m</mi><mo>c</mo></math></p>")
    comments = "<section id=comments><article class=comment>A reader says things that go on</article></section><aside class=related><article class=card>Card</article></aside>"
    want = f"Related work\n\n{words}\n\nA warning\n\nFind\n\nLegal basis\n\ncell\n\nE = mc"
    assert html_text.main_text(f"<body><article>{inner}</article>{comments}</body>", weights) == want
    boxed = f"<div class=post-with-sidebar><article>{inner}</article></div>"
    assert html_text.main_text(boxed, weights) == want


def test_the_scan_chooses_the_region(spark, monkeypatch):
    """On the given pages' html without article elements, and on one with words beside the article, the scan decides."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = html_text.learn(pages)
    links = "<ul>" + "".join(f"<li><a href=/{i}>Topic {i}</a></li>" for i in range(30)) + "</ul>"
    htmls = [r.html for r in pages.select("html").limit(40).collect() if r.html]
    plain = [h.replace("<article", links + "<div").replace("</article>", "</div>" + links) for h in htmls]
    beside = [h.replace("<article", "<div>By A Writer</div><article") for h in htmls]
    want = [html_text.main_text(h, weights) for h in htmls]
    assert [html_text.main_text(h, weights) for h in plain] == want == [html_text.main_text(h, weights) for h in beside]
    monkeypatch.setattr(html_text, "best_region", lambda scores: (0, len(scores)))
    assert all(html_text.main_text(h, weights) != w for h, w in zip(plain, want))


def test_hostile_pages_take_linear_time():
    weights = html_text.Weights({}, {})
    for page in ("<div>" * 60_000 + "</b>" * 60_000 + "end", "<head>" * 30_000 + "<body>" * 30_000 + "end", "<article><p>" * 40_000 + "end"):
        assert html_text.main_text(page, weights).endswith("end")


def test_text_beside_boilerplate_within_the_content(spark):
    """A title, a lead and a short last paragraph stay, whatever stands between them and the body."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = html_text.learn(pages)
    body = " ".join(f"word{i}" for i in range(60))
    items = "".join(f"<div><li><a href='/{i}'>item {i}</a></li></div>" for i in range(40))
    boxes = [f"<nav class=toc><ul>{items}</ul></nav>", f"<aside><ul>{items}</ul></aside>", f"<div class=share><ul>{items}</ul></div>",
             f"<div class=related><div><ul>{items}</ul></div></div><script>ad()</script>"]
    empty = "<div><span><img src=a></span></div>" * 60
    for box in boxes:
        inner = f"<h1>A title of five words</h1>{box}<p>{body}</p>{box}<p>The last words follow here</p>"
        text = f"A title of five words\n\n{body}\n\nThe last words follow here"
        for page in (f"<article>{inner}</article>", f"<main>{inner}</main>", f"<div class=content>{inner}</div>", inner):
            assert html_text.main_text(page, weights) == text
        assert html_text.main_text(f"<article>{inner.replace(box, empty)}</article>", weights) == text
    lead = "A lead of words"
    assert html_text.main_text(f"<div>{lead}</div><div>{body}</div><div>{lead}</div>", weights) == f"{lead}\n\n{body}\n\n{lead}"
    # links without marks of their own still end the text
    assert html_text.main_text(f"<div><ul>{items}</ul></div><div>{body}</div><div><ul>{items}</ul></div>", weights) == body


def test_regions():
    rng = np.random.default_rng(4)
    for _ in range(200):
        x = rng.normal(size=rng.integers(0, 12)).tolist()
        a, b = html_text.best_region(x)
        best = max([sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1)], default=0)
        assert abs(sum(x[a:b]) - max(best, 0)) < 1e-9


def test_preference_pairs(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello you"), (1, 2, "user", "more"), (2, 0, "user", "hi"), (2, 1, "assistant", "hello"),
             (3, 0, "user", "hi"), (3, 1, "assistant", "hello you"), (4, 0, None, None), (4, None, "user", "first"), (None, 0, "user", "hi"),
             (5, 0, "user", "hi"), (5, 1, "assistant", "hello you"), (5, 2, "user", "more")]
    table = spark.createDataFrame([(*t, 9) for t in turns], "conv_id long, turn long, role string, text string, position int")
    rows = chat.preference_pairs(table)
    got = {r.pair_id: r for r in chat.joined(rows).collect()}
    assert set(got) == {2, 3, 5}
    assert got[2].prompt == "<|user|>\nhi<|end|>\n"
    assert got[2].chosen == "<|assistant|>\nhello you<|end|>\n<|user|>\nmore<|end|>\n" and got[2].rejected == "<|assistant|>\nhello<|end|>\n"
    assert got[3].rejected == "" and got[3].chosen == "<|user|>\nmore<|end|>\n" and got[5].chosen == got[5].rejected == ""
    start, stop = got[2].chosen_learned[0]
    assert (got[2].prompt + got[2].chosen)[start:stop] == "<|assistant|>\nhello you<|end|>\n" and len(got[2].chosen_learned) == 1
    digest = chat.preference_digest(table).collect()
    assert {r.pair_id for r in digest if r.kind == "swapped"} == {1, 2, 3, 5}
    assert chat.preference_digest(table.limit(0)).count() == 0


def test_swapped_answers_of_sparse_ids_take_few_groups(spark, monkeypatch):
    """The answers are gathered by range of conv_id, however far apart the ids are."""
    kept = {}
    monkeypatch.setattr(chat, "materialise", lambda df, name, real=chat.materialise: kept.setdefault(name, real(df, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ids = [(i - 30) * 10**12 for i in range(60)]
    turns = [(c, t, role, f"{role} {c}") for c in ids for t, role in enumerate(("user", "assistant", "user"))] + [(5, 0, "user", "alone")]
    try:
        out = chat.swapped_answers(spark.createDataFrame(turns, "conv_id long, position long, role string, text string")).collect()
        answers = kept["answers"]
        groups = answers.select(({"run", "part"} & set(answers.columns)).pop()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = [(c, t, role, f"{role} {ids[(k + 1) % 60] if t == 1 else c}") for k, c in enumerate(ids)
                for t, role in enumerate(("user", "assistant", "user"))]
    assert sorted(map(tuple, out)) == sorted(expected)
    assert 1 < groups <= 8
    assert chat.swapped_answers(spark.createDataFrame(turns[-1:], "conv_id long, position long, role string, text string")).count() == 0


def test_long_conversation_is_numbered_in_runs(spark, monkeypatch):
    monkeypatch.setattr(chat, "RUN", 4)
    turns = [(c, t, "user", f"{t}" if t < 11 else f"{c} {t}") for c in (1, 2) for t in range(15)]
    rows = chat.preference_pairs(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = chat.joined(rows).first()
    assert got.prompt == "".join(f"<|user|>\n{t}<|end|>\n" for t in range(11)) and got.rejected.startswith("<|user|>\n2 11")
    starts = sorted((r.position, r.start, len(r.rendered)) for r in rows.where("part != 'rejected'").collect())
    assert all(a[1] + a[2] == b[1] for a, b in zip(starts, starts[1:]))
