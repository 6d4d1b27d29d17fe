"""Near-duplicate groups: fast similarity sketches, banding, exact verification.

1. Each text becomes its set of k-word shingles and a fast similarity sketch (see ``sketches``). Equal sets are
   one vertex from here on, so exact copies are never paired.
2. Bands of the sketch deal the vertices into buckets; band size and number follow from the threshold, such that
   a pair at the threshold shares no bucket with a probability under ``MISS``.
3. Within each bucket every vertex is compared with one hub, the vertex that meets most others over all its
   buckets. Pairs are verified on the full sets, and linked vertices form components.
4. Buckets that hold more than one component are not done: vertices outside the main component of such a
   neighbourhood are compared with all others of it whose component differs. Vertices are dealt into blocks of
   bounded volume, each task gets two blocks, compares sketches, verifies those that could reach the threshold
   on the full sets, and returns links only. So no link is lost to the hubs, no pairs are spelled out, and no
   neighbourhood meets in one task.

Words are runs of anything but ASCII white space, A-Z folded. With fewer than k words the whole sequence is
one shingle; empty and null texts have no shingles and are linked with nothing. Rows that share a
doc_id and a text are one document; one doc_id on different texts is as many documents, each with its own set, links and
component (whose name is the smallest doc_id among its documents). Null ids are linked with nothing and get a null
component; repeated rows each get their row.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.llm.common import fresh, materialise, mix64, pick, with_row_ids
from phenolith.llm.components import components
from phenolith.llm.sketches import band_hashes, fast_similarity_sketch
from phenolith.llm.words import shingles

SKETCH = 120
MISS = 1e-6
#: Standard deviations that a sketch's estimate may fall below the threshold before a pair is ruled out.
SIGMAS = 4.6
#: Shingles in a block of step 4.
BLOCK = 200_000


def choose_bands(threshold: float, size: int = SKETCH) -> tuple[int, int]:
    """(bands, rows): as many rows as keep the miss probability at the threshold under MISS."""
    best = (size, 1)
    for rows in range(1, size + 1):
        bands = size // rows
        if (1 - threshold**rows) ** bands < MISS:
            best = (bands, rows)
    return best


def _sketched(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    schema = "doc_id long, uid long, n_shingles long, h1 long, h2 long, bands array<long>, sketch binary"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]

    def run(batches):
        for batch in batches:
            out = []
            for key, uid, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1)):
                own = shingles(text.as_buffer().to_pybytes() if text.is_valid else b"", k)
                if not len(own):
                    out.append((key, uid, 0, None, None, None, None))
                    continue
                spread = mix64(own)
                sketch = fast_similarity_sketch(own, bands * rows)
                out.append((key, uid, len(own), int(own.sum().astype(np.int64)), int(spread.sum().astype(np.int64)),
                            band_hashes(sketch, bands, rows).astype(np.int64), mix64(sketch).astype(np.uint32).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    names = ["doc_id", "uid", "n_shingles", "h1", "h2", "bands", "sketch"]
    return docs.mapInArrow(run, schema)


def _sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            own = [shingles(t.as_buffer().to_pybytes(), k).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["id", "set"])

    return docs.mapInArrow(run, "id long, set binary")


def _reaches(a: np.ndarray, b: np.ndarray, above: int, below: int) -> bool:
    """below * intersection >= above * union, on sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if below * len(a) < above * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int(np.count_nonzero(b[at] == a))
    return below * common >= above * (len(a) + len(b) - common)


def _verify(pairs: DataFrame, sets: DataFrame, above: int, below: int) -> DataFrame:
    """The pairs (u, v) that are links."""
    full = pairs.join(sets.select(F.col("id").alias("u"), F.col("set").alias("a")), "u").join(
        sets.select(F.col("id").alias("v"), F.col("set").alias("b")), "v").select("u", "v", "a", "b")

    def run(batches):
        for batch in batches:
            kept = [
                _reaches(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), above, below)
                for a, b in zip(batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(kept, pa.bool_())), batch.column(1).filter(pa.array(kept, pa.bool_()))],
                names=["u", "v"])

    return full.mapInArrow(run, "u long, v long")


def _across(pdf: pd.DataFrame, above: int, below: int, least: int) -> pd.DataFrame:
    """Links between vertices of two blocks (or within one) whose components differ."""
    sets = [np.frombuffer(s, np.uint64) for s in pdf["set"]]
    sketch = np.stack([np.frombuffer(s, np.uint32) for s in pdf["sketch"]])
    n, comp, ids = np.array([len(s) for s in sets]), pdf["component"].to_numpy(), pdf["id"].to_numpy()
    left = np.flatnonzero(pdf["side"].to_numpy() == 0)
    right = np.flatnonzero(pdf["side"].to_numpy() == 1)
    same = not len(right)
    found = []
    parent = {c: c for c in set(comp.tolist())}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    for k, i in enumerate(left):
        near = left[k + 1 :] if same else right
        near = near[(comp[near] != comp[i]) & (below * np.minimum(n[near], n[i]) >= above * np.maximum(n[near], n[i]))]
        near = near[(sketch[near] == sketch[i]).sum(1) >= least]
        for j in near:
            # what is linked by now needs no second link
            if (a := root(int(comp[i]))) != (b := root(int(comp[j]))) and _reaches(sets[i], sets[j], above, below):
                parent[max(a, b)] = min(a, b)
                found.append((ids[i], ids[j]))
    return pd.DataFrame(found, columns=["u", "v"]).astype("int64")


def _rest(entries: DataFrame, hubs: DataFrame, comp: DataFrame, vertices: DataFrame, sets: DataFrame,
          above: int, below: int, size: int) -> DataFrame:
    """Step 4: the links that the hubs did not show."""
    labelled = entries.join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bucket")
    members = materialise(labelled.join(mixed, "bucket"), "mixed")
    if members.isEmpty():
        return entries.sparkSession.createDataFrame([], "u long, v long")
    hub = hubs.join(mixed, "bucket").select("bucket", "hub")
    around = components(members.join(hub, "bucket").select(F.col("id").alias("u"), F.col("hub").alias("v")))
    residual = members.select("id", "component").distinct().join(
        around.select(F.col("vertex").alias("id"), F.col("component").alias("place")), "id")
    residual = materialise(residual.join(vertices.select("id", "n"), "id"), "residual")
    share = residual.groupBy("place", "component").agg(F.count("*").alias("m"))
    main = share.groupBy("place").agg(F.max(F.struct("m", "component")).alias("x")).select("place", F.col("x.component").alias("main"))
    residual = residual.join(main, "place").withColumn("is_main", F.col("component") == F.col("main"))
    blocks = residual.groupBy("place").agg(
        F.ceil(F.sum(F.when(F.col("is_main"), F.col("n")).otherwise(0)) / BLOCK).alias("of_main"),
        F.ceil(F.sum(F.when(F.col("is_main"), 0).otherwise(F.col("n"))) / BLOCK).alias("of_rest"))
    dealt = residual.join(blocks, "place").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.when(F.col("is_main"), F.col("of_main")).otherwise(F.col("of_rest"))))
    rest_count, main_count = F.sequence(F.lit(0).cast("long"), F.col("of_rest") - 1), F.sequence(F.lit(0).cast("long"), F.col("of_main") - 1)
    # a task is (place, block i of the rest, block j of the rest or of the main component)
    own = F.transform(rest_count, lambda j: F.struct(
        F.least("block", j).alias("i"), F.greatest("block", j).alias("j"), F.lit(False).alias("with_main"),
        F.when(F.col("block") <= j, 0).otherwise(1).alias("side")))
    other = F.when(F.col("of_main") > 0, F.transform(main_count, lambda j: F.struct(
        F.col("block").alias("i"), j.alias("j"), F.lit(True).alias("with_main"), F.lit(0).alias("side"))))
    mains = F.transform(rest_count, lambda i: F.struct(
        i.alias("i"), F.col("block").alias("j"), F.lit(True).alias("with_main"), F.lit(1).alias("side")))
    tasks = F.when(F.col("is_main"), mains).otherwise(F.when(other.isNull(), own).otherwise(F.concat(own, other)))
    sent = dealt.select("place", "id", "component", F.explode(tasks).alias("t")).select("place", "id", "component", "t.*")
    sent = sent.join(sets, "id").join(vertices.select("id", "sketch"), "id")
    p = above / below
    least = math.floor(size * (p - SIGMAS * math.sqrt(p * (1 - p) / size)))
    return sent.groupBy("place", "i", "j", "with_main").applyInPandas(
        lambda pdf: _across(pdf, above, below, least), "u long, v long")


def near_duplicates(docs: DataFrame, k: int = 5, above: int = 80, below: int = 100, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) of every row; documents are
    linked if ``below`` * intersection >= ``above`` * union of their shingle sets."""
    docs = with_row_ids(pick(docs, doc_id=doc_id, text=text), "uid")
    return _groups(docs, k, above, below).select("doc_id", "n_shingles", "component_id")


def _groups(docs: DataFrame, k: int, above: int, below: int) -> DataFrame:
    """uid, doc_id, n_shingles, component_id of every row of (doc_id, text, uid)."""
    bands, rows = choose_bands(above / below)
    sketched = materialise(_sketched(docs, k, bands, rows), "sketches")
    vertices = materialise(
        sketched.where("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2").agg(
            F.min("uid").alias("id"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch")), "vertices")
    spread = vertices.select("id", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    entries = materialise(spread.join(shared, "bucket"), "buckets")
    met = entries.groupBy("id").agg(F.sum("m").alias("met"))
    entries = materialise(entries.join(met, "id").select("bucket", "id", "met"), "buckets")
    hubs = materialise(entries.groupBy("bucket").agg(F.max(F.struct("met", (-F.col("id")).alias("x"))).alias("x")).select(
        "bucket", (-F.col("x.x")).alias("hub")), "hubs")
    pairs = entries.join(hubs, "bucket").where("id != hub").select(F.col("id").alias("u"), F.col("hub").alias("v")).distinct()
    # Spark broadcasts the ids if it finds them small, else it shuffles the texts once
    sets = materialise(_sets(docs.join(met.select(F.col("id").alias("uid")), "uid", "left_semi").dropDuplicates(["uid"]).select("uid", "text"), k), "sets")
    links = materialise(_verify(pairs, sets, above, below), "links")
    comp = materialise(components(links).select(F.col("vertex").alias("id"), "component"), "components")
    more = materialise(_rest(entries.select("bucket", "id"), hubs, comp, vertices, sets, above, below, bands * rows), "links")
    if not more.isEmpty():
        comp = materialise(components(links.unionByName(more)).select(F.col("vertex").alias("id"), "component"), "components")
    least = vertices.select("id", "least").join(comp, "id").groupBy("component").agg(F.min("least").alias("name"))
    comp = materialise(comp.join(least, "component").select("id", "name"), "names")
    named = vertices.select("h1", "h2", "id", "least").join(comp, "id", "left").select(
        "h1", "h2", F.coalesce("name", "least").alias("component"))
    return sketched.select("uid", "doc_id", "n_shingles", "h1", "h2").join(named, ["h1", "h2"], "left").select(
        "uid", "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs, k=3, above=85, below=100)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, above: int = 80, below: int = 100) -> DataFrame:
    """``docs`` without the documents whose group holds a smaller doc_id; rows with a null id stay, as do all rows of a group
    that have its smallest doc_id."""
    key = fresh(docs, "__uid")
    keyed = with_row_ids(docs, key)
    found = _groups(pick(keyed, doc_id="doc_id", text="text", uid=key), k, above, below)
    gone = found.where("doc_id != component_id").select(F.col("uid").alias(key)).distinct()
    return keyed.join(gone, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
