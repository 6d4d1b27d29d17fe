"""SimHash groups by Golay-code fuzzy hashing.

A fingerprint has 64 bits; bit j is 1 if it is set in over half of the XXH64 hashes (seed 42) of the text's k-word
shingles, repeats included. Fingerprints link at ``MOST`` (4) or fewer differing bits.

1. Equal fingerprints are one vertex from here on: copies are never paired.
2. A fingerprint is cut into four segments of 16 bits. Four errors over four segments leave, by the pigeonhole principle,
   (a) two segments without errors; or (b) one without errors and, among any two of the other three, one with exactly one
   error; or (c) exactly one error in each. Two 16-bit words that differ in one bit have different parity and share a
   Golay codeword: the one of even parity gives the numbers of all codewords within 4 bits of it (1 or 6), the odd one
   that of its nearest. So (a) has 6 keys of 2 segments; (b) keys of a segment and a codeword, over 8 choices; (c) keys of
   three codewords and of which segments' parities equal the first one's (one error in each turns all four): about 62 keys,
   and linked fingerprints share at least one (``tests/llm`` tries all patterns of errors). As a codeword key joins an even
   with an odd segment, keys whose fingerprints are all of one parity there are dropped.
3. Within each key every vertex is compared with one hub, the fingerprint with most copies; links form components.
4. Keys that still hold more than one component are not done. Their vertices outside the key's largest component are
   compared with all others whose component differs, block against block of bounded size, on the full fingerprints; a
   task returns one link for each pair of components at most. No pairs are spelled out, no key meets in one task unless
   it fits one block, and no link is lost. The work of this step grows with the square of the part of a key that is
   linked neither to the key's hub nor through other keys.

Words are runs of anything but ASCII white space, A-Z folded. With fewer than k words the whole sequence is the one
shingle; null and empty texts and texts without words have fingerprint zero, which links like any other. Very long texts
are hashed whole. A row is a vertex through its fingerprint, so repeated rows and one doc_id on two texts give each row its
own fingerprint and component; rows without doc_id link too, but give no component its name (a component of only such
rows is null). Empty tables give empty tables; extra columns of the input don't matter.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenolith.llm.common import materialise, pick
from phenolith.llm.components import components
from phenolith.llm.golay import within_four

#: Differing bits at which fingerprints still link. The keys are made for this number.
MOST = 4
#: Vertices in a block of step 4.
BLOCK = 1024
#: Shingles counted at once.
CHUNK = 1 << 16
#: Fingerprints whose keys are made at once.
KEYED = 2000


def shingle_hashes(raw: bytes, k: int) -> np.ndarray:
    """XXH64 (seed 42) of each k-word shingle, in order (uint64)."""
    words = raw.lower().split()  # of bytes: ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    k = min(k, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n, digest = len(words) - k + 1, xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[k - 1 :].tolist())), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half of ``hashes``."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every row of (doc_id, text)."""

    def run(batches):
        for batch in batches:
            own = np.array([fingerprint(shingle_hashes(t.as_buffer().to_pybytes() if t.is_valid else b"", k))
                            for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.astype(np.int64))], names=["doc_id", "fp"])

    return docs.mapInArrow(run, "doc_id long, fp long")


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ``fps``, key, side) of every key of every fingerprint (uint64 each). Fingerprints that link meet in a key with
    different sides (0 and 1), or in one that has no sides (2 for all)."""
    near, counts = within_four()
    segment = [(fps >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    parity = [np.bitwise_count(x).astype(np.int64) % 2 for x in segment]
    places, keys, sides = [], [], []

    def give(start: np.ndarray, exact: list[int], fuzzy: list[int]) -> None:
        place, key = np.arange(len(fps)), start.astype(np.uint64)
        for i in exact:
            key = key << np.uint64(16) | segment[i].astype(np.uint64)
        for i in fuzzy:
            many = np.where(parity[i][place] == 0, counts[segment[i][place]], 1)
            column = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            place, key = np.repeat(place, many), np.repeat(key, many)
            key = key << np.uint64(12) | near[segment[i][place], column].astype(np.uint64)
        places.append(place)
        keys.append(key)
        sides.append(parity[fuzzy[0]][place] if fuzzy else np.full(len(place), 2))

    kind = itertools.count(1)
    for pair in itertools.combinations(range(4), 2):
        give(np.full(len(fps), next(kind)), list(pair), [])
    for i in range(4):
        for j in [x for x in range(4) if x != i][:2]:
            give(np.full(len(fps), next(kind)), [i], [j])
    alike = sum((parity[i] ^ parity[0]) << (i - 1) for i in (1, 2, 3))
    give(next(kind) << 3 | alike, [], [0, 1, 2])
    return np.concatenate(places), np.concatenate(keys), np.concatenate(sides)


def _keyed(vertices: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            fps, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for lo in range(0, len(fps), KEYED):
                own = fps[lo : lo + KEYED]
                place, key, side = fuzzy_keys(own.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.astype(np.int64)), pa.array(own[place]), pa.array(copies[lo + place]), pa.array(side.astype(np.int8))],
                    names=["key", "fp", "copies", "side"])

    return vertices.select("fp", "copies").mapInArrow(run, "key long, fp long, copies long, side byte")


def _united(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels after linking a[i] with b[i], and which of these links were needed for it."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    needed = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            needed[i] = True
    values, inverse = np.unique(labels, return_inverse=True)
    return np.array([root(int(v)) for v in values], labels.dtype)[inverse], needed


def links_in_groups(group: np.ndarray, fps: np.ndarray, component: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of the same group (``group`` ascending) whose components differ, without those that other
    links returned here make needless. Members are compared at distance 1, 2, ... of their rows, all groups at once."""
    left = np.arange(len(group))
    out_u, out_v = [], []
    step = 1
    while True:
        left = left[left + step < len(group)]
        left = left[group[left] == group[left + step]]
        if not len(left):
            break
        at = left[component[left] != component[left + step]]
        at = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= most]
        if len(at):
            component, needed = _united(component, component[at], component[at + step])
            out_u.append(fps[at[needed]])
            out_v.append(fps[at[needed] + step])
        step += 1
    none = np.zeros(0, fps.dtype)
    return np.concatenate([none, *out_u]), np.concatenate([none, *out_v])


def _between_components(members: DataFrame) -> DataFrame:
    """Links (u, v) between the components that meet in a key; members: key, fp, component, m (rows of the key)."""
    share = members.groupBy("key", "component").agg(F.count("*").alias("n"), F.first("m").alias("m"))
    stats = share.groupBy("key").agg(F.max(F.struct("n", "component")).alias("x"), F.first("m").alias("m")).select(
        "key", F.col("x.component").alias("main"), F.when(F.col("m") <= BLOCK, 0).otherwise(F.ceil(F.col("x.n") / BLOCK)).alias("of_main"),
        F.when(F.col("m") <= BLOCK, 1).otherwise(F.ceil((F.col("m") - F.col("x.n")) / BLOCK)).alias("of_rest"))
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("is_main"), F.col("of_main")).otherwise(F.col("of_rest")))
    dealt = members.drop("m").join(stats, "key").withColumn("is_main", (F.col("component") == F.col("main")) & (F.col("of_main") > 0))
    dealt = dealt.withColumn("block", F.when(F.col("is_main"), F.col("of_rest") + own).otherwise(own))
    # a task compares two blocks, of which one at least is of the rest
    zero = F.lit(0).cast("long")
    last = F.when(F.col("is_main"), F.col("of_rest")).otherwise(F.col("of_rest") + F.col("of_main")) - 1
    tasks = F.transform(F.sequence(zero, last), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    sent = dealt.select("key", "fp", "component", F.explode(tasks).alias("t")).select("key", "t.i", "t.j", "fp", "component")

    def run(batches):
        held: pa.Table | None = None

        def linked(table: pa.Table) -> pa.RecordBatch:
            key, i, j, fps, component = (table.column(c).to_numpy() for c in range(5))
            new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            group = np.concatenate([[0], np.cumsum(new)])
            u, v = links_in_groups(group, fps.astype(np.uint64), component, MOST)
            return pa.RecordBatch.from_arrays([pa.array(u.astype(np.int64)), pa.array(v.astype(np.int64))], names=["u", "v"])

        for batch in batches:
            held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            key, i, j = (held.column(c).to_numpy() for c in range(3))
            same = (key == key[-1:]) & (i == i[-1:]) & (j == j[-1:])
            whole = len(same) - int(same.sum())
            if whole:  # the last group may go on in the next batch
                yield linked(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield linked(held)

    parts = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return sent.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "u long, v long")


def fingerprint_groups(vertices: DataFrame) -> DataFrame:
    """fp, component (a fingerprint of the same component) of every linked one of ``vertices`` (fp, copies; fp distinct)."""
    # one shuffle of all keys: a window counts each key's rows, sees whether its sides meet and finds its hub. A fingerprint
    # has about 62 keys, so that even a key that all of them share is a small part of the rows
    key = Window.partitionBy("key")
    found = _keyed(vertices).select(
        "key", "fp", F.count("*").over(key).alias("m"), F.min("side").over(key).alias("lo"), F.max("side").over(key).alias("hi"),
        F.max(F.struct("copies", "fp")).over(key).alias("x"))
    shared = materialise(found.where("m > 1 and (lo < hi or hi = 2)").select("key", "fp", "m", F.col("x.fp").alias("hub")), "shared-keys")
    links = shared.where((F.col("fp") != F.col("hub")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= MOST))
    links = materialise(links.select(F.col("fp").alias("u"), F.col("hub").alias("v")).distinct(), "hub-links")
    comp = components(links).select(F.col("vertex").alias("fp"), "component")
    labelled = materialise(shared.drop("hub").join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "labelled")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    more = materialise(_between_components(labelled.join(mixed, "key")).distinct(), "more-links")
    if more.isEmpty():
        return comp
    return components(links.unionByName(more)).select(F.col("vertex").alias("fp"), "component")


def simhash_groups(docs: DataFrame, k: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable) of every row."""
    found = materialise(fingerprints(pick(docs, doc_id=doc_id, text=text), k), "fingerprints")
    vertices = materialise(found.groupBy("fp").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least")), "vertices")
    comp = materialise(fingerprint_groups(vertices), "components")
    joined = vertices.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(names, "component").select("fp", "component_id")
    return found.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_digest(docs: DataFrame) -> DataFrame:
    return simhash_groups(docs, k=4)
