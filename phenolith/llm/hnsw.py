"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, in flat arrays.

Vectors are dealt into shards; each shard's graph is built by one task and stored as one row of flat arrays
(ids, vectors, one neighbour table per level). Queries come in blocks; each (block, shard) is one unit of work,
and the shards' best are merged. Equal vectors enter the graph once, so that copies cannot fill each other's
neighbour lists; their ids are brought back after the search.

Nearness is the largest inner product. The graph works on Euclidean distance, to which inner products are
reduced by one more component, sqrt(largest norm^2 - norm^2), 0 for queries. Nodes are numbered by level, the
highest first, so level l is the first ``sizes[l]`` nodes, and no level needs a list of its nodes.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part,
nor do rows without an id; of rows with one id the smallest vector counts; ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from phenolith.llm.common import materialise, pick

#: Neighbours of a node on upper levels (twice as many on the lowest), and widths of the beams.
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 96, 160
#: Vectors in a shard, and queries in a block, at most about. Recall falls with the size of a shard.
SHARD_ROWS, BLOCK_ROWS, LEAST_SHARDS = 20_000, 1024, 8


def _beam(table: np.ndarray, points: np.ndarray, norms: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int,
          known: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of all queries in step over the first ``known`` nodes; returns nodes and distances (up to the
    query's own norm), nearest first, -1 and infinity where there are fewer."""
    b = len(queries)
    rows = np.arange(b)
    seen = np.zeros((b, known), bool)
    nodes = np.full((b, width), -1)
    far = np.full((b, width), np.inf, np.float32)
    open_ = np.zeros((b, width), bool)

    def add(row: np.ndarray, node: np.ndarray):
        nonlocal nodes, far, open_
        key = np.unique(row * known + node)
        row, node = np.divmod(key, known)
        new = ~seen[row, node]
        row, node = row[new], node[new]
        if not len(row):
            return
        seen[row, node] = True
        d = norms[node] - 2 * np.einsum("ij,ij->i", points[node], queries[row])
        at = np.arange(len(row)) - np.searchsorted(row, row)
        more = int(at.max()) + 1
        all_nodes = np.concatenate([nodes, np.full((b, more), -1)], axis=1)
        all_far = np.concatenate([far, np.full((b, more), np.inf, np.float32)], axis=1)
        all_open = np.concatenate([open_, np.zeros((b, more), bool)], axis=1)
        all_nodes[row, width + at], all_far[row, width + at], all_open[row, width + at] = node, d, True
        best = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        nodes, far, open_ = (np.take_along_axis(x, best, 1) for x in (all_nodes, all_far, all_open))

    ok = entry >= 0
    add(np.broadcast_to(rows[:, None], entry.shape)[ok], entry[ok])
    step = min(4, width)
    while open_.any():
        waiting = np.where(open_, far, np.inf)
        chosen = np.argpartition(waiting, step - 1, axis=1)[:, :step] if step < width else np.broadcast_to(np.arange(width), (b, width))
        ready = np.take_along_axis(open_, chosen, 1)
        from_nodes = np.take_along_axis(nodes, chosen, 1)
        np.put_along_axis(open_, chosen, False, 1)
        row, slot = np.nonzero(ready)
        near = table[from_nodes[row, slot]]
        row = np.repeat(row, near.shape[1])
        near = near.ravel()
        ok = near >= 0
        add(row[ok], near[ok])
    order = np.argsort(far, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(far, order, 1)


def _choose(points: np.ndarray, norms: np.ndarray, nodes: np.ndarray, far: np.ndarray, links: int) -> np.ndarray:
    """Up to ``links`` neighbours of each row's candidates (nearest first; true squared distances): a candidate is
    taken if it is nearer to the node than to all taken before; free places go to the nearest of the others."""
    b, c = nodes.shape
    taken = np.full((b, links), -1)
    count = np.zeros(b, np.int64)
    used = np.zeros((b, c), bool)
    for k in range(c):
        node = nodes[:, k]
        live = np.flatnonzero((node >= 0) & (count < links))
        if not len(live):
            continue
        own = taken[live]
        x = points[node[live]]
        between = norms[own] + norms[node[live]][:, None] - 2 * np.einsum("bmd,bd->bm", points[own], x)
        between[own < 0] = np.inf
        fine = live[far[live, k] < between.min(1)]
        taken[fine, count[fine]] = node[fine]
        used[fine, k] = True
        count[fine] += 1
    for k in range(c):
        live = np.flatnonzero((nodes[:, k] >= 0) & ~used[:, k] & (count < links))
        taken[live, count[live]] = nodes[live, k]
        count[live] += 1
    return taken


def _link(table: np.ndarray, points: np.ndarray, norms: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
    """Writes the new nodes' lists and adds them to their neighbours' lists, which are chosen again when full."""
    links = table.shape[1]
    table[new, : chosen.shape[1]] = chosen
    u, slot = np.nonzero(chosen >= 0)
    v, u = chosen[u, slot], new[u]
    old_v = np.unique(v)
    old = table[old_v]
    row, slot = np.nonzero(old >= 0)
    v, u = np.concatenate([v, old_v[row]]), np.concatenate([u, old[row, slot]])
    pair = np.unique(v * len(points) + u)
    v, u = np.divmod(pair, len(points))
    d = norms[v] + norms[u] - 2 * np.einsum("ij,ij->i", points[v], points[u])
    order = np.lexsort((d, v))
    v, u, d = v[order], u[order], d[order]
    place = np.searchsorted(old_v, v)
    at = np.arange(len(v)) - np.searchsorted(v, v)
    most = int(at.max()) + 1
    nodes, far = np.full((len(old_v), most), -1), np.full((len(old_v), most), np.inf, np.float32)
    nodes[place, at], far[place, at] = u, d
    full = (nodes >= 0).sum(1) > links
    table[old_v[~full]] = -1
    table[old_v[~full], : min(most, links)] = nodes[~full, :links]
    if full.any():
        table[old_v[full]] = _choose(points, norms, nodes[full, : 3 * links], far[full, : 3 * links], links)


def build(vectors: np.ndarray, links: int = LINKS, width: int = BUILD_BEAM, seed: int = 5) -> dict[str, np.ndarray]:
    """order (node -> row of ``vectors``), sizes of the levels (lowest first) and a neighbour table for each."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    level = np.floor(-np.log(1 - rng.random(n)) / np.log(links)).astype(int)
    order = np.argsort(-level, kind="stable")
    level = level[order]
    sizes = np.array([(level >= k).sum() for k in range(level.max(initial=0) + 1)])
    points, norms = _lifted(vectors[order])
    tables = [np.full((m, 2 * links if k == 0 else links), -1) for k, m in enumerate(sizes)]
    done = 0
    while done < n:
        upto = min(n, done + max(64, min(512, done // 4)))
        new = np.arange(done, upto)
        entry = np.zeros((len(new), 1), np.int64)
        for k in range(len(sizes) - 1, -1, -1):
            here, known = new[new < sizes[k]], min(done, sizes[k])
            if known:
                wide = width if len(here) else 1
                nodes, far = _beam(tables[k], points, norms, points[new], entry, wide, known)
                entry = nodes[:, : min(wide, 8)]
            if not len(here):
                continue
            own = norms[here][:, None]
            # nodes of this batch don't find each other in the graph
            among = own + norms[here][None, :] - 2 * points[here] @ points[here].T
            np.fill_diagonal(among, np.inf)
            pick_ = np.argsort(among, axis=1, kind="stable")[:, : min(width, len(here) - 1)]
            all_nodes, all_far = here[pick_], np.take_along_axis(among, pick_, 1)
            if known:
                all_nodes = np.concatenate([all_nodes, nodes[: len(here)]], axis=1)
                all_far = np.concatenate([all_far, far[: len(here)] + own], axis=1)
            best = np.argsort(all_far, axis=1, kind="stable")[:, :width]
            all_nodes, all_far = np.take_along_axis(all_nodes, best, 1), np.take_along_axis(all_far, best, 1)
            if all_nodes.shape[1]:
                _link(tables[k], points, norms, here, _choose(points, norms, all_nodes, all_far, links))
        done = upto
    return {"order": order, "sizes": sizes, **{f"level{k}": t for k, t in enumerate(tables)}}


def _lifted(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = vectors.astype(np.float64)
    scale = np.abs(wide).max(initial=0) or 1.0  # no overflow of squares
    wide /= scale
    square = (wide**2).sum(1)
    last = np.sqrt(np.maximum(square.max(initial=0) - square, 0))
    points = np.concatenate([wide, last[:, None]], axis=1).astype(np.float32)
    return points, np.einsum("ij,ij->i", points, points)


def search(vectors: np.ndarray, graph: dict[str, np.ndarray], queries: np.ndarray, k: int,
           width: int = SEARCH_BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(rows of ``vectors``, inner products in double precision) of the best found, -1 where there are fewer."""
    points, norms = _lifted(vectors[graph["order"]])
    scale = np.abs(queries).max(axis=1, keepdims=True).astype(np.float64)
    asked = np.concatenate([queries / scale, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
    entry = np.zeros((len(queries), 1), np.int64)
    sizes = graph["sizes"]
    for level in range(len(sizes) - 1, -1, -1):
        nodes, _ = _beam(graph[f"level{level}"], points, norms, asked, entry, width if level == 0 else 4, int(sizes[level]))
        entry = nodes
    rows = np.where(nodes >= 0, graph["order"][nodes], -1)
    score = np.einsum("bkd,bd->bk", vectors[rows].astype(np.float64), queries.astype(np.float64))
    score[rows < 0] = -np.inf
    best = np.argsort(-score, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(rows, best, 1), np.take_along_axis(score, best, 1)


def _usable(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    rows = pick(table, vec_id=vec_id, vector=vector).where("vec_id is not null and vector is not null")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.agg(F.max(F.struct("n", "size")).alias("m")).first().m
    rows = rows.where(F.size("vector") == (most["size"] if most else 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    import io

    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    import io

    with np.load(io.BytesIO(raw)) as z:
        return dict(z)


def build_index(rows: DataFrame, shards: int) -> DataFrame:
    """shard, graph (flat arrays: ids, vectors, order, sizes, one neighbour table per level); ``rows``: id, vector."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")  # the graph depends on the order: reruns agree
        vectors = np.stack(pdf["vector"].to_numpy())
        graph = build(vectors)
        small = {k: v.astype(np.int32) if k.startswith("level") else v for k, v in graph.items()}
        return pd.DataFrame({"shard": [key[0]], "graph": [_pack({"ids": pdf["id"].to_numpy(), "vectors": vectors, **small})]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(one, "shard long, graph binary")


def search_index(index: DataFrame, queries: DataFrame, shards: int, n_queries: int, k: int) -> DataFrame:
    """query_id, id, score: the ``k`` best found in each shard; ``queries``: query_id, vector."""
    blocks = max(1, -(-n_queries // BLOCK_ROWS))
    work = (
        queries.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"))
        .agg(F.collect_list(F.struct("query_id", "vector")).alias("queries"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
        .join(index, "shard").select("queries", "graph")
    )

    def run(batches):
        for batch in batches:
            for asked, raw in zip(batch.column(0), batch.column(1)):
                graph = _unpack(raw.as_py())
                own = asked.values
                ids = own.field("query_id").to_numpy()
                vectors = own.field("vector")
                wanted = vectors.flatten().to_numpy().reshape(len(ids), -1)
                rows, score = search(graph["vectors"], graph, wanted, k)
                ok = rows >= 0
                at = np.nonzero(ok)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(graph["ids"][rows[ok]]), pa.array(score[ok])], names=["query_id", "id", "score"])

    return work.mapInArrow(run, "query_id long, id long, score double")


def nearest(table: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose id is divisible by ``every``."""
    rows = materialise(_usable(table, vec_id, vector), "vectors")
    # copies: the smallest k + 1 ids of each vector (one may be the query's own)
    nth = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    members = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    members = materialise(members.withColumn("id", F.min("vec_id").over(W.partitionBy("vector"))), "members")
    distinct = members.where("nth = 1").select("id", "vector")
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    shards = max(LEAST_SHARDS, -(-distinct.count() // SHARD_ROWS))
    index = materialise(build_index(distinct, shards), "index")
    found = search_index(index, queries, shards, queries.count(), k + 1)
    full = found.join(members.select("id", "vec_id"), "id").where("vec_id != query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return full.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
