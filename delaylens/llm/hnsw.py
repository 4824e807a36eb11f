"""Nearest neighbours by inner product, with a navigable small-world graph per shard.

Distinct vectors are dealt to shards by a hash; each shard's graph is built by
one task from at most about SHARD_ROWS vectors, in numpy, and kept as flat
neighbour arrays in one row of the index table. Every query visits every shard,
in blocks of queries; the shards' best are scored exactly in double precision
and merged. Equal vectors are one node, with their ids aside, so large groups of
copies neither bend the graph nor crowd a search.

Largest inner product becomes nearest neighbour by one more component that gives
all of a shard's vectors the same length (queries have 0 there).

Nodes are ordered by level, highest first: the nodes of a level are a prefix, and
its neighbour array needs no look-up table. Levels are built from the top, in
batches that search the graph so far together, one step at a time.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaylens.session import stage

SHARD_ROWS = 8192
#: Links of a node (twice as many on the lowest level), and beam widths.
LINKS = 16
BUILD_BEAM = 64
#: Entry points that a level hands to the one below.
ENTRIES = 16
SEARCH_BEAM = 160
#: Queries that one task searches in one shard.
QUERY_BLOCK = 4096
#: Nodes inserted together at most, and queries in one lockstep.
BATCH = 256
#: Beam entries expanded in one step.
STRIDE = 4


@dataclass
class Graph:
    """Vectors (lengthened to equal norm) in level order, and for each level,
    lowest first, the neighbours of its nodes; -1 fills up."""

    vectors: np.ndarray
    levels: list[np.ndarray]

    def descend(self, queries: np.ndarray, to_level: int) -> np.ndarray:
        """Entry points on `to_level`: the nearest found on the levels above."""
        entry = np.zeros((len(queries), 1), np.int64)
        for level in range(len(self.levels) - 1, to_level, -1):
            entry, _ = search_level(self.vectors, self.levels[level], queries, entry, ENTRIES)
        return entry

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """The nodes nearest to each query, nearest first; -1 fills up."""
        if len(self.vectors) <= 2 * beam:  # a small shard is scanned
            return np.argsort(-(queries @ self.vectors.T), axis=1, kind="stable")[:, :beam]
        return search_level(self.vectors, self.levels[0], queries, self.descend(queries, 0), beam)[0]


def similarity(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
    return np.matmul(vectors[ids], queries[:, :, None])[:, :, 0]


def search_level(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """A beam search of all queries in lockstep: in each step every query expands
    its best entries that are not expanded yet, until all of its beam is.
    Returns ids and similarities, best first."""
    n, width = len(queries), max(beam, entry.shape[1])
    ids = np.full((n, width), -1, np.int64)
    near = np.full((n, width), -np.inf, np.float32)
    done = np.ones((n, width), bool)
    ids[:, : entry.shape[1]] = entry
    near[:, : entry.shape[1]] = np.where(entry >= 0, similarity(vectors, entry, queries), -np.inf)
    done[:, : entry.shape[1]] = entry < 0
    seen = np.zeros((n, len(links)), bool)
    rows, columns = np.nonzero(entry >= 0)
    seen[rows, entry[rows, columns]] = True
    active = np.arange(n)
    while len(active):
        waiting = np.where(done[active], -np.inf, near[active])
        pick = np.argpartition(-waiting, min(STRIDE, width) - 1, axis=1)[:, :STRIDE]
        chosen = np.take_along_axis(waiting, pick, axis=1) > -np.inf
        go = chosen.any(axis=1)
        active, pick, chosen = active[go], pick[go], chosen[go]
        if not len(active):
            break
        local = np.arange(len(active))[:, None]
        done[active[:, None], pick] = True
        found = np.where(chosen[:, :, None], links[ids[active[:, None], pick]], -1).reshape(len(active), -1)
        found = np.sort(found, axis=1)
        fresh = found >= 0
        fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
        fresh &= ~seen[active[:, None], np.maximum(found, 0)]
        at, _ = np.nonzero(fresh)
        seen[active[at], found[fresh]] = True
        score = np.where(fresh, similarity(vectors, np.maximum(found, 0), queries[active]), -np.inf)
        all_ids = np.concatenate([ids[active], np.where(fresh, found, -1)], axis=1)
        all_near = np.concatenate([near[active], score], axis=1)
        all_done = np.concatenate([done[active], ~fresh], axis=1)
        best = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
        ids[active], near[active], done[active] = all_ids[local, best], all_near[local, best], all_done[local, best]
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)


def diverse(vectors: np.ndarray, ids: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """From candidates (best first, -1 fills up) at most `links` per row: those
    nearer to the row's node than to any already kept, then the best others."""
    rows, width = ids.shape
    if width <= links:
        return ids
    points = vectors[np.maximum(ids, 0)]
    between = np.matmul(points, points.transpose(0, 2, 1))
    to_kept = np.full((rows, width), -np.inf, np.float32)
    kept = np.zeros((rows, width), bool)
    count = np.zeros(rows, np.int64)
    for j in range(width):
        take = (ids[:, j] >= 0) & (to_kept[:, j] < near[:, j]) & (count < links)
        kept[:, j] = take
        count += take
        to_kept[take] = np.maximum(to_kept[take], between[take, j])
    rank = np.where(kept, np.arange(width), np.where(ids >= 0, width, 2 * width) + np.arange(width))
    order = np.argsort(rank, axis=1)[:, :links]
    return np.take_along_axis(ids, order, axis=1)


def link_back(vectors: np.ndarray, links: np.ndarray, sources: np.ndarray, targets: np.ndarray) -> None:
    """Adds source to the neighbours of each target; full lists are chosen anew."""
    if not len(targets):
        return
    width = links.shape[1]
    order = np.argsort(targets, kind="stable")
    targets, sources = targets[order], sources[order]
    node, first, count = np.unique(targets, return_index=True, return_counts=True)
    for at in range(0, len(node), 512):
        part = slice(at, at + 512)
        most = int(count[part].max())
        new = np.full((len(node[part]), most), -1, np.int64)
        place = np.arange(most)
        inside = place < count[part][:, None]
        new[inside] = sources[(first[part][:, None] + place)[inside]]
        both = np.concatenate([links[node[part]], new], axis=1)
        near = np.where(both >= 0, similarity(vectors, np.maximum(both, 0), vectors[node[part]]), -np.inf)
        best = np.argsort(-near, axis=1, kind="stable")[:, : 2 * width]
        links[node[part]] = diverse(vectors, np.take_along_axis(both, best, axis=1), np.take_along_axis(near, best, axis=1), width)


def build(vectors: np.ndarray, seed: int = 3) -> tuple[Graph, np.ndarray]:
    """The graph over vectors of any lengths, and the order of its nodes."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(LINKS)).astype(int), 6)
    order = np.argsort(-level, kind="stable")
    level = level[order]
    norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
    extra = np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0))
    x = np.column_stack([vectors, extra]).astype(np.float32)[order]
    graph = Graph(x, [np.zeros((0, 0), np.int64)] * (int(level.max(initial=0)) + 1))
    if n <= 2 * SEARCH_BEAM:
        return Graph(x, [np.full((n, 1), -1, np.int64)]), order
    for lv in range(len(graph.levels) - 1, -1, -1):
        size = int((level >= lv).sum())
        width = LINKS * (2 if lv == 0 else 1)
        links = np.full((size, width), -1, np.int64)
        graph.levels[lv] = links
        at = 0
        while at < size:
            batch = min(BATCH, max(32, at // 2), size - at)
            new = np.arange(at, at + batch)
            own = x[new] @ x[new].T
            np.fill_diagonal(own, -np.inf)
            few = min(LINKS, batch - 1)
            mates = np.argsort(-own, axis=1)[:, :few]
            ids, near = new[mates], np.take_along_axis(own, mates, axis=1)
            if at:
                old, old_near = search_level(x, links, x[new], graph.descend(x[new], lv), BUILD_BEAM)
                ids, near = np.concatenate([ids, old], axis=1), np.concatenate([near, old_near], axis=1)
            best = np.argsort(-near, axis=1, kind="stable")
            ids, near = np.take_along_axis(ids, best, axis=1), np.take_along_axis(near, best, axis=1)
            chosen = diverse(x, ids, near, LINKS)
            links[new, : chosen.shape[1]] = chosen
            here = chosen >= 0
            back = np.repeat(new, here.sum(axis=1)), chosen[here]
            # mates that chose each other are linked already
            known = (links[back[1]] == back[0][:, None]).any(axis=1)
            link_back(x, links, back[0][~known], back[1][~known])
            at += batch
    return graph, order


def pack(graph: Graph, ids: np.ndarray, original: np.ndarray) -> bytes:
    """One shard as bytes: ids and original vectors in node order, the
    lengthened vectors, and each level's flat neighbours."""
    out = io.BytesIO()
    np.savez(out, ids=ids, original=original, vectors=graph.vectors, **{f"level{i}": x.astype(np.int32) for i, x in enumerate(graph.levels)})
    return out.getvalue()


def unpack(data: bytes) -> tuple[Graph, np.ndarray, np.ndarray]:
    with np.load(io.BytesIO(data)) as kept:
        levels = [kept[f"level{i}"].astype(np.int64) for i in range(sum(k.startswith("level") for k in kept.files))]
        return Graph(kept["vectors"], levels), kept["ids"], kept["original"]


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def points(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector): one row per id; rows without an id or a usable vector are
    left out, and of several rows with an id the smallest vector stays."""
    good = df.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))
    return good.groupBy("id").agg(F.min("vector").alias("vector"))


def index(nodes: DataFrame, shards: int) -> DataFrame:
    """(dimension, shard, graph) of nodes(node, vector): one row per shard."""

    def make(group: pa.Table) -> pa.Table:
        ids, x = group.column("node").to_numpy(), matrix(group.column("vector"))
        start = np.argsort(ids)  # whatever order the rows came in
        ids, x = ids[start], x[start]
        graph, order = build(x)
        data = pack(graph, ids[order], x[order])
        return pa.table({"dimension": [x.shape[1]], "shard": [group.column("shard")[0].as_py()], "graph": pa.array([data], pa.binary())}, schema=kind)

    kind = pa.schema([("dimension", pa.int32()), ("shard", pa.int32()), ("graph", pa.binary())])
    dealt = nodes.select("node", "vector", F.size("vector").alias("dimension"), F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"))
    return dealt.groupBy("dimension", "shard").applyInArrow(make, "dimension int, shard int, graph binary")


def search_shards(queries: DataFrame, graphs: DataFrame, shards: int, blocks: int, k: int, beam: int) -> DataFrame:
    """(query, node, score): each query's k best nodes of each shard."""
    kind = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])

    def run(asked: pa.Table, kept: pa.Table) -> pa.Table:
        if not asked.num_rows or not kept.num_rows:
            return kind.empty_table()
        graph, ids, original = unpack(kept.column("graph")[0].as_py())
        original = original.astype(np.float64)
        query, x = asked.column("query").to_numpy(), matrix(asked.column("vector"))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(query), BATCH):
            q = x[at : at + BATCH].astype(np.float64)
            lengthened = np.column_stack([q, np.zeros(len(q))]).astype(np.float32)
            found = graph.search(lengthened, beam)
            row, column = np.nonzero(found >= 0)
            node = found[row, column]
            score = np.einsum("ij,ij->i", original[node], q[row])
            best = np.lexsort((ids[node], -score, row))
            row, node, score = row[best], node[best], score[best]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            top = place < k
            out.append((query[at + row[top]], ids[node[top]], score[top]))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], schema=kind)

    spread = queries.select(
        F.col("id").alias("query"), "vector", F.size("vector").alias("dimension"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
    )
    copies = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    by = ["dimension", "shard", "block"]
    return spread.groupBy(*by).cogroup(copies.groupBy(*by)).applyInArrow(run, "query long, node long, score double")


def search(df: DataFrame, key: str, vector: str, is_query: Column, k: int, shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows nearest to each query row,
    every other row being a candidate; equal scores by smaller id. With fewer
    candidates all are given. Vectors are compared with those of their length.

    Null ids, and vectors that are null, zero or hold a null or non-finite
    component, take no part; rows that repeat an id count once. An empty table,
    or one without queries, gives no rows. Other columns are not read."""
    rows = stage(points(df, key, vector), "points")
    nodes = stage(rows.groupBy("vector").agg(F.min("id").alias("node"), F.count("*").alias("copies")), "nodes")
    n = nodes.count()
    shards = max(1, -(-n // shard_rows))
    graphs = stage(index(nodes, shards), "graphs")
    queries = rows.where(is_query)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    # one node more than k: the query's own may be among them
    found = search_shards(queries, graphs, shards, blocks, k + 1, beam)
    best_nodes = found.withColumn("place", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "node"))).where(F.col("place") <= k + 1)
    # of equal vectors the k + 1 smallest ids are enough for any query
    shared = rows.join(nodes.where("copies > 1").select("vector", "node"), "vector").select("node", F.col("id").alias("vec_id"))
    members = shared.withColumn("place", F.row_number().over(W.partitionBy("node").orderBy("vec_id"))).where(F.col("place") <= k + 1).drop("place")
    expanded = best_nodes.drop("place").join(members, "node", "left").withColumn("vec_id", F.coalesce("vec_id", "node")).where("vec_id <> query")
    ranked = expanded.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
