"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Vectors are dealt to shards of bounded size by a hash of their id. Each shard builds
its own graph: a greedy search from the shard's medoid proposes neighbours of a
vector, pruning with a relaxed distance keeps those that are not already served by a
nearer kept one, and reverse edges are pruned the same way. Queries meet every shard
in blocks, search it with a beam, and the best of all shards is the answer; scores are
cosines of the original vectors in double precision.

Equal vectors are one entry that carries their smallest ids, as many as an answer can
hold; so a vector that fills a third of the table costs one entry, and no row is lost:
further ids could never be among the nearest before those. Entries whose directions agree
on a grid of GRID steps are one node of the graph, since no search can tell them apart;
all entries of all nodes that a search holds are scored. Where the last node held is as
near as the k-th, up to single precision, the search is done again with a wider beam, so a
tie of any size is seen as a whole and goes to the smaller ids.

Vectors that are null, zero, or hold null or non-finite components take no part, as
query or candidate. Rows that repeat an id count once (the smallest vector). Vectors
of another dimension are searched among their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import stored

SHARD = 4096  # vectors of a shard, about
BLOCK = 2048  # queries of a block, about
DEGREE = 24  # edges kept per vector
BEAM = 64  # vectors a search holds
STEP = 4  # vectors expanded at once
RELAX = 1.2  # pruning: an edge goes if RELAX * d(kept, it) <= d(vector, it)
BATCH = 512  # vectors inserted or searched at a time
GRID = 1 << 16  # steps of a unit's component within which directions are one node
TIE = 1e-6  # distances that single precision does not tell apart


def search(unit: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of many queries at once: (node, distance) arrays, nearest first;
    unused places are -1."""
    n, count = len(unit), len(queries)
    beam = min(beam, n)
    nodes = np.full((count, beam), -1)
    distance = np.full((count, beam), np.inf, np.float32)
    done = np.ones((count, beam), bool)
    seen = np.zeros((count, n), bool)
    row = np.arange(count)
    nodes[:, 0], done[:, 0], seen[:, start] = start, False, True
    distance[:, 0] = 1 - queries @ unit[start]
    while not done.all():
        cost = np.where(done, np.inf, distance)
        pick = np.argsort(cost, axis=1, kind="stable")[:, :STEP]
        real = np.isfinite(np.take_along_axis(cost, pick, 1))
        np.put_along_axis(done, pick, True, 1)
        expand = np.where(real, np.take_along_axis(nodes, pick, 1), -1)
        near = np.where(expand[:, :, None] >= 0, graph[expand], -1).reshape(count, -1)
        near.sort(axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[row[:, None], near]
        r, c = np.nonzero(fresh)
        found = near[r, c]
        seen[r, found] = True
        gap = np.full(near.shape, np.inf, np.float32)
        gap[r, c] = 1 - np.einsum("ij,ij->i", unit[found], queries[r])
        all_nodes = np.concatenate([nodes, np.where(fresh, near, -1)], 1)
        all_gaps = np.concatenate([distance, gap], 1)
        all_done = np.concatenate([done, ~fresh], 1)
        best = np.argsort(all_gaps, axis=1, kind="stable")[:, :beam]
        nodes = np.take_along_axis(all_nodes, best, 1)
        distance = np.take_along_axis(all_gaps, best, 1)
        done = np.take_along_axis(all_done, best, 1)
    return nodes, distance


def prune(unit: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """Robust pruning of each point's candidate list (-1: none) to ``degree`` edges."""
    valid = (candidates >= 0) & (candidates != points[:, None])
    gap = 1 - np.einsum("ijk,ik->ij", unit[candidates], unit[points])
    gap = np.where(valid, gap, np.inf)
    order = np.argsort(gap, axis=1, kind="stable")
    candidates, gap = np.take_along_axis(candidates, order, 1), np.take_along_axis(gap, order, 1)
    near = unit[candidates]
    between = 1 - near @ near.transpose(0, 2, 1)
    alive = np.isfinite(gap)
    alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    out = np.full((len(points), degree), -1)
    row = np.arange(len(points))
    for k in range(degree):
        if not alive.any():
            break
        first = alive.argmax(axis=1)
        has = alive[row, first]
        out[has, k] = candidates[has, first[has]]
        alive &= ~(has[:, None] & (RELAX * between[row, first] <= gap))
        alive[row, first] = False
    return out


def build(unit: np.ndarray, degree: int = DEGREE) -> tuple[np.ndarray, int]:
    """Graph (n x degree node numbers, -1: none) and start node of a shard."""
    n = len(unit)
    rng = np.random.default_rng(7)
    graph = rng.integers(0, n, (n, degree))
    graph[graph == np.arange(n)[:, None]] = -1
    start = int(np.argmax(unit @ unit.mean(axis=0)))
    order = rng.permutation(n)
    for low in range(0, n, BATCH):
        points = order[low : low + BATCH]
        proposed, _ = search(unit, graph, start, unit[points])
        graph[points] = prune(unit, points, np.concatenate([proposed, graph[points]], 1), degree)
        source = np.repeat(points, degree)
        target = graph[points].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        groups, first, size = np.unique(target, return_index=True, return_counts=True)
        for a in range(0, len(groups), BATCH):
            some, f, s = groups[a : a + BATCH], first[a : a + BATCH], size[a : a + BATCH]
            # A very popular target gets its reverse edges in rounds of equal width.
            for skip in range(0, int(s.max()), degree * 2):
                width = min(degree * 2, int(s.max()) - skip)
                at = skip + np.arange(width)[None, :]
                back = np.where(at < s[:, None], source[np.minimum(f[:, None] + at, len(source) - 1)], -1)
                graph[some] = prune(unit, some, np.concatenate([graph[some], back], 1), degree)
    return graph, start


def search_ties(unit: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, k: int) -> list[np.ndarray]:
    """Nodes held for each query; wider beams where a tie reaches the beam's end."""
    held: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
    rows, beam = np.arange(len(queries)), BEAM
    while len(rows):
        nodes, distance = search(unit, graph, start, queries[rows], beam)
        for j, row in enumerate(rows.tolist()):
            held[row] = nodes[j][nodes[j] >= 0]
        width = nodes.shape[1]
        tied = distance[:, -1] <= distance[:, min(k, width - 1)] + TIE
        rows, beam = rows[tied & (width < len(unit))], beam * 4
    return held


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query row."""
    good = (
        vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v"), is_query.alias("asks"))
        .filter(F.col("vec_id").isNotNull() & _usable(F.col("v")))
        .groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    )
    good = stored(good, "ann-vectors")
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    nodes = (
        good.withColumn("_n", F.row_number().over(by_vector)).filter(F.col("_n") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    counts = good.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    shards = max(1, -(-counts["n"] // SHARD))
    blocks = max(1, -(-counts["q"] // BLOCK))

    def deal(name: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(n)).cast("int")

    def index(table: pa.Table) -> pa.Table:
        v = np.array(table.column("v").to_pylist(), np.float64)
        unit = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
        _, first, node = np.unique(np.round(unit * GRID).astype(np.int32), axis=0, return_index=True, return_inverse=True)
        graph, start = build(unit[first])
        return pa.table({
            "dim": table.column("dim")[:1], "shard": table.column("shard")[:1], "start": pa.array([start], pa.int32()),
            "vectors": pa.array([v.tobytes()], pa.binary()),
            "first": pa.array([first.astype(np.int32).tobytes()], pa.binary()),
            "node": pa.array([node.astype(np.int32).tobytes()], pa.binary()),
            "graph": pa.array([graph.astype(np.int32).tobytes()], pa.binary()),
            "ids": pa.array([table.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
        })

    dealt = nodes.select(
        F.size("v").alias("dim"), deal(F.col("ids")[0], shards).alias("shard"), "v",
        F.col("ids").cast("array<bigint>").alias("ids"),
    )
    graphs = stored(
        dealt.groupBy("dim", "shard").applyInArrow(
            index,
            "dim int, shard int, start int, vectors binary, first binary, node binary, graph binary, ids array<array<bigint>>",
        ),
        "ann-graphs",
    )
    asked = good.filter("asks").select(
        F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        deal(F.col("vec_id"), blocks).alias("block"), F.col("vec_id").alias("query_id").cast("bigint"), "v",
    )
    offered = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            row = left.slice(0, 1).to_pylist()[0]
            v = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
            first, node = (np.frombuffer(row[name], np.int32) for name in ("first", "node"))
            graph = np.frombuffer(row["graph"], np.int32).reshape(len(first), -1)
            norm = np.linalg.norm(v, axis=1)
            unit = (v[first] / norm[first][:, None]).astype(np.float32)
            # Entries by node, and ids by entry.
            by_node, node_at = np.argsort(node, kind="stable"), np.searchsorted(np.sort(node), np.arange(len(first) + 1))
            id_at = np.concatenate([[0], np.cumsum([len(i) for i in row["ids"]])])
            ids = np.array([i for own in row["ids"] for i in own], np.int64)
            for low in range(0, right.num_rows, BATCH):
                part = right.slice(low, BATCH)
                own = part.column("query_id").to_pylist()
                q = np.array(part.column("v").to_pylist(), np.float64)
                q_norm = np.linalg.norm(q, axis=1)
                held = search_ties(unit, graph, row["start"], (q / q_norm[:, None]).astype(np.float32), k)
                for j, query in enumerate(own):
                    some = np.concatenate([by_node[node_at[n] : node_at[n + 1]] for n in held[j]])
                    score = (v[some] * q[j]).sum(axis=1) / (norm[some] * q_norm[j])
                    named = np.concatenate([ids[id_at[e] : id_at[e + 1]] for e in some])
                    score = np.repeat(score, id_at[some + 1] - id_at[some])
                    named, score = named[named != query], score[named != query]
                    best = np.lexsort((named, -score))[:k]
                    found["query_id"] += [query] * len(best)
                    found["vec_id"] += named[best].tolist()
                    found["score"] += score[best].tolist()
        return pa.table(found, pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    keys = ["dim", "shard", "block"]
    partial = offered.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        answer, "query_id bigint, vec_id bigint, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
