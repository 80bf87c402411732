"""Centroid clustering of integer vectors through a vantage-point tree of the centroids.

A component x counts as the integer floor(SCALE * x). Each round builds a vantage-point
tree over the centroids and broadcasts it; tasks search it best-first for many vectors at
a time, one tree node of each vector per step, and prune a node only where its bound is
beyond the nearest distance found so far, so that equal distances are all seen and go to
the smaller number. Distances are exact integers; only bounds are rounded, and they are
loosened by more than the rounding. Tasks send sums per centroid and component, which are
added exactly; the driver gets k times the dimension of them, however large the table.

Vectors take part if they have exactly ``dim`` components, none null or non-finite; all
others, null vectors too, are left out. Rows that repeat an id are vectors of their own;
rows without one are clustered but never start a centroid. Where starts tie by hash (the
same id), the smaller vector goes first. With fewer than k vectors there are fewer
centroids. Components are those of single floats: a double beyond their range counts as
non-finite. Vectors with components too large for 64-bit sums are searched in Python's
integers; a distance or sum that no long holds is null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from ratelake.llm.common import stored

SCALE = 64
LEAF = 3  # centroids that a tree node holds without a further split
SAFE = 1 << 26  # components up to here keep squared distances of WIDE components in 64 bits
WIDE = 256
SLACK = 1e-9  # relative loosening of rounded bounds
LIMB = 10**18  # sums travel as multiples of this and a rest
LONG = (1 << 63) - 1


@dataclass
class Node:
    """Centroids of a node: the vantage point and, beyond a leaf, two children with the
    least and greatest distance of their centroids from it."""

    numbers: list[int]
    children: list[tuple[int, float, float]]


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return (gap * gap).sum(axis=-1)


def _root(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(np.asarray(squared, np.float64))


def tree(centroids: np.ndarray) -> list[Node]:
    """Nodes of the vantage-point tree; the first is the root. The vantage point of a node
    is its centroid that spreads the others' distances widest."""
    nodes: list[Node] = []

    def grow(numbers: list[int]) -> int:
        at = len(nodes)
        nodes.append(Node(numbers, []))
        if len(numbers) <= LEAF:
            return at
        own = centroids[numbers]
        gaps = [_root(_squared(own, c)) for c in own]
        best = max(range(len(numbers)), key=lambda i: (gaps[i].std(), -numbers[i]))
        rest = [(g, n) for i, (g, n) in enumerate(zip(gaps[best].tolist(), numbers)) if i != best]
        rest.sort()
        middle = len(rest) // 2
        nodes[at].numbers = [numbers[best]]
        for half in (rest[:middle], rest[middle:]):
            child = grow([n for _, n in half])
            nodes[at].children.append((child, half[0][0], half[-1][0]))
        return at

    if len(centroids):
        grow(list(range(len(centroids))))
    return nodes


def assign(vectors: np.ndarray, centroids: np.ndarray, nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector."""
    count = len(vectors)
    number = np.full(count, len(centroids))
    nearest = np.full(count, -1, vectors.dtype)
    radius = np.full(count, np.inf)
    bounds = np.full((count, len(nodes)), np.inf)
    bounds[:, 0] = 0
    searching = np.arange(count)
    while len(searching):
        pick = bounds[searching].argmin(axis=1)
        open_ = bounds[searching, pick] <= radius[searching]
        searching, pick = searching[open_], pick[open_]
        for at in np.unique(pick):
            rows = searching[pick == at]
            bounds[rows, at] = np.inf
            node, to_point = nodes[at], None
            for n in node.numbers:
                squared = _squared(vectors[rows], centroids[n])
                to_point = _root(squared) if to_point is None else to_point
                nearer = (nearest[rows] < 0) | (squared < nearest[rows]) | ((squared == nearest[rows]) & (n < number[rows]))
                changed = rows[nearer.astype(bool)]
                number[changed], nearest[changed] = n, squared[nearer.astype(bool)]
                radius[changed] = _root(nearest[changed]) * (1 + SLACK)
            for child, low, high in node.children:
                gap = np.maximum(low - to_point, to_point - high)
                bounds[rows, child] = np.maximum(0, gap - SLACK * (to_point + high))
        if not len(searching):
            break
    return number, nearest


def _integers(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors scaled, as 64-bit integers, and which rows do not fit those."""
    flat = batch.column("_v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    scaled = np.floor(flat.astype(np.float64) * SCALE)
    large = (np.abs(scaled) > SAFE).any(axis=1)
    return np.where(large[:, None], 0, scaled).astype(np.int64), large


def _exact(batch: pa.RecordBatch, row: int) -> np.ndarray:
    return np.array([math.floor(SCALE * x) for x in batch.column("_v")[row].as_py()], object)


def _assigned(batch: pa.RecordBatch, centroids: list[list[int]], nodes: list[Node]):
    """Per row: scaled vector (object rows for large ones), centroid, squared distance."""
    dim = len(centroids[0])
    vectors, large = _integers(batch, dim)
    small = max((abs(x) for c in centroids for x in c), default=0) <= SAFE and dim <= WIDE
    number = np.zeros(len(vectors), np.int64)
    distance: list[int] = [0] * len(vectors)
    exact: dict[int, np.ndarray] = {}
    fast = np.flatnonzero(~large) if small else np.zeros(0, np.int64)
    if len(fast):
        own, gaps = assign(vectors[fast], np.array(centroids, np.int64), nodes)
        number[fast] = own
        for i, d in zip(fast.tolist(), gaps.tolist()):
            distance[i] = d
    for i in np.setdiff1d(np.arange(len(vectors)), fast).tolist():
        exact[i] = _exact(batch, i)
        own, gaps = assign(exact[i][None, :], np.array(centroids, object), nodes)
        number[i], distance[i] = own[0], int(gaps[0])
    return vectors, exact, number, distance


def _usable(v: Column, dim: int) -> Column:
    plain = v.cast("array<float>")
    return v.isNotNull() & (F.size(v) == dim) & F.forall(
        plain, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )


def _sums(vectors: DataFrame, shared, dim: int) -> list[tuple[int, list[int]]]:
    """(count, exact sum of each component) of every centroid."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, nodes = shared.value
        counts = [0] * len(centroids)
        sums = np.zeros((len(centroids), dim), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, exact, number, _ = _assigned(batch, centroids, nodes)
            for n in np.unique(number).tolist():
                counts[n] += int((number == n).sum())
                sums[n] += rows[number == n].sum(axis=0).astype(object)
            for i, row in exact.items():
                sums[number[i]] += row - rows[i].astype(object)
        made = [(n, j, counts[n], *divmod(int(sums[n][j]), LIMB)) for n in range(len(centroids)) if counts[n] for j in range(dim)]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38), pa.decimal128(38)]
        names = ["cluster", "component", "n", "high", "low"]
        columns = list(zip(*made)) if made else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array([Decimal(x) for x in c] if pa.types.is_decimal(k) else c, k) for c, k in zip(columns, kinds)],
            names=names,
        )

    total = (
        vectors.select("_v")
        .mapInArrow(add, "cluster int, component int, n bigint, high decimal(38,0), low decimal(38,0)")
        .groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    )
    out = [(0, [0] * dim) for _ in shared.value[0]]
    for row in total.collect():  # at most k * dim rows
        own = out[row["cluster"]][1]
        own[row["component"]] = int(row["high"]) * LIMB + int(row["low"])
        out[row["cluster"]] = (row["n"], own)
    return out


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, seed: int = 1,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of
    every vector that takes part."""
    spark = vectors.sparkSession
    given = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("_v"))
    given = given.filter(_usable(F.col("_v"), dim)).withColumn("_v", F.col("_v").cast("array<float>"))
    kept = stored(given, "centroid-vectors")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = kept.filter(F.col("vec_id").isNotNull()).orderBy(hashed, "_v").limit(k).collect()
    centroids = [[math.floor(SCALE * x) for x in row["_v"]] for row in starts]

    def shared():
        return spark.sparkContext.broadcast((centroids, tree(np.array(centroids, object))))

    for _ in range(rounds if centroids else 0):
        sent = shared()
        for n, (count, sums) in enumerate(_sums(kept, sent, dim)):
            if count:
                centroids[n] = [s // count for s in sums]
        sent.destroy()

    sent = shared()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, nodes = sent.value
        for batch in batches:
            if not batch.num_rows or not own:
                continue
            *_, number, distance = _assigned(batch, own, nodes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number, pa.int32()),
                 pa.array([d if d <= LONG else None for d in distance], pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    schema = kept.select("vec_id").schema.add("cluster", IntegerType()).add("distance", LongType())
    placed = stored(kept.mapInArrow(place, schema), "centroid-assigned")
    sent.destroy()
    whole = F.count("distance") == F.count("*")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = placed.groupBy("cluster").agg(F.when(whole, exact).alias("_sum")).collect()  # at most k rows
    inertia = {row["cluster"]: None if row["_sum"] is None else int(row["_sum"]) for row in per}
    total = None if None in inertia.values() else sum(inertia.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def fits(x):
        return None if x is None or x > LONG else x

    facts = spark.createDataFrame(
        [(n, fits(s), fits(total), digests[n]) for n, s in sorted(inertia.items())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return placed.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
