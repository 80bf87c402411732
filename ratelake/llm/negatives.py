"""Hard negatives from an inverted multi-index with certified stops.

Rows are dealt to shards of about SHARD vectors by a hash of their id. A shard cuts its
vectors in two halves, makes a codebook of CODES centres for each, and files every vector
in the cell of its two codes. For a query, the best score a cell can hold is the sum of
two half-scores: the inner product with a centre plus the length of the query's half times
the radius of the code. A heap visits the cells of a shard in the order of these sums, and
a search ends where the next sum is below what its answer still lacks. So all answers are
exact; the index only saves work. Codebooks and radii cover every vector of the shard.

First every anchor's nearest rows of its own label are searched (its positives); then, for
each positive, the best rows of other labels whose score s lies in its window
LEAST * p <= 100 * s <= MOST * p, with p the positive's score: all windows of an anchor in
one traversal. Anchors meet shards in blocks of about BLOCK anchors, one packed row each;
what a shard returns is bounded by the numbers asked for, and is reduced before it is
shuffled.

A component x counts as the integer floor(SCALE * x); scores are exact integers, higher
first, ties to the smaller id. Rows without id, label or vector, or with a null or
non-finite component, take no part; nor do those with a component of 2^20 or more, whose
scores a long does not hold for sure. Rows that repeat an id count once (the smallest label,
then vector). Vectors of another length are searched among their own. A positive with a
negative score has an empty window. An anchor without positives, and a positive without
negatives, give no rows, nor does an empty table. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import stored

SCALE = 256
LEAST, MOST = 30, 90  # a negative's score in hundredths of the positive's
SHARD = 8192  # vectors of a shard, about
BLOCK = 2048  # anchors of a block, about
CODES = 16  # centres of a half
ROUNDS = 6  # of the codebooks' training
TOGETHER = 256  # vectors scored at a time
SLACK = 1e-9  # relative loosening of rounded bounds
EXACT = 1 << 53  # products below this are exact in double precision


def codebook(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centres, code of each vector, radius of each code) of a half."""
    rng = np.random.default_rng(5)
    centres = half[rng.permutation(len(half))[:CODES]].astype(np.float64)
    code = np.zeros(len(half), np.int64)
    for _ in range(ROUNDS):
        code = (half @ centres.T * 2 - (centres * centres).sum(axis=1)).argmax(axis=1)
        for c in np.unique(code):
            centres[c] = half[code == c].mean(axis=0)
    code = (half @ centres.T * 2 - (centres * centres).sum(axis=1)).argmax(axis=1)
    radius = np.zeros(len(centres))
    np.maximum.at(radius, code, np.sqrt(((half - centres[code]) ** 2).sum(axis=1)))
    return centres, code, radius


class Index:
    """A shard: vectors sorted by cell, and for each cell the range of its rows."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.middle = vectors.shape[1] // 2
        real = vectors.astype(np.float64)
        self.books, codes = [], []
        for half in (real[:, : self.middle], real[:, self.middle :]):
            centres, code, radius = codebook(half)
            self.books.append((centres, radius))
            codes.append(code)
        self.width = len(self.books[1][0])
        cell = codes[0] * self.width + codes[1]
        order = np.lexsort((ids, cell))
        self.vectors, self.real = vectors[order], real[order]
        self.ids, self.labels = ids[order], labels[order]
        self.ends = np.searchsorted(cell[order], np.arange(len(self.books[0][0]) * self.width + 1))
        self.greatest = int(np.abs(vectors).max(initial=0))

    def cells(self, query: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound on the scores of this and all later cells, first row, row after) of the
        cells that hold rows, best bound first."""
        halves = (query[: self.middle].astype(np.float64), query[self.middle :].astype(np.float64))
        bounds, orders = [], []
        for half, (centres, radius) in zip(halves, self.books):
            length = np.sqrt(half @ half)
            reach = length * (radius + np.sqrt((centres * centres).sum(axis=1)))
            bound = centres @ half + length * radius + SLACK * (1 + reach)
            order = np.argsort(-bound, kind="stable")
            orders.append(order.tolist())
            bounds.append(bound[order].tolist())
        (first, second), (rows, columns) = bounds, orders
        heap = [(-(first[0] + second[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < len(second):
                heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(first):
                heapq.heappush(heap, (-(first[i + 1] + second[0]), i + 1, 0))
            cell = rows[i] * self.width + columns[j]
            if self.ends[cell] < self.ends[cell + 1]:
                yield -bound, int(self.ends[cell]), int(self.ends[cell + 1])

    def scored(self, query: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """(bound on all later scores, rows, their exact scores), some cells at a time."""
        greatest = int(np.abs(query).max(initial=0))
        plain = greatest * self.greatest * max(1, len(query)) < EXACT
        vectors, query_ = (self.real, query.astype(np.float64)) if plain else (self.vectors, query)

        def score(ranges):
            rows = np.concatenate([np.arange(a, b) for a, b in ranges])
            return rows, (vectors[rows] @ query_).astype(np.int64)

        held, ranges = 0, []
        for bound, a, b in self.cells(query):
            if held >= TOGETHER:
                yield bound, *score(ranges)
                held, ranges = 0, []
            ranges.append((a, b))
            held += b - a
        if ranges:
            yield -np.inf, *score(ranges)


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def positives(index: Index, query: np.ndarray, own: int, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows of the label other than the anchor itself."""
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for bound, rows, found in index.scored(query):
        fits = (index.labels[rows] == label) & (index.ids[rows] != own)
        ids, scores = _first(np.append(ids, index.ids[rows[fits]]), np.append(scores, found[fits]), k)
        if len(ids) == k and scores[-1] > bound:
            break
    return ids, scores


def window(positive: int) -> tuple[int, int]:
    """Least and greatest score of a negative of this positive score; empty below zero."""
    return -(-LEAST * positive // 100), MOST * positive // 100


def negatives(index: Index, query: np.ndarray, label: int, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of the k best rows of other labels within each window."""
    none = np.zeros(0, np.int64)
    best = [(none, none) for _ in windows]
    pending = [i for i, (low, high) in enumerate(windows) if low <= high]
    if not pending:
        return best
    for bound, rows, found in index.scored(query):
        other = index.labels[rows] != label
        ids, scores = index.ids[rows[other]], found[other]
        still = []
        for i in pending:
            low, high = windows[i]
            fits = (scores >= low) & (scores <= high)
            if fits.any():
                best[i] = _first(np.append(best[i][0], ids[fits]), np.append(best[i][1], scores[fits]), k)
            done = bound < low or (len(best[i][0]) == k and best[i][1][-1] > bound)
            if not done:
                still.append(i)
        pending = still
        if not pending:
            break
    return best


def _usable(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 20)))


def _packed(v: pa.Array, dim: int) -> bytes:
    flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).astype(np.int32).reshape(-1, dim).tobytes()


_SHARDS = "dim int, part int, vectors binary, ids binary, labels binary"


def _pack(table: pa.Table) -> pa.Table:
    """A group of rows of one length as one row of packed arrays, sorted by id."""
    table = table.combine_chunks().sort_by("id")
    dim = table.column("dim")[0].as_py()
    packed = _packed(table.column("v").combine_chunks(), dim) if dim else b""
    return pa.table({
        "dim": table.column("dim")[:1], "part": table.column("part")[:1],
        "vectors": pa.array([packed], pa.binary()),
        "ids": pa.array([table.column("id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
        "labels": pa.array([table.column("label").to_numpy().astype(np.int64).tobytes()], pa.binary()),
    })


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    vectors = np.frombuffer(row["vectors"], np.int32).reshape(len(ids), row["dim"]).astype(np.int64)
    return vectors, ids, np.frombuffer(row["labels"], np.int64)


def _first_of(table: pa.Table) -> dict | None:
    return table.slice(0, 1).to_pylist()[0] if table.num_rows else None


def _find_positives(k: int):
    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = []
        shard, block = _first_of(left), _first_of(right)
        if shard and block:
            index = Index(*_unpack(shard))
            for query, own, label in zip(*_unpack(block)):
                ids, scores = positives(index, query, own, label, k)
                out += [(int(own), i, s) for i, s in zip(ids.tolist(), scores.tolist())]
        names = ["anchor_id", "positive_id", "positive_score"]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 3)], names=names)

    return find


def _find_negatives(k: int):
    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = []
        shard, block = _first_of(left), _first_of(right)
        if shard and block:
            index = Index(*_unpack(shard))
            wanted = dict(zip(np.frombuffer(block["anchors"], np.int64).tolist(), block["scores"]))
            for query, own, label in zip(*_unpack(block)):
                asked = wanted.get(int(own), [])
                found = negatives(index, query, label, [window(p) for p in asked], k)
                for p, (ids, scores) in zip(asked, found):
                    out += [(int(own), p, i, s) for i, s in zip(ids.tolist(), scores.tolist())]
        names = ["anchor_id", "positive_score", "negative_id", "negative_score"]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 4)], names=names)

    return find


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, n_positives: int = 5, n_negatives: int = 10,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score."""
    good = (
        vectors.select(
            F.col(vec_id).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
            F.col(embedding).alias("v"), is_anchor.alias("asks"),
        )
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("v")))
        .groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"), F.max("asks").alias("asks"))
        .select("id", "row.label", "row.v", "asks", F.size("row.v").alias("dim"))
    )
    good = stored(good, "negatives-vectors")
    size = good.agg(F.count("*").alias("n"), F.count_if("asks").alias("a")).first()
    shards, blocks = max(1, -(-size["n"] // SHARD)), max(1, -(-size["a"] // BLOCK))

    def packed(rows: DataFrame, parts: int) -> DataFrame:
        dealt = rows.select("dim", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "id", "label", "v")
        return dealt.groupBy("dim", "part").applyInArrow(_pack, _SHARDS)

    index = stored(packed(good, shards), "negatives-shards")
    anchors = stored(packed(good.filter("asks"), blocks), "negatives-anchors")

    def met(block_rows: DataFrame, find, schema: str) -> DataFrame:
        """Every block of anchors with every shard of its length, one task each."""
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = index.withColumnRenamed("part", "shard").withColumn("block", each(blocks))
        right = block_rows.withColumnRenamed("part", "block").withColumn("shard", each(shards))
        keys = ["dim", "shard", "block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(find, schema)

    by_anchor = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    chosen = stored(
        met(anchors, _find_positives(n_positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
        .withColumn("_n", F.row_number().over(by_anchor)).filter(F.col("_n") <= n_positives).drop("_n"),
        "negatives-positives",
    )
    asked = (
        good.filter("asks").select(F.col("id").alias("anchor_id"), "dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("part"))
        .join(chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_set("positive_score")).alias("p")), "anchor_id")
        .groupBy("dim", "part").agg(F.sort_array(F.collect_list(F.struct("anchor_id", "p"))).alias("w"))
    )

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                w = row.column("w")[0].as_py()
                names = ["dim", "part", "vectors", "ids", "labels"]
                anchors_ = np.array([x["anchor_id"] for x in w], np.int64).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [row.column(n) for n in names]
                    + [pa.array([anchors_], pa.binary()), pa.array([[x["p"] for x in w]], pa.list_(pa.list_(pa.int64())))],
                    names=[*names, "anchors", "scores"],
                )

    blocks_asked = anchors.join(asked, ["dim", "part"]).mapInArrow(
        wanted, _SHARDS + ", anchors binary, scores array<array<bigint>>"
    )
    found = met(
        stored(blocks_asked, "negatives-asked"), _find_negatives(n_negatives),
        "anchor_id bigint, positive_score bigint, negative_id bigint, negative_score bigint",
    )
    by_score = Window.partitionBy("anchor_id", "positive_score").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score).cast("int")).filter(F.col("rank") <= n_negatives)
    return chosen.join(ranked, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
