"""Quality classifier: random-indexing word vectors, pooled per document, and a
two-layer network with temperature-calibrated probabilities.

A word and its shape (runs of upper, lower, digit; punctuation as it is) each have a
sparse ternary index vector that their hash determines. The vector of a hashed word is
its index vector plus the direction of the sum of its neighbours' index vectors over
the whole corpus; that sum is a matrix of fixed size, added up per task and then over
tasks. A document is the mean of its words' and of its shapes' vectors, with its
length and its share of distinct words.

The network is fitted on at most ``TRAIN_ROWS`` labelled documents, chosen by a hash
of their id; the temperature is set on rows that a network did not see (``FOLDS``
folds). Everything else covers all rows.

Null and empty texts have a zero vector and get a score like any other. Rows without
label, or whose label is null, are scored only; of labels that repeat an id the
largest counts. Without any label every score is 1: nothing is known against a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ratelake.llm.common import mix, pieces, text_bytes, words

BUCKETS = 1 << 14  # hashed words, and as many hashed shapes
DIM = 64
NONZERO = 2  # non-zero components of an index vector
REACH = 2  # neighbours on each side
FOLDS = 3
BLOCKS = 32  # parts of the context matrix, added up separately
TRAIN_ROWS = 20_000
HIDDEN, EPOCHS, STEPS, MINIBATCH, RATE, DECAY = 48, 12, 3000, 64, 0.002, 1e-3  # STEPS: at least
THRESHOLD = 0.7
FEATURES = 2 * DIM + 4

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = _SHAPE[128:] = 1
_SHAPE[ord("A") : ord("Z") + 1] = 2
_SHAPE[ord("0") : ord("9") + 1] = 3


def _index_parts(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the non-zero components, one row per bucket number."""
    seeds = mix(buckets[:, None].astype(np.uint64) * np.uint64(NONZERO) + np.arange(NONZERO, dtype=np.uint64) + np.uint64(11))
    return (seeds % np.uint64(DIM)).astype(np.int64), np.where(seeds >> np.uint64(63), 1.0, -1.0).astype(np.float32)


def tokens(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, shape bucket, row) of every word; shape buckets follow the words'."""
    data, offsets = text_bytes(array)
    hashes, rows, _, _ = words(data, offsets)
    kinds = _SHAPE[data]
    keep = np.ones(len(kinds), bool)
    keep[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] > 3)
    inner = offsets[1:-1]
    keep[inner[inner < len(kinds)]] = True
    shape_hashes, _, _, _ = words(kinds[keep], np.concatenate([[0], np.cumsum(keep)])[offsets])
    n = np.uint64(BUCKETS)
    return (hashes % n).astype(np.int64), (shape_hashes % n).astype(np.int64) + BUCKETS, rows


def _add_context(total: np.ndarray, word: np.ndarray, shape: np.ndarray, rows: np.ndarray, parts) -> None:
    position, sign = parts
    for d in range(1, REACH + 1):
        same = rows[d:] == rows[:-d]
        for own, other in ((np.s_[:-d], np.s_[d:]), (np.s_[d:], np.s_[:-d])):
            for mine in (word, shape):
                for theirs in (word, shape):
                    a, b = mine[own][same], theirs[other][same]
                    at = (a[:, None] * DIM + position[b]).ravel()
                    total += np.bincount(at, sign[b].ravel(), len(total))


def context_matrix(docs: DataFrame) -> np.ndarray:
    """Word vectors: (2 * BUCKETS) x DIM."""
    size = 2 * BUCKETS * DIM // BLOCKS

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _index_parts(np.arange(2 * BUCKETS))
        total = np.zeros(2 * BUCKETS * DIM)
        for batch in pieces(batches, "text", 1 << 22):
            _add_context(total, *tokens(batch.column("text")), parts)
        blocks = [total[k * size : (k + 1) * size].astype(np.float32).tobytes() for k in range(BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array(blocks, pa.binary())], ["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, sums in zip(batch.column("block").to_pylist(), batch.column("sums")):
                part = np.frombuffer(sums.as_buffer(), np.float32).astype(np.float64)
                totals[block] = totals.get(block, 0) + part
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(totals, pa.int32()), pa.array([t.astype(np.float32).tobytes() for t in totals.values()], pa.binary())],
                ["block", "sums"],
            )

    kind = "block int, sums binary"
    sums = docs.select("text").mapInArrow(gather, kind).repartition(BLOCKS, "block").mapInArrow(add, kind)
    matrix = np.zeros((BLOCKS, size), np.float32)
    for row in sums.collect():  # BLOCKS rows of fixed size
        matrix[row["block"]] = np.frombuffer(row["sums"], np.float32)
    matrix = matrix.reshape(2 * BUCKETS, DIM)
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = matrix / np.where(norm > 0, norm, 1)
    position, sign = _index_parts(np.arange(2 * BUCKETS))
    np.add.at(matrix, (np.arange(2 * BUCKETS)[:, None], position), sign)
    return matrix.astype(np.float32)


def pooled(array: pa.Array, matrix: np.ndarray) -> np.ndarray:
    """Feature rows of texts."""
    word, shape, rows = tokens(array)
    out = np.zeros((len(array), FEATURES), np.float32)
    if len(rows):
        firsts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        sizes = np.diff(np.concatenate([firsts, [len(rows)]]))
        at = rows[firsts]
        out[at, :DIM] = np.add.reduceat(matrix[word], firsts, axis=0) / sizes[:, None]
        out[at, DIM : 2 * DIM] = np.add.reduceat(matrix[shape], firsts, axis=0) / sizes[:, None]
        both = np.sort(rows * (2 * BUCKETS) + word)
        distinct = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        n_distinct = np.bincount(both[distinct] // (2 * BUCKETS), minlength=len(array))[at]
        out[at, 2 * DIM] = np.log1p(sizes)
        out[at, 2 * DIM + 1] = n_distinct / sizes
        out[at, 2 * DIM + 2] = np.log1p(sizes) - np.log1p(n_distinct)
        out[at, 2 * DIM + 3] = np.linalg.norm(out[at, :DIM], axis=1)
    return out


class Network:
    """Standardised input, one hidden layer of tanh units, one logit, a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        """Fitted on all rows; the temperature comes from networks that did not see the
        rows that they are judged on."""
        rng = np.random.default_rng(3)
        fold = rng.permutation(len(x)) % FOLDS
        logits = np.zeros(len(x))
        for k in range(FOLDS) if len(x) >= 10 else ():
            self._start(x[fold != k], y[fold != k], rng)
            logits[fold == k] = self.logits(x[fold == k])
        self._start(x, y, rng)
        # Smoothed targets: rows without errors are no proof of certainty.
        good, bad = (y > 0).sum(), (y <= 0).sum()
        target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
        grid = np.exp(np.linspace(-2, 4, 121))
        loss = [np.mean(np.logaddexp(0, logits / t) - target * logits / t) for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))]) if len(x) >= 10 else 1.0

    def _start(self, x: np.ndarray, y: np.ndarray, rng) -> None:
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-3
        self.p = [
            rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
            rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1),
        ]
        self._fit((x - self.mean) / self.spread, y.astype(float), rng)

    def _fit(self, x: np.ndarray, y: np.ndarray, rng) -> None:
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.p]
        step = 0
        epochs = max(EPOCHS, -(-STEPS * MINIBATCH // len(x)))
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            order = rng.permutation(len(x))
            for low in range(0, len(x), MINIBATCH):
                at = order[low : low + MINIBATCH]
                w1, b1, w2, b2 = self.p
                hidden = np.tanh(x[at] @ w1 + b1)
                error = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -30, 30))) - y[at]) / len(at)
                back = error[:, None] * w2 * (1 - hidden**2)
                grads = [x[at].T @ back + DECAY * w1, back.sum(0), hidden.T @ error + DECAY * w2, error.sum(keepdims=True)]
                step += 1
                for p, g, (m, v) in zip(self.p, grads, moments):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.p
        return np.tanh((x - self.mean) / self.spread @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(docs: DataFrame, labelled: DataFrame, matrix: np.ndarray) -> Network | None:
    """The network, from rows (doc_id, quality)."""
    known = labelled.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    shared = docs.sparkSession.sparkContext.broadcast(matrix)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 20):
            x = pooled(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality").cast(pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())], ["quality", "x"]
            )

    # At most TRAIN_ROWS ids are broadcast, and as many fixed-size vectors come back.
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")
        .mapInArrow(vectors, "quality int, x binary").limit(TRAIN_ROWS).toArrow()
    )
    if rows.num_rows == 0:
        return None
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float32).reshape(-1, FEATURES)
    y = rows.column("quality").to_numpy()
    order = np.lexsort([*x[:, :4].T, y])  # rows arrive in any order; training must not depend on it
    return Network(x[order].astype(np.float64), y[order])


def score(docs: DataFrame, labelled: DataFrame, name: str = "score") -> DataFrame:
    """``docs`` with the calibrated probability of label 1."""
    matrix = context_matrix(docs)
    network = fit(docs, labelled, matrix)
    shared = docs.sparkSession.sparkContext.broadcast((matrix, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of, net = shared.value
        for batch in pieces(batches, "text", 1 << 20):
            x = pooled(batch.column("text"), words_of).astype(np.float64)
            s = net.scores(x) if net is not None else np.ones(len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], [*batch.schema.names, name])

    base = docs.drop(name)
    return base.mapInArrow(run, StructType([*base.schema.fields, StructField(name, DoubleType())]))


def predicted(s: Column) -> Column:
    return (s >= THRESHOLD).cast("int")
