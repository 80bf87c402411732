"""Hashed maximum-entropy language model with a class-factored softmax.

A word's probability is that of its class given the words before, times that of the
word in its class. The ``TOP`` most frequent words and the end have a class each; the
other words share ``SUFFIXES`` classes by their last bytes, with counts of the training
texts, and each of these classes keeps a share for words never seen. The class
distribution is a softmax over hashed features: the classes of the word before, of the
two before together, of the second and of the third before alone (skips), and the hash
of the word before. Its weights start from the features' class counts and are moved by
``ROUNDS`` distributed gradient updates that between them read every training text
once; gradients are summed per task, then over tasks, in blocks of fixed size.

Texts are packed into chunks of token numbers. Each chunk asks for the counts of its
distinct words, by part of the key space, and gets them back: one entry per chunk and
word however often it stands there.

Null and empty texts consist of the end alone. Rows that repeat an id count each; rows
without id are learned from. Without training text the model is uniform.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import crc_mod, mix, pieces, stored, text_bytes, words

FOLDS, HELD_OUT = 5, 1  # crc32(doc_id as text) mod FOLDS == HELD_OUT is not learned from
SUFFIXES = 24
TOP = 39
CLASSES = SUFFIXES + TOP + 1
END_CLASS = CLASSES - 1
START = CLASSES  # class of the places before a text
BITS = 31  # low bits of a key that hold its suffix class
END = np.uint64(0xE4D0E4D0E4D0E400 | SUFFIXES)
HASHED = 4096  # rows of the feature of the word before
TOKENS = 1 << 20  # tokens of a chunk, about
STEP = 1 << 15  # tokens whose class distributions are held at a time
ROUNDS = 2
BLOCKS = 32
SMOOTH, SHARE, RATE, LIMIT, FLOOR = 20.0, 0.45, 0.5, 1.0, 5.0

_SPAN = CLASSES + 1
_OFFSETS = np.cumsum([0, _SPAN, _SPAN * _SPAN, _SPAN, _SPAN, HASHED])
ROWS = int(_OFFSETS[-1])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _keys(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all words, and the number of words of each row."""
    data, offsets = text_bytes(array)
    hashes, rows, starts, ends = words(data, offsets)
    last = _LOWER[data[ends - 1]].astype(np.uint64)
    before = np.where(ends - starts > 1, _LOWER[data[np.maximum(ends - 2, 0)]], 0).astype(np.uint64)
    suffix = mix(last * np.uint64(256) + before) % np.uint64(SUFFIXES)
    return (hashes & ~np.uint64(BITS)) | suffix, np.bincount(rows, minlength=len(array))


def pack(docs: DataFrame) -> DataFrame:
    """(chunk, ids, offsets, keys, tokens, train): texts as numbers of their chunk's keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        keys: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            n = np.concatenate(sizes) + 1
            offsets = np.concatenate([[0], np.cumsum(n)])
            every = np.full(offsets[-1], END)
            inner = np.ones(offsets[-1], bool)
            inner[offsets[1:] - 1] = False
            every[inner] = np.concatenate(keys)
            distinct, token = np.unique(every, return_inverse=True)
            train = crc_mod(ids, FOLDS) != HELD_OUT
            number = np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64)
            # Bytes of one weight side by side: the high ones are mostly zero.
            planes = np.ascontiguousarray(token.astype("<u4").view(np.uint8).reshape(-1, 4).T)
            blobs = [b.tobytes() for b in (number, offsets.astype(np.int64), distinct)]
            blobs += [zstandard.compress(planes.tobytes(), 1), train.astype(np.uint8).tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().int >> 65]), *[pa.array([b], pa.binary()) for b in blobs]], names
            )

        count = 0
        for batch in pieces(batches, "text"):
            k, n = _keys(batch.column("text"))
            ids += batch.column("doc_id").to_pylist()
            keys.append(k)
            sizes.append(n)
            count += len(k) + len(n)
            if count >= TOKENS:
                yield packed()
                ids, keys, sizes, count = [], [], [], 0
        if ids:
            yield packed()

    names = ["chunk", "ids", "offsets", "keys", "tokens", "train"]
    return docs.select("doc_id", "text").mapInArrow(
        run, "chunk bigint, ids binary, offsets binary, keys binary, tokens binary, train binary"
    )


class Chunk:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        self.keys = np.frombuffer(row["keys"], np.uint64)
        planes = np.frombuffer(zstandard.decompress(row["tokens"]), np.uint8).reshape(4, -1)
        self.tokens = np.ascontiguousarray(planes.T).view("<u4").ravel()
        self.train = np.frombuffer(row["train"], np.uint8).astype(bool)

    def train_tokens(self) -> np.ndarray:
        return np.repeat(self.train, np.diff(self.offsets))

    def by_part(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Key numbers ordered by part, and where each part begins."""
        part = ((self.keys >> np.uint64(5)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        return order, np.searchsorted(part[order], np.arange(parts + 1))


def _ask(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "tokens", 1):
            row = batch.to_pylist()[0]
            chunk = Chunk(row)
            counts = np.bincount(chunk.tokens[chunk.train_tokens()], minlength=len(chunk.keys)).astype(np.uint32)
            order, cuts = chunk.by_part(parts)
            rows = [(p, order[cuts[p] : cuts[p + 1]]) for p in range(parts) if cuts[p] < cuts[p + 1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _ in rows], pa.int32()), pa.array([row["chunk"]] * len(rows), pa.int64()),
                    *[pa.array([c[i].tobytes() for _, i in rows], pa.binary()) for c in (chunk.keys, counts)],
                ],
                ["part", "chunk", "keys", "counts"],
            )

    return run


def _count(table: pa.Table) -> pa.Table:
    """Corpus counts of one part: a row per chunk that asked, and a row (no chunk) with
    the part's sums per suffix class and its most frequent words."""
    keys = [np.frombuffer(b, np.uint64) for b in table.column("keys").to_pylist()]
    counts = np.concatenate([np.frombuffer(b, np.uint32) for b in table.column("counts").to_pylist()])
    cuts = np.cumsum([0, *[len(k) for k in keys]])
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, counts, len(distinct)).astype(np.int64)
    suffix = (distinct & np.uint64(BITS)).astype(np.int64)
    sums = np.bincount(suffix, total, BITS + 1).astype(np.int64)
    kinds = np.bincount(suffix[total > 0], minlength=BITS + 1)
    best = np.lexsort([distinct, -total])[: TOP + 1]
    answer = total[at].astype(np.int64)
    n = table.num_rows
    own = [answer[cuts[k] : cuts[k + 1]].tobytes() for k in range(n)]
    return pa.table({
        "chunk": pa.array([*table.column("chunk").to_pylist(), None], pa.int64()),
        "part": pa.array(table.column("part").to_pylist()[:1] * (n + 1), pa.int32()),
        "counts": pa.array([*own, np.concatenate([sums, kinds]).tobytes()], pa.binary()),
        "top": pa.array([*[None] * n, np.stack([distinct[best].view(np.int64), total[best]]).tobytes()], pa.binary()),
    })


class Words:
    """What the counts say: total and distinct tokens, the frequent words, the classes."""

    def __init__(self, stats: list):
        sums = np.zeros((2, BITS + 1), np.int64)
        top: list[tuple[int, int]] = []
        for row in stats:
            sums += np.frombuffer(row["counts"], np.int64).reshape(2, -1)
            keys, counts = np.frombuffer(row["top"], np.int64).reshape(2, -1)
            top += [(-c, k) for k, c in zip(keys.tolist(), counts.tolist()) if c > 0 and k != int(END.view(np.int64))]
        self.tokens, self.distinct = int(sums[0].sum()), int(sums[1].sum())
        top = sorted(top)[:TOP]
        self.top = np.sort(np.array([k for _, k in top], np.int64).view(np.uint64))
        self.class_tokens, self.class_words = sums[0, :SUFFIXES].copy(), sums[1, :SUFFIXES].copy()
        for c, k in top:
            suffix = int(np.int64(k).view(np.uint64) & np.uint64(BITS))
            self.class_tokens[suffix] += c  # c is negative
            self.class_words[suffix] -= 1

    def classes(self, keys: np.ndarray) -> np.ndarray:
        out = (keys & np.uint64(BITS)).astype(np.int64)
        out[keys == END] = END_CLASS
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, keys), len(self.top) - 1)
            out = np.where(self.top[at] == keys, SUFFIXES + at, out)
        return out

    def log_in_class(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of a word's probability in its class."""
        shared = np.minimum(classes, SUFFIXES - 1)
        p = (counts + 0.5) / (self.class_tokens[shared] + 0.5 * (self.class_words[shared] + 1))
        return np.where(classes < SUFFIXES, np.log10(p), 0.0)


def features(chunk: Chunk, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of every token, and its feature rows (n x 5)."""
    own = classes[chunk.tokens]
    n = len(own)
    place = np.arange(n) - np.repeat(chunk.offsets[:-1], np.diff(chunk.offsets))
    back = np.full((3, n), START)
    for d in range(3):
        back[d, d + 1 :] = own[: max(0, n - d - 1)]
        back[d][place < d + 1] = START
    word = np.zeros(n, np.int64)
    hashed = ((chunk.keys >> np.uint64(40)) % np.uint64(HASHED - 1)).astype(np.int64) + 1
    word[1:] = hashed[chunk.tokens[:-1]]
    word[place == 0] = 0
    rows = np.stack([back[0], back[0] * _SPAN + back[1], back[1], back[2], word], 1) + _OFFSETS[:5]
    return own, rows.astype(np.int32)


def _log_classes(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    logits = weights[rows[:, 0]]
    for j in range(1, rows.shape[1]):
        logits += weights[rows[:, j]]
    logits += bias
    logits -= logits.max(axis=1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return logits


def _totals(packed: DataFrame, add) -> np.ndarray:
    """Sum over chunks of the arrays (ROWS x CLASSES) that ``add`` adds to, in blocks."""
    size = -(-ROWS * CLASSES // BLOCKS)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ROWS, CLASSES))
        for batch in pieces(batches, "tokens", 1):
            add(total, Chunk(batch.to_pylist()[0]))
        flat = np.zeros(size * BLOCKS, np.float32)
        flat[: ROWS * CLASSES] = total.ravel()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(BLOCKS), pa.int32()),
                pa.array([flat[k * size : (k + 1) * size].tobytes() for k in range(BLOCKS)], pa.binary()),
            ],
            ["block", "sums"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("sums")):
                sums[block] = sums.get(block, 0) + np.frombuffer(blob.as_buffer(), np.float32).astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums, pa.int32()), pa.array([s.astype(np.float32).tobytes() for s in sums.values()], pa.binary())],
                ["block", "sums"],
            )

    kind = "block int, sums binary"
    rows = packed.mapInArrow(gather, kind).repartition(BLOCKS, "block").mapInArrow(merge, kind).collect()
    out = np.zeros((BLOCKS, size))
    for row in rows:  # BLOCKS rows of fixed size
        out[row["block"]] = np.frombuffer(row["sums"], np.float32)
    return out.ravel()[: ROWS * CLASSES].reshape(ROWS, CLASSES)


def train(packed: DataFrame, known: Words) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of the class distribution."""
    spark = packed.sparkSession

    def counts(total: np.ndarray, chunk: Chunk) -> None:
        own, rows = features(chunk, known.classes(chunk.keys))
        use = chunk.train_tokens()
        own, rows = own[use], rows[use]
        for j in range(rows.shape[1]):
            at = rows[:, j].astype(np.int64) * CLASSES + own
            total += np.bincount(at, minlength=ROWS * CLASSES).reshape(ROWS, CLASSES)

    observed = _totals(packed, counts)
    prior = observed[: _OFFSETS[1]].sum(axis=0) + 1.0
    prior /= prior.sum()
    bias = np.log(prior)
    seen = observed.sum(axis=1, keepdims=True)
    weights = SHARE * (np.log((observed + SMOOTH * prior) / (seen + SMOOTH)) - bias)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((weights.astype(np.float32), bias.astype(np.float32)))

        def gradient(total: np.ndarray, chunk: Chunk, shared=shared) -> None:
            w, b = shared.value
            own, rows = features(chunk, known.classes(chunk.keys))
            use = chunk.train_tokens()
            own, rows = own[use], rows[use]
            for low in range(0, len(own), STEP):
                r, c = rows[low : low + STEP], own[low : low + STEP]
                error = -np.exp(_log_classes(w, b, r))
                error[np.arange(len(c)), c] += 1
                for j in range(r.shape[1]):
                    at = (r[:, j] - _OFFSETS[j]).astype(np.uint16)
                    order = np.argsort(at, kind="stable")
                    at = at[order]
                    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                    total[at[first].astype(np.int64) + _OFFSETS[j]] += np.add.reduceat(error[order], first, axis=0)

        share = packed.filter(F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == turn)
        slope = ROUNDS * _totals(share, gradient)  # as if over all texts
        expected = np.maximum(observed - slope, 0)
        weights = weights + RATE * np.clip(slope / (expected + FLOOR), -LIMIT, LIMIT)
    return weights.astype(np.float32), bias.astype(np.float32)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per document."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = stored(pack(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")), "lm-chunks")
    counted = stored(
        packed.mapInArrow(_ask(parts), "part int, chunk bigint, keys binary, counts binary")
        .groupBy("part").applyInArrow(_count, "chunk bigint, part int, counts binary, top binary"),
        "lm-counts",
    )
    known = Words(counted.filter("chunk IS NULL").select("counts", "top").collect())  # a row of fixed size per part
    model = train(packed, known)
    shared = spark.sparkContext.broadcast((known, model))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known, (weights, bias) = shared.value
        out: dict[str, list] = {n: [] for n in SCORED.names}
        for row in left.to_pylist():
            chunk = Chunk(row)
            order, cuts = chunk.by_part(parts)
            counts = np.zeros(len(chunk.keys), np.int64)
            for part, blob in zip(right.column("part").to_pylist(), right.column("counts").to_pylist()):
                counts[order[cuts[part] : cuts[part + 1]]] = np.frombuffer(blob, np.int64)
            classes = known.classes(chunk.keys)
            base = np.log10((counts + 0.5) / (known.tokens + 0.5 * (known.distinct + 1)))
            inside = known.log_in_class(classes, counts)
            own, rows = features(chunk, classes)
            value = inside[chunk.tokens]
            for low in range(0, len(own), STEP):
                logs = _log_classes(weights, bias, rows[low : low + STEP])
                value[low : low + STEP] += logs[np.arange(len(logs)), own[low : low + STEP]] / np.log(10)
            first = chunk.offsets[:-1]
            out["doc_id"] += [None if i == np.iinfo(np.int64).max else i for i in chunk.ids.tolist()]
            out["held_out"] += (~chunk.train).tolist()
            out["n_tokens"] += np.diff(chunk.offsets).tolist()
            out["n_known"] += np.add.reduceat((counts > 0).astype(np.int64)[chunk.tokens], first).tolist()
            out["train_tokens"] += [known.tokens] * len(first)
            out["base_score"] += np.add.reduceat(base[chunk.tokens], first).tolist()
            out["score"] += np.add.reduceat(value, first).tolist()
        return pa.table(out, SCORED)

    return packed.groupBy("chunk").cogroup(counted.filter("chunk IS NOT NULL").drop("top").groupBy("chunk")).applyInArrow(
        run,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )


SCORED = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
])
