"""Benchmark decontamination: rare n-gram seeds join texts to test items, and a
Smith-Waterman alignment of words scores copied and edited passages.

An alignment of score s (matches minus edits) has at most one run of matches more than
edits, so at least s - 1 pairs of successive words of the item stand in it unchanged.
With t such pairs needed for the least score, any set that leaves out at most t - 1 of the
item's pairs holds one of them, whichever words were edited. First pass: how often does
each pair stand in the corpus? All pairs that occur but the t - 1 most frequent ones
are seeds; no text that reaches the least score is without a seed, and the counts decide
only how much is looked at. Second pass: seeds found in a text propose windows around
their diagonal, as wide as an alignment of the least score can be; overlapping windows of
an item are merged, a window with fewer than t of the item's pairs is passed over (its
score cannot reach the threshold), and the others are aligned.

Test items are taken in blocks of bounded size, each broadcast, so any number of them
works; texts are read once per pass and block and are never shuffled.

Null and empty texts and items, and items of fewer than ``SHORTEST`` words, match nothing.
Of items that repeat an id the first text in order counts; repeated documents are
reported each. Score: matches minus edits over the item's words, at most 1. A hit has
a score of ``THRESHOLD`` and ``LEAST`` words; an item of fewer words is hit by a verbatim
copy, and a long one by ``EXCERPT`` words of matches minus edits, whatever its score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ratelake.llm.common import pieces, shingles, text_bytes, words

SEED = 2  # words of a seed; the bound on unchanged seeds is for pairs
SHORTEST = 3  # words of an item that can match
THRESHOLD = 0.4  # least score, as a share of the item's words
LEAST = 6  # least score, in words, of items that have so many
EXCERPT = 50  # score, in words, that is enough whatever the item's length
BLOCK_BYTES = 8 << 20  # item text handled at a time
SPREAD = 1 << 22  # seed places looked at together
SCORE_TYPE = "double"


class Items(NamedTuple):
    ids: list
    words: list[np.ndarray]  # word hashes of each item
    grams: np.ndarray  # sorted distinct n-grams
    gram: np.ndarray  # of each n-gram position: index into grams
    item: np.ndarray  # ... its item
    place: np.ndarray  # ... its first word


def prepare(table: pa.Table) -> Items:
    array = table.column("text").combine_chunks()
    hashes, rows, _, _ = words(*text_bytes(array))
    first = np.searchsorted(rows, np.arange(table.num_rows + 1))
    of_item = [hashes[first[k] : first[k + 1]] for k in range(table.num_rows)]
    g, item, at = shingles(hashes, rows, SEED)
    whole = np.array([len(w) >= SHORTEST for w in of_item], bool)[item] if len(item) else np.zeros(0, bool)
    g, item, at = g[whole], item[whole], at[whole]
    grams, gram = np.unique(g, return_inverse=True)
    return Items(table.column("item_id").to_pylist(), of_item, grams, gram, item, at - first[item])


def _find(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``wanted`` that occur in ``sorted_values``, and where."""
    if len(sorted_values) == 0 or len(wanted) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A small table of the top bits settles most look-ups without a search.
    bits = max(1, min(22, int(np.ceil(np.log2(len(sorted_values)))) + 5))
    there = np.zeros(1 << bits, bool)
    there[(sorted_values >> np.uint64(64 - bits)).astype(np.int64)] = True
    maybe = np.flatnonzero(there[(wanted >> np.uint64(64 - bits)).astype(np.int64)])
    at = np.minimum(np.searchsorted(sorted_values, wanted[maybe]), len(sorted_values) - 1)
    hit = sorted_values[at] == wanted[maybe]
    return maybe[hit], at[hit]


def frequencies(docs: DataFrame, items: Items) -> np.ndarray:
    """Occurrences of each n-gram of the items in all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(items.grams)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = shared.value
        total = np.zeros(len(grams), np.int64)
        for batch in pieces(batches, "text"):
            hashes, rows, _, _ = words(*text_bytes(batch.column("text")))
            _, at = _find(grams, shingles(hashes, rows, SEED)[0])
            total += np.bincount(at, minlength=len(grams))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["gram", "n"])

    out = np.zeros(len(items.grams), np.int64)
    counts = docs.select("text").mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    found = counts.toArrow()  # at most one row per n-gram of this block of items
    out[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return out


def choose_seeds(items: Items, frequency: np.ndarray) -> np.ndarray:
    """Positions (into items.gram) of the seeds: of every item those that occur, without
    the most frequent ones that an alignment of the least score cannot do with alone."""
    chosen = [np.zeros(0, np.int64)]
    firsts = np.flatnonzero(np.concatenate([[True], items.item[1:] != items.item[:-1]])) if len(items.item) else []
    for low, high in zip(firsts, [*firsts[1:], len(items.item)]):
        n = frequency[items.gram[low:high]]
        there = np.flatnonzero(n)
        spare = least_seeds(len(items.words[items.item[low]])) - 1
        chosen.append(low + there[np.argsort(n[there], kind="stable")][: max(0, len(there) - spare)])
    return np.sort(np.concatenate(chosen))


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Best local score (match 1, mismatch and gap -1) and the window index it ends at."""
    n = len(window)
    ramp = np.arange(n)
    best, end = 0, -1
    above = np.zeros(n + 1, np.int64)
    for w in item:
        fresh = np.maximum(above[:-1] + np.where(window == w, 1, -1), above[1:] - 1)
        np.maximum(fresh, 0, out=fresh)
        fresh = np.maximum.accumulate(fresh + ramp) - ramp
        above[1:] = fresh
        k = int(fresh.argmax())
        if fresh[k] > best:
            best, end = int(fresh[k]), k
    return best, end


def least_score(length: int) -> float:
    return min(max(min(LEAST, length), THRESHOLD * length), EXCERPT)


def least_seeds(length: int) -> int:
    """Item n-grams that an alignment of the least score leaves unchanged, at least."""
    return max(1, math.ceil(least_score(length)) - 1)


def windows_of(
    items: Items, row: np.ndarray, item: np.ndarray, diagonal: np.ndarray, begins: np.ndarray
) -> Iterator[tuple[int, int, int, int]]:
    """Merged windows (row, item, first word, after last word) around seed diagonals."""
    if len(item) == 0:
        return
    order = np.lexsort([diagonal, item, row])
    row, item, diagonal = row[order], item[order], diagonal[order]
    length = np.array([len(w) for w in items.words])
    # An alignment of the least score has at most length - least_score words more than the item.
    pad = np.array([max(n // 2 + 2, int(n - least_score(n)) + 1) for n in length.tolist()])[item]
    low = np.maximum(begins[row], diagonal - pad)
    high = np.minimum(begins[row + 1], diagonal + length[item] + pad)
    new = np.ones(len(item), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (low[1:] > high[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(item)]]) - 1
    yield from zip(row[first].tolist(), item[first].tolist(), low[first].tolist(), high[last].tolist())


def _hits(docs: DataFrame, items: Items, seeds: np.ndarray) -> DataFrame:
    seeds = seeds[np.argsort(items.gram[seeds], kind="stable")]
    bounds = np.searchsorted(items.gram[seeds], np.arange(len(items.grams) + 1))
    shared = docs.sparkSession.sparkContext.broadcast((items, bounds, items.item[seeds], items.place[seeds]))
    names = ["doc_id", "item_id", "score", "first_word", "last_word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, bounds, seed_item, seed_place = shared.value
        cuts = np.searchsorted(items.item, np.arange(len(items.words) + 1))
        mark = np.zeros(len(items.grams), bool)
        for batch in pieces(batches, "text"):
            hashes, rows, _, _ = words(*text_bytes(batch.column("text")))
            g, row, at = shingles(hashes, rows, SEED)
            hit, which = _find(items.grams, g)
            row, at = row[hit], at[hit]
            begins = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            best: dict[tuple[int, int], tuple] = {}
            total = np.concatenate([[0], np.cumsum(bounds[which + 1] - bounds[which])])
            a = 0
            while a < len(hit):
                b = max(a + 1, int(np.searchsorted(total, total[a] + SPREAD, "right")) - 1)
                gram = which[a:b]
                width = bounds[gram + 1] - bounds[gram]
                spread = np.repeat(bounds[gram] - total[a:b], width) + np.arange(total[a], total[b])
                diagonal = np.repeat(at[a:b], width) - seed_place[spread]
                for r, k, low, high in windows_of(items, np.repeat(row[a:b], width), seed_item[spread], diagonal, begins):
                    item = items.words[k]
                    inside = which[slice(*np.searchsorted(at, [low, high - 1]))]
                    mark[inside] = True
                    unchanged = np.count_nonzero(mark[items.gram[cuts[k] : cuts[k + 1]]])
                    mark[inside] = False
                    if unchanged < least_seeds(len(item)):
                        continue
                    window = hashes[low:high]
                    score, end = align(item, window)
                    if score >= least_score(len(item)) and ((r, k) not in best or score > best[r, k][0]):
                        _, back = align(item[::-1], window[: end + 1][::-1])
                        start = low - begins[r]
                        best[r, k] = (score, start + end - back, start + end)
                a = b
            out: list[list] = [[] for _ in names]
            ids = batch.column("doc_id")
            for (r, k), (score, begin, end) in best.items():
                for column, value in zip(out, [ids[r].as_py(), items.ids[k], score / len(items.words[k]), begin, end]):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(out, kinds)], names)

    id_type = docs.schema["doc_id"].dataType
    arrow_id = pa.int32() if id_type.simpleString() == "int" else pa.string() if id_type.simpleString() == "string" else pa.int64()
    kinds = [arrow_id, pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    schema = StructType([
        StructField("doc_id", id_type), StructField("item_id", LongType()), StructField("score", DoubleType()),
        StructField("first_word", LongType()), StructField("last_word", LongType()),
    ])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of every text and item it copies."""
    items = (
        benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
        .groupBy(F.col("item_id").cast("bigint").alias("item_id")).agg(F.min("text").alias("text"))
    )
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    found: DataFrame | None = None
    for b in range(blocks):  # a stated set of queries, in blocks of bounded size
        block = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id").toArrow()
        prepared = prepare(block)
        hits = _hits(docs, prepared, choose_seeds(prepared, frequencies(docs, prepared)))
        found = hits if found is None else found.unionByName(hits)
    return found
