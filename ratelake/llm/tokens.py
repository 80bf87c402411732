"""Token counts with overlap resynchronisation for huge documents.

A text of ordinary length is encoded by the library. A huge one is cut into chunks
that overlap; each is encoded with offsets. Two neighbours are spliced at a common
boundary inside their overlap: the start of a token that both encodings have at the
same place of the text, directly after white space, with equal tokens from there to
the end of the overlap's agreement run. The tokenizer drops white space and never
matches across it, so the tokens after such a boundary do not depend on what stands
before it, and those before not on what follows: the count of the splice is the count
of the whole. If an overlap holds no such boundary, it is widened (doubled) and tried
again; a text without one is encoded whole.

Null text counts as empty (0 bytes, 0 tokens). Repeated rows give repeated results.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ratelake.llm.common import pieces

CHUNK = 1 << 15  # characters encoded at a time
OVERLAP = 256  # characters shared by neighbours at first
RUN = 3  # tokens that both must agree on after a boundary
CACHED = 600_000

# White space of both the tokenizer's pattern and its normaliser.
GAP = " \t\n\r"
_GAPS = re.compile(f"[{GAP}]+")


class Counter:
    """Counts of one tokenizer."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk, overlap
        self.known: dict[str, int] = {}
        self.widened = 0

    def counts(self, texts: list[str]) -> list[int]:
        """White space is a stable boundary everywhere, so the words of ordinary texts
        are counted once each; huge texts are spliced."""
        huge = {k for k, t in enumerate(texts) if len(t) > self.chunk}
        cut = [[] if k in huge else _GAPS.split(t) for k, t in enumerate(texts)]
        if len(self.known) > CACHED:
            self.known = {}
        known = self.known
        new = list({u for units in cut for u in units if u not in known})
        for unit, encoded in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            known[unit] = len(encoded)
        return [self._spliced(t) if k in huge else sum([known[u] for u in cut[k]]) for k, t in enumerate(texts)]

    def count(self, text: str) -> int:
        return self.counts([text])[0]

    def _encode(self, text: str, start: int, stop: int) -> tuple[list[int], list[int]]:
        encoded = self.tokenizer.encode(text[start:stop], add_special_tokens=False)
        return encoded.ids, [start + a for a, _ in encoded.offsets]

    def _spliced(self, text: str) -> int:
        total, start, stop = 0, 0, self.chunk
        ids, at = self._encode(text, start, stop)
        while stop < len(text):
            overlap = self.overlap
            while True:
                begin = max(start, stop - overlap)
                after = min(len(text), begin + self.chunk + overlap)
                next_ids, next_at = self._encode(text, begin, after)
                found = _common_boundary(text, ids, at, next_ids, next_at, begin, stop)
                if found is not None:
                    left, right = found
                    total += left
                    ids, at, start, stop = next_ids[right:], next_at[right:], begin, after
                    break
                self.widened += 1
                if begin == start:  # nothing left to widen: the two chunks become one
                    ids, at = self._encode(text, start, after)
                    if at and total:
                        ids, at = _from(ids, at, self._spliced_at)
                    stop = after
                    break
                overlap *= 2
            if found is not None and at:
                self._spliced_at = at[0]
        return total + len(ids)


def _from(ids: list[int], at: list[int], place: int) -> tuple[list[int], list[int]]:
    kept = [k for k, a in enumerate(at) if a >= place]
    return [ids[k] for k in kept], [at[k] for k in kept]


def _common_boundary(text, ids, at, next_ids, next_at, begin, stop):
    """Indices (left, right) of the token where the encodings are spliced, or None."""
    place = {a: k for k, a in enumerate(next_at)}
    for left in range(len(at) - RUN - 1, -1, -1):
        a = at[left]
        if a <= begin:
            return None
        right = place.get(a)
        if right is None or text[a - 1] not in GAP:
            continue
        if ids[left : left + RUN] == next_ids[right : right + RUN] and at[left : left + RUN] == next_at[right : right + RUN]:
            return left, right
    return None


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(df: DataFrame, path: str, limit: int) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path).counts
        for batch in pieces(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = counts(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(n, pa.int64()), pa.array([x > limit for x in n]),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    out = StructType([
        StructField("doc_id", df.schema["doc_id"].dataType), StructField("n_bytes", LongType()),
        StructField("n_tokens", LongType()), StructField("over_limit", BooleanType()),
    ])
    return df.select("doc_id", "text").mapInArrow(run, out)
