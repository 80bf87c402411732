"""Shared helpers: shared-folder tables, row batches, and word hashes at numpy speed.

Words are ``[^\\x20\\x09-\\x0D]+`` of a text whose A-Z are lower-cased. Both rules act
on ASCII bytes only, so they hold on UTF-8 bytes and no text is decoded for them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.session import shared_dir

WINDOW = 1 << 20  # bytes hashed at a time; bounds the memory of a worker


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a cut of lineage that
    outlives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = WINDOW) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose ``column`` holds about ``size`` bytes, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: empty) and the n+1 offsets of its rows."""
    lengths = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
    filled = pc.fill_null(array.cast(pa.large_binary()), b"")
    if isinstance(filled, pa.ChunkedArray):
        filled = filled.combine_chunks()
    if len(filled) == 0:
        return np.zeros(0, np.uint8), offsets
    raw = np.frombuffer(filled.buffers()[1], np.int64, len(filled) + 1, filled.offset * 8)
    data = filled.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[raw[0] : raw[-1]], offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def odd(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers that depend on the seed only."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_CODE = odd(256, 1)[_LOWER]
_BASE = int(odd(1, 2)[0])
_INVERSE = pow(_BASE, -1, 1 << 64)


_KEPT: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a base; as many as a window takes are kept."""
    known = _KEPT.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, WINDOW + 1024), base, np.uint64)
        known[:1] = 1
        known = np.multiply.accumulate(known)
        if len(known) <= 2 * WINDOW:
            _KEPT[base] = known
    return known[:n]


def _hash_window(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(data)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_CODE[data] * _powers(_BASE, n), dtype=np.uint64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all rows: (hash, row, first byte, byte after), in text order."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + WINDOW, "right")))
        low, high = starts[at], ends[stop - 1]
        hashes[at:stop] = _hash_window(data[low:high], starts[at:stop] - low, ends[at:stop] - low)
        at = stop
    rows = np.searchsorted(offsets, starts, "right") - 1
    return hashes, rows, starts, ends


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word n-grams: (hash, row, index of the first word). A row of fewer words gives
    its whole sequence as one."""
    count = len(hashes)
    if count == 0:
        return hashes, rows, np.zeros(0, np.int64)
    factors = odd(n, 3)
    firsts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    sizes = np.diff(np.concatenate([firsts, [count]]))
    position = np.arange(count) - np.repeat(firsts, sizes)
    size = np.repeat(sizes, sizes)
    total = np.zeros(count, np.uint64)
    for j in range(n):
        inside = position + j < size
        shifted = np.zeros(count, np.uint64)
        shifted[: max(0, count - j)] = hashes[j:]
        total += np.where(inside, shifted * factors[j], np.uint64(0))
    keep = (position + n <= size) | ((size < n) & (position == 0))
    short = np.where(size < n, size, n).astype(np.uint64)
    at = np.flatnonzero(keep)
    return mix(total[at] + short[at]), rows[at], at


def crc_mod(ids: list, n: int) -> np.ndarray:
    """The Python twin of ``remainder`` (null id: -1)."""
    return np.array([-1 if i is None else zlib.crc32(str(i).encode()) % n for i in ids])
