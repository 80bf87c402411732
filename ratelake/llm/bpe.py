"""Byte-level BPE encoding and decoding through a sentencepiece model made from the ranks.

Every byte is one character of a block of 256, so a vocabulary entry of bytes is a
piece of such characters. The model file is serialised straight from the vocabulary:
piece i is the entry of rank i with score -i, so the merge of the best score is the
merge of the lowest rank; the normaliser is the identity. Texts are split into
pre-tokens first, each pre-token is encoded by itself, and a pre-token that is an
entry is that entry. Decoding maps pieces back to their bytes.

Null text counts as empty; an empty text has no ids. Rows are independent: repeated
rows give repeated results, extra columns are carried along untouched.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ratelake.llm.common import pieces

BLOCK = 0x4E00  # first of the 256 characters that stand for bytes
CACHED = 600_000  # units remembered per task


def byte_characters(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_TO_BLOCK)


def character_bytes(text: str) -> bytes:
    return text.translate(_FROM_BLOCK).encode("latin-1")


_TO_BLOCK = {b: BLOCK + b for b in range(256)}
_FROM_BLOCK = {BLOCK + b: b for b in range(256)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n & (1 << 64) - 1)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def read_ranks(path: str) -> list[bytes]:
    """The entries by rank of a file of base64 entries and ranks."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    entries = [b""] * len(pairs)
    for entry, rank in pairs:
        entries[int(rank)] = base64.b64decode(entry)
    return entries


def serialise(entries: list[bytes]) -> bytes:
    """The model file: pieces (text 1, score 2, kind 3), trainer 2, normaliser 3."""
    body = [
        _block(1, _block(1, byte_characters(e).encode()) + b"\x15" + struct.pack("<f", -float(i)) + _number(3, 1))
        for i, e in enumerate(entries)
    ]
    unknown = len(entries)
    body.append(_block(1, _block(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, 2)))
    trainer = _number(3, 2) + _number(4, unknown + 1) + _number(40, unknown)
    trainer += b"".join(_number(field, -1) for field in (41, 42, 43))
    normaliser = _block(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(body) + _block(2, trainer) + _block(3, normaliser)


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import sentencepiece

        entries = read_ranks(ranks_path)
        self.whole = {e: i for i, e in enumerate(entries)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(entries))
        self.table = [character_bytes(self.model.id_to_piece(i)) for i in range(len(entries))]
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def _learn(self, units: set[str]) -> None:
        """Ids of units, as little-endian 32-bit numbers."""
        split = {u: [t.encode() for t in self.find(u)] for u in units}
        open_tokens = list({t for tokens in split.values() for t in tokens if t not in self.whole})
        coded = dict(zip(open_tokens, self.model.encode([byte_characters(t) for t in open_tokens], num_threads=1)))
        for unit, tokens in split.items():
            ids = [i for t in tokens for i in ((self.whole[t],) if t in self.whole else coded[t])]
            self.known[unit] = struct.pack(f"<{len(ids)}I", *ids)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        cut = [_units(t) for t in texts]
        if len(self.known) > CACHED:
            self.known = {}
        known = self.known
        new = {u for units in cut for u in units if u not in known}
        if new:
            self._learn(new)
        return [b"".join([known[u] for u in units]) for units in cut]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        table = self.table
        return b"".join([table[i] for i in memoryview(ids).cast("I")])


_RUN = re.compile(r" [\s\x1c-\x1f\x85]|[\s\x1c-\x1f\x85] ")


def _units(text: str) -> list[str]:
    """The text cut before spaces that stand alone, where no pre-token goes on: a
    pattern whose matches hold a space only at their start or among white space
    splits the parts as it splits the whole. A text with other runs stays whole."""
    if _RUN.search(text):
        return [text]
    first, *rest = text.split(" ")
    units = [first] if first else []
    units += [" " + w for w in rest]
    return units


@lru_cache(maxsize=2)
def coder(ranks_path: str, pattern: str) -> ByteBpe:
    return ByteBpe(ranks_path, pattern)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (binary: little-endian 32-bit ids) and ``n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks_path, pattern)
        for batch in pieces(batches, text):
            ids = bpe.encode_all([t or "" for t in batch.column(text).to_pylist()])
            new = [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "ids", "n_tokens"])

    base = df.drop("ids", "n_tokens")
    out = StructType([*base.schema.fields, StructField("ids", BinaryType()), StructField("n_tokens", LongType())])
    return base.mapInArrow(run, out)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the bytes that the ids stand for (null ids: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks_path, pattern)
        for batch in pieces(batches, ids):
            new = pa.array([bpe.decode(x or b"") for x in batch.column(ids).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, new], [*batch.schema.names, "decoded"])

    base = df.drop("decoded")
    return base.mapInArrow(run, StructType([*base.schema.fields, StructField("decoded", BinaryType())]))


def round_trip_digest(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and of decoded bytes, one pass per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks_path, pattern)
        for batch in pieces(batches, "text"):
            ids = bpe.encode_all([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    out = StructType([
        StructField("doc_id", df.schema["doc_id"].dataType), StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()),
    ])
    return df.select("doc_id", "text").mapInArrow(run, out)
