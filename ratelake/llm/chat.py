"""Chat formatting with typed content parts.

A conversation is a list of turns, a turn a role and a list of typed parts: text,
image, audio or document. A visitor walks the parts in order: text is escaped and
kept, any other part becomes an ordered placeholder, its reference is recorded as an
attachment, and the tokens that the placeholder stands for are counted by its kind.

Template: ``### role:`` newline, content, ``</turn>`` newline. In roles and texts the
characters backslash, ``<``, ``#`` and (in roles) ``:`` get a backslash in front, so a
bare ``#`` or ``<`` is always the template's and reading back restores every text.
The loss mask is a list of spans of code points of the output: the content of each
assistant turn.

Null roles, texts and parts count as empty; an empty conversation list gives no rows;
rows of one turn number keep the order (turn, role, parts), nulls first; rows without
conversation id form one conversation with a null id. One conversation is one output
row and so is formatted in one task; a large one is spread over no more than its own
text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, _parse_datatype_string

PART = "struct<kind:string,text:string,ref:string,size:double>"
FORMATTED = (
    "formatted string, loss array<struct<start:bigint,end:bigint>>, "
    "attachments array<struct<turn:int,part:int,kind:string,ref:string,n_tokens:bigint>>, n_placeholder_tokens bigint"
)
TURN_ROWS = 256  # conversations handled at a time

# Tokens that a placeholder of each kind expands to, per unit of its size: images are
# sized in pixels (one token a patch), audio in seconds, documents in pages.
PATCH_PIXELS, AUDIO_PER_SECOND, PER_PAGE = 14 * 14, 25, 512


def text_part(text: Column) -> Column:
    """A list of one text part."""
    none = F.lit(None).cast("string")
    return F.array(
        F.struct(
            F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), none.alias("ref"),
            F.lit(None).cast("double").alias("size"),
        )
    )


class Visitor:
    """One walk over the parts of a conversation."""

    def __init__(self):
        self.out: list[str] = []
        self.attachments: list[dict] = []
        self.turn = self.part = 0

    def visit(self, part: dict | None) -> None:
        part = part or {}
        kind = part.get("kind") or "text"
        handlers = {
            "text": self.visit_text, "image": self.visit_image, "audio": self.visit_audio, "document": self.visit_document,
        }
        handlers.get(kind, self.visit_other)(part)
        self.part += 1

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, math.ceil((part.get("size") or 0) / PATCH_PIXELS))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part.get("size") or 0) * AUDIO_PER_SECOND))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, math.ceil((part.get("size") or 0) * PER_PAGE))

    def visit_other(self, part: dict) -> None:
        """A kind without a rule is an attachment of no tokens, under its own name if that
        can stand in a placeholder."""
        kind = part["kind"]
        self._attach(kind if re.fullmatch(r"\w+", kind) else "unknown", part, 0)

    def _attach(self, kind: str, part: dict, n_tokens: int) -> None:
        self.out.append(f"<|{kind}|>")
        self.attachments.append(
            {"turn": self.turn, "part": self.part, "kind": kind, "ref": part.get("ref"), "n_tokens": n_tokens}
        )


def escape(text: str, extra: str = "") -> str:
    return re.sub(f"[\\\\<#{extra}]", lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turns(turns: list[dict]) -> dict:
    """Output text, loss spans and attachments of one conversation."""
    visitor, out, loss, length = Visitor(), [], [], 0
    for k, turn in enumerate(turns):
        visitor.turn, visitor.part, visitor.out = k, 0, []
        for part in turn["parts"] or []:
            visitor.visit(part)
        content, role = "".join(visitor.out), turn["role"] or ""
        head = f"### {escape(role, ':')}:\n"
        if role == "assistant":
            loss.append({"start": length + len(head), "end": length + len(head) + len(content)})
        out += [head, content, "</turn>\n"]
        length += len(head) + len(content) + len("</turn>\n")
    return {
        "formatted": "".join(out), "loss": loss, "attachments": visitor.attachments,
        "n_placeholder_tokens": sum(a["n_tokens"] for a in visitor.attachments),
    }


_TURN = re.compile(r"### ((?:[^\\:#<]|\\.)*):\n((?:[^\\<]|\\.|<\|\w+\|>)*)</turn>\n", re.S)
_PIECE = re.compile(r"<\|(\w+)\|>|((?:[^\\<]|\\.)+)", re.S)


def read_back(formatted: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """Turns of an output text: role and parts (kind, text); raises if it is malformed."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        parts = [(p[1], "") if p[1] else ("text", unescape(p[2])) for p in _PIECE.finditer(m[2])]
        turns.append((unescape(m[1]), parts))
        at = m.end()
    return turns


def format_chat(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, FORMATTED) of rows (conv, turn, role, parts array<PART>); others are dropped."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), F.col("role"), F.col("parts"))))
    turns = rows.groupBy(conv).agg(ordered.alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, TURN_ROWS):
                batch = whole.slice(start, TURN_ROWS)
                out = [format_turns(t) for t in batch.column("turns").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(conv), *[pa.array([o[f.name] for o in out], f.type) for f in _ARROW]],
                    [conv, *[f.name for f in _ARROW]],
                )

    schema = StructType([turns.schema[conv], *_parse_datatype_string(FORMATTED).fields])
    return turns.mapInArrow(run, schema)


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_ATTACHMENT = pa.struct(
    [("turn", pa.int32()), ("part", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("n_tokens", pa.int64())]
)
_ARROW = pa.schema([
    ("formatted", pa.string()), ("loss", pa.list_(_SPAN)), ("attachments", pa.list_(_ATTACHMENT)),
    ("n_placeholder_tokens", pa.int64()),
])


def digest(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digests of formatted conversations, all read back from the output text and mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts, losses = batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()
            for text, loss in zip(texts, losses):
                turns = read_back(text)
                whole = "".join(f"{role}\n{''.join(t for _, t in parts)}\n" for role, parts in turns)
                masked = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
                rows.append((len(turns), _sha(whole), len(masked), _sha(masked), len(text)))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(conv), *[pa.array(c, t) for c, t in zip(columns, _DIGEST_TYPES)]],
                [conv, *_DIGEST],
            )

    kinds = [LongType(), StringType(), LongType(), StringType(), LongType()]
    schema = StructType([formatted.schema[conv], *[StructField(n, k) for n, k in zip(_DIGEST, kinds)]])
    return formatted.select(conv, "formatted", "loss").mapInArrow(run, schema)


_DIGEST = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
_DIGEST_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
