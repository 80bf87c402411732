"""Information-theoretic sanitisation of personal data.

Four kinds of personal data are found by pattern and become protected entities: e-mail
addresses (lower-cased), IP addresses, payment cards and phone numbers (their digits).
Blotting these out is not enough where the words around them give them away. So a term t
in the context of an entity c is weighed by what it tells of c over all documents:

    PMI(c; t) = log2( n(c, t) * n / (n(c) * n(t)) )      n(...): documents
    IC(c)     = log2( n / n(c) )

and t discloses c where PMI(c; t) >= DISCLOSURE * IC(c): knowing t then yields that share
of the information that c holds. n(c, t) counts documents with t in the context of c, and
at least SUPPORT of them must agree; one sight alone is no evidence. A disclosing term is
generalised to its class (its first CLASS letters and ``*``) if the class, by the same
measure, does not disclose c, and removed otherwise. Only terms in the context of the
entity they disclose are touched: a document without entities has nothing to protect.

The context are the CONTEXT words before and after an entity that lie within REACH
characters of it. Words are ``[^\\x20\\x09-\\x0D]+`` without punctuation at their ends, in
lower case; a word that touches found data is no term.

Null and empty texts have no findings. Rows that repeat an id, or have none, are documents
of their own. Ties cannot arise: terms are judged one by one. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratelake.llm.common import pieces, stored

DISCLOSURE = 0.8  # share of an entity's information that no single term may give
SUPPORT = 2  # documents that must show a term with an entity
CONTEXT = 5  # words on either side
REACH = 256  # characters on either side
CLASS = 4  # letters of a term that its general form keeps
PIECE = 8 << 20  # bytes of text whose words are counted together

KINDS = ("email", "ip", "card", "phone")
_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^ \t-\r]+")
_SPACE = " \t\n\x0b\x0c\r"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every ``@`` with a local part before it and a domain after it, from the left."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Numbers joined by dots, four at a time from the left."""
    for chain in _DOTTED.finditer(text):
        parts = chain.group().split(".")
        start = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def _luhn(digits: str) -> bool:
    own = [int(d) for d in digits[::-1]]
    return sum(own[::2] + [2 * d - 9 * (d > 4) for d in own[1::2]]) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def entities(text: str) -> list[tuple[int, int, int, str]]:
    """(kind number, start, end, entity) of all found data, by kind, then start."""
    found = [(0, a, b, text[a:b].lower()) for a, b in _emails(text)]
    found += [(1, a, b, text[a:b]) for a, b in _ips(text)]
    for kind, pattern, least, most in ((2, _CARD, 16, 19), (3, _PHONE, 8, 15)):
        for m in pattern.finditer(text):
            digits = _digits(m.group())
            if least <= len(digits) <= most and (kind == 3 or _luhn(digits)):
                found.append((kind, m.start(), m.end(), digits))
    return [(kind, a, b, f"{KINDS[kind]}:{entity}") for kind, a, b, entity in found]


def context(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Words of the context of text[start:end]; those cut off or touching it are left out."""
    low, high = max(0, start - REACH), min(len(text), end + REACH)
    before = [(low + m.start(), low + m.end()) for m in _WORD.finditer(text[low:start])]
    after = [(end + m.start(), end + m.end()) for m in _WORD.finditer(text[end:high])]
    if before and before[-1][1] == start:
        before.pop()
    if before and before[0][0] == low and low and text[low - 1] not in _SPACE:
        before.pop(0)
    if after and after[0][0] == end:
        after.pop(0)
    if after and after[-1][1] == high and high < len(text) and text[high] not in _SPACE:
        after.pop()
    return before[-CONTEXT:] + after[:CONTEXT]


def _near(text: str, found: list) -> list[tuple[str, str, int, int]]:
    """(entity, term as written, start, end) of the terms in the contexts."""
    taken: list[list[int]] = []
    for start, end in sorted((a, b) for _, a, b, _ in found):
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(end, taken[-1][1])
        else:
            taken.append([start, end])
    starts = [a for a, _ in taken]
    out = []
    for _, start, end, entity in found:
        for a, b in context(text, start, end):
            i = bisect_right(starts, b) - 1
            word = text[a:b]
            term = word.strip(string.punctuation)
            if term and (i < 0 or taken[i][1] < a):
                a += len(word) - len(word.lstrip(string.punctuation))
                out.append((entity, term, a, a + len(term)))
    return out


def _class_of(terms: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(pc.utf8_slice_codeunits(terms, 0, CLASS), pa.scalar("*"), "")


_FOUND = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_TERM = pa.struct([
    ("entity", pa.string()), ("term", pa.string()), ("class", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
    ("new_term", pa.int32()), ("new_class", pa.int32()),
])
_FINDINGS = (
    "_found array<struct<kind:int,start:int,end:int>>, _entities array<string>, _near array<struct<"
    "entity:string,term:string,class:string,start:int,end:int,new_term:int,new_class:int>>"
)
_NAMES = [_TERM.field(i).name for i in range(_TERM.num_fields)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row its found data, its entities, and the terms around them; new_term
    and new_class are 1 at the first place of a (entity, term or class) in the row."""
    for batch in batches:
        for part in pieces([batch], "_text"):
            may = pc.fill_null(pc.match_substring_regex(part.column("_text"), "[@+]|[0-9]"), False)
            rows = []
            for text in pc.if_else(may, part.column("_text"), "").to_pylist():
                found = entities(text)
                rows.append((found, _near(text, found) if found else []))
            terms = pc.utf8_lower(pa.array([n[1] for _, near in rows for n in near], pa.string()))
            classes = iter(_class_of(terms).to_pylist())
            terms = iter(terms.to_pylist())
            out_found, out_entities, out_near = [], [], []
            for found, near in rows:
                seen: set = set()
                own = []
                for entity, _, start, end in near:
                    term, general = next(terms), next(classes)
                    own.append((entity, term, general, start, end,
                                int((entity, term) not in seen), int((entity, general) not in seen)))
                    seen |= {(entity, term), (entity, general)}
                out_near.append([dict(zip(_NAMES, n)) for n in own])
                out_found.append([{"kind": k, "start": a, "end": b} for k, a, b, _ in found])
                out_entities.append(sorted({e for *_, e in found}))
            arrays = {name: part.column(name) for name in part.schema.names if name not in ("_text",)}
            arrays["_found"] = pa.array(out_found, pa.list_(_FOUND))
            arrays["_entities"] = pa.array(out_entities, pa.list_(pa.string()))
            arrays["_near"] = pa.array(out_near, pa.list_(_TERM))
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term or class, rows of the piece that hold it)."""
    for part in pieces(batches, "_text", PIECE):
        words = pc.ascii_split_whitespace(pc.fill_null(part.column("_text"), ""))
        rows = pc.list_parent_indices(words).to_numpy()
        written = pc.list_flatten(words).dictionary_encode()
        cleaned = pc.utf8_lower(pc.utf8_trim(written.dictionary, characters=string.punctuation))
        terms = cleaned.dictionary_encode()
        code = terms.indices.to_numpy()[written.indices.to_numpy()]
        general = _class_of(terms.dictionary).dictionary_encode()
        for names, codes in ((terms.dictionary, code), (general.dictionary, general.indices.to_numpy()[code])):
            held = np.unique(rows * np.int64(max(1, len(names))) + codes) % max(1, len(names))
            n = np.bincount(held, minlength=len(names)).astype(np.int64)
            size = pc.utf8_length(names).to_numpy(zero_copy_only=False)
            keep = pa.array((size > 0) & (size <= REACH))
            yield pa.RecordBatch.from_arrays([names.filter(keep), pa.array(n).filter(keep)], names=["term", "n_term"])


def _disclosing(found: DataFrame, docs: DataFrame, rows: int) -> DataFrame:
    """(entity, term): the terms, and classes, that tell too much of an entity."""
    near = found.select(F.explode("_near").alias("t")).select(
        "t.entity",
        F.explode(F.array(
            F.struct(F.col("t.term").alias("term"), F.col("t.new_term").alias("new")),
            F.struct(F.col("t.class").alias("term"), F.col("t.new_class").alias("new")),
        )).alias("s"),
    )
    pairs = (
        near.groupBy("entity", F.col("s.term").alias("term")).agg(F.sum("s.new").alias("n_both"))
        .filter(F.col("n_both") >= SUPPORT)
    )
    known = found.select(F.explode("_entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    counted = docs.select("_text").mapInArrow(_count, "term string, n_term bigint")
    counted = counted.groupBy("term").agg(F.sum("n_term").alias("n_term"))
    n = F.lit(float(max(1, rows)))
    told = F.log2(F.col("n_both") * n / (F.col("n_entity") * F.col("n_term")))
    held = F.log2(n / F.col("n_entity"))
    return (
        pairs.join(known, "entity").join(counted, "term")
        .filter((held > 0) & (told >= DISCLOSURE * held)).select("entity", "term")
    )


def _listed(spans: Column, kind) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, base (found data: kind number, start, end), terms
    (start, end, general: the class that stands for the term, null: removed) and, if asked
    for, the text itself."""
    columns = [F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")]
    docs = docs.select(*columns)
    kept = [F.col("_text").alias("text")] if keep_text else []
    schema = StructType([
        *docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", *kept).schema,
        *StructType.fromDDL(_FINDINGS),
    ])
    found = stored(
        docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", *kept, "_text").mapInArrow(_scan, schema),
        "pii-found",
    )
    telling = stored(_disclosing(found, docs, found.count()), "pii-telling")
    general = telling.select(F.col("entity"), F.col("term").alias("class"), F.lit(True).alias("too_close"))
    terms = (
        found.select("_row", F.explode("_near").alias("t")).select("_row", "t.entity", "t.term", "t.class", "t.start", "t.end")
        .join(telling, ["entity", "term"]).join(general, ["entity", "class"], "left")
        .groupBy("_row", "start", "end", "class").agg(F.max(F.coalesce("too_close", F.lit(False))).alias("gone"))
        .groupBy("_row").agg(F.sort_array(F.collect_list(F.struct(
            "start", "end", F.when(~F.col("gone"), F.col("class")).alias("general")
        ))).alias("terms"))
    )
    none = F.expr("cast(array() as array<struct<start:int,end:int,general:string>>)")
    return found.join(terms, "_row", "left").select(
        "doc_id", *(["text"] if keep_text else []), F.col("_found").alias("base"), F.coalesce("terms", none).alias("terms")
    )


def _held(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, and n_terms."""
    names = F.array(*[F.lit(k) for k in KINDS])
    base = _listed(F.col("base"), lambda s: names[s["kind"]])
    added = _listed(F.col("terms"), lambda s: F.lit("term"))
    return found.select(
        "doc_id",
        *[_held(i).cast("bigint").alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(added, F.lit(""))).alias("spans"),
        F.size("terms").cast("bigint").alias("n_terms"),
    )


def _blot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for row in batch.select(["text", "base", "terms"]).to_pylist():
            text, at, out = row["text"], 0, []
            marks = [(s["start"], -s["end"], f"<{KINDS[s['kind']]}>") for s in row["base"]]
            marks += [(s["start"], -s["end"], s["general"] or "<term>") for s in row["terms"]]
            for start, end, mark in sorted(marks):
                if start >= at:
                    out += [text[at:start], mark]
                at = max(at, -end)
            texts.append(None if text is None else "".join(out) + text[at:])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text: found data replaced by its kind in angle brackets, disclosing terms
    by their class or ``<term>``. Where findings overlap, the mark of the first stands for
    all of them. A null text stays null."""
    found = find(docs, doc_id, text, keep_text=True)
    return found.mapInArrow(_blot, found.select("doc_id", "text").schema)
