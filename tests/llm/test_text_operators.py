"""Encoders, counts, chat, quality and language model on small tables."""

import collections
import hashlib
import math
import struct
import zlib

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from ratelake.llm import bpe, chat, lm, quality, tokens

from .texts import corpus, frame, words

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def rows():
    return corpus()


def by_row(df, value):
    return sorted((str(r["doc_id"]), str(value(r))) for r in df.collect())


def test_bpe_is_the_library(spark, rows):
    import tiktoken

    ranks = {e: i for i, e in enumerate(bpe.read_ranks(RANKS))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    extra = [(900 + k, t) for k, t in enumerate(["  two  spaces ", "tab\t end\n\n", "it's we'll 'S", " \x1c x\x85", "😀" * 50, " <|endoftext|>"])]
    docs = frame(spark, rows + extra)
    encoded = bpe.encode(docs, RANKS, P.PATTERN)
    assert set(encoded.columns) == set(docs.columns)
    expected = {t: library.encode_ordinary(t or "") for _, t in rows + extra}
    for r in bpe.decode(encoded, RANKS, P.PATTERN).collect():
        ids = expected[r["text"]]
        assert bytes(r["ids"]) == struct.pack(f"<{len(ids)}I", *ids) and r["n_tokens"] == len(ids)
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    got = by_row(bpe.round_trip_digest(docs, RANKS, P.PATTERN), lambda r: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert got == sorted(
        (str(i), str((len(expected[t]), sha(struct.pack(f"<{len(expected[t])}I", *expected[t])), sha((t or "").encode()))))
        for i, t in rows + extra
    )
    assert bpe.round_trip_digest(frame(spark, []), RANKS, P.PATTERN).count() == 0


def test_counts_are_the_library(spark, rows):
    path = P.path("word_bpe_49k.json")
    counter = tokens.Counter(path)
    expected = {t: len(counter.tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in rows}
    got = tokens.token_counts(frame(spark, rows), path, 20)
    assert by_row(got, lambda r: (r["n_bytes"], r["n_tokens"], r["over_limit"])) == sorted(
        (str(i), str((len((t or "").encode()), expected[t], expected[t] > 20))) for i, t in rows
    )
    assert tokens.token_counts(frame(spark, []), path, 20).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(40, 4), (64, 16), (300, 30)])
def test_splices_are_the_whole(rows, chunk, overlap):
    counter = tokens.Counter(P.path("word_bpe_49k.json"), chunk, overlap)
    for text in {t or "" for _, t in rows} | {"no" * 2000, "<|endoftext|> mid <|startoftext|>" * 20, "e\u0301 İ ß " * 90}:
        assert counter.count(text) == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


def test_chat_round_trip(spark):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", r"\### a </turn> <|image|>"), (1, 1, "assistant", None), (1, 2, None, "n#: x"),
        (2, 0, "sys:tem", ""), (None, 0, "user", "lost"), (1, 5, "assistant", "ü" * 3000),
    ]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat.format_chat(rows.withColumn("parts", chat.text_part(F.col("text"))))
    for r in formatted.collect():
        mine = sorted(((t, ro or "", x or "") for c, t, ro, x in turns if c == r["conv_id"]), key=lambda z: (z[0], z[1], z[2]))
        assert [(role, "".join(t for _, t in parts)) for role, parts in chat.read_back(r["formatted"])] == [z[1:] for z in mine]
        masked = "".join(chat.unescape(r["formatted"][s["start"] : s["end"]]) for s in r["loss"])
        assert masked == "".join(z[2] for z in mine if z[1] == "assistant")
    assert chat.digest(formatted).count() == 3
    assert chat.digest(chat.format_chat(rows.limit(0).withColumn("parts", chat.text_part(F.col("text"))))).count() == 0


def test_chat_parts(spark):
    parts = [
        {"kind": "text", "text": "see <", "ref": None, "size": None}, {"kind": "image", "text": None, "ref": "a.png", "size": 1000.0},
        {"kind": "audio", "text": None, "ref": "b.wav", "size": 2.5}, {"kind": "document", "text": None, "ref": None, "size": None}, None,
    ]
    rows = spark.createDataFrame([(7, 0, "user", parts), (7, 1, "user", None)], f"conv_id long, turn int, role string, parts array<{chat.PART}>")
    r = chat.format_chat(rows).collect()[0]
    assert r["formatted"] == "### user:\nsee \\<<|image|><|audio|><|document|></turn>\n### user:\n</turn>\n"
    assert [(a["kind"], a["ref"], a["part"], a["n_tokens"]) for a in r["attachments"]] == [
        ("image", "a.png", 1, 6), ("audio", "b.wav", 2, 63), ("document", None, 3, 0),
    ]
    assert r["n_placeholder_tokens"] == 69
    assert chat.read_back(r["formatted"])[0][1] == [("text", "see <"), ("image", ""), ("audio", ""), ("document", "")]
    with pytest.raises(ValueError):
        chat.read_back("### user:\nbroken")


def test_quality_learns(spark):
    good = [(k, " ".join(w for w in ["the", "cat", "sat", "on", "mats", "here"][k % 3 :]) * (1 + k % 4)) for k in range(300)]
    bad = [(1000 + k, "BUY!! NOW!! CHEAP!! PILLS!! " * (1 + k % 5)) for k in range(300)]
    odd = [(5000, None), (5001, ""), (5001, ""), (None, "the cat"), (5002, "x" * 20000)]
    docs = frame(spark, good + bad + odd)
    labels = [(i, 1) for i, _ in good[::2]] + [(i, 0) for i, _ in bad[::2]] + [(2, None), (None, 1), (0, 1), (99999, 0)]
    scored = quality.score(docs, spark.createDataFrame(labels, "doc_id long, quality int"), "score").collect()
    assert len(scored) == len(good + bad + odd) and all(0 <= r["score"] <= 1 for r in scored)
    held = {i for i, _ in good[1::2] + bad[1::2]}
    right = [(r["score"] >= quality.THRESHOLD) == (r["doc_id"] < 1000) for r in scored if r["doc_id"] in held]
    assert sum(right) >= 0.98 * len(right)
    none = quality.score(docs, spark.createDataFrame([], "doc_id long, quality int")).select("score").distinct().collect()
    assert [r[0] for r in none] == [1.0]
    assert quality.score(frame(spark, []), spark.createDataFrame(labels, "doc_id long, quality int")).count() == 0


def test_lm_base_and_distribution(spark, rows):
    got = lm.score(frame(spark, rows)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    text = [(i, [*words(t), None]) for i, t in rows]
    counts = collections.Counter(w for i, ws in text for w in ws if not held(i))
    total, distinct = sum(counts.values()), len(counts)
    expected = sorted(
        (str(i), held(i), len(ws), sum(counts[w] > 0 for w in ws), total,
         round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws), 6))
        for i, ws in text
    )
    assert expected == sorted(
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got
    )
    assert all(r["score"] < 0 for r in got)
    assert lm.score(frame(spark, [])).count() == 0
    assert lm.score(frame(spark, [(None, None)])).collect()[0]["n_tokens"] == 1


def test_lm_classes_sum_to_one():
    import numpy as np

    rng = np.random.default_rng(0)
    rows = rng.integers(0, lm.ROWS, (50, 5))
    logs = lm._log_classes(rng.normal(0, 1, (lm.ROWS, lm.CLASSES)).astype(np.float32), np.zeros(lm.CLASSES, np.float32), rows)
    assert np.allclose(np.exp(logs).sum(1), 1, atol=1e-4)


def test_unknown_kinds_of_parts():
    """They are attachments without tokens, and the text stays readable."""
    parts = [{"kind": "video", "ref": "v"}, {"kind": "text", "text": "a <|video|> b"}, {"kind": "a|b", "ref": "w"}, {"kind": "_attach"}]
    out = chat.format_turns([{"role": "user", "parts": parts}])
    assert [(a["kind"], a["ref"], a["n_tokens"], a["part"]) for a in out["attachments"]] == [
        ("video", "v", 0, 0), ("unknown", "w", 0, 2), ("_attach", None, 0, 3)]
    assert chat.read_back(out["formatted"]) == [
        ("user", [("video", ""), ("text", "a <|video|> b"), ("unknown", ""), ("_attach", "")])]
