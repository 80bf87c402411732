"""Small document tables with every awkward row, and plain versions of rules."""

import random
import re
import string

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
    # Names that the operators use themselves.
    StructField("n_tokens", StringType()), StructField("score", StringType()), StructField("ids", StringType()),
])
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def corpus(seed=1, n=60):
    """Base texts, exact and near copies, shared passages, repeats, empty and null ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts = []
    for k in range(n):
        kind = k % 6
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        if kind == 1 and texts:
            base = words(rng.choice(texts))
        if kind in (2, 5) and texts:
            base = list(words(rng.choice(texts)))
            for _ in range(max(1, len(base) // 60)):
                if base:
                    base[rng.randrange(len(base))] = rng.choice(vocabulary)
        text = " ".join(base)
        texts.append(f"{text}\n{passage}" if kind == 3 else text.upper() if kind == 4 else text)
    texts += ["", "   \n\t ", "one two", "ONE TWO", "a a a a a a a a a a", "x" * 500, "x" * 500, "ÀÉ İstanbul 东京 " * 40]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(len(rows), None), (3, texts[3]), (None, texts[0]), (None, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    full = [(i, t, "en", "s", len(t or ""), "x", "y", "z") for i, t in rows]
    return spark.createDataFrame(full, DOCS)
