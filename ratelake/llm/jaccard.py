"""N-gram Jaccard join of texts by set relations.

A text is its set of distinct word shingles. Texts link when the Jaccard similarity
of their sets reaches a threshold given as a fraction; the result is a component per
text. All links are found: every filter below only passes over pairs that cannot link.

* Equal sets are one class; only classes are joined.
* Shingles that many texts of one chunk share come last in the order of every set,
  the more frequent the later (a bounded list; which it holds changes cost only), the
  others come in hash order. Two linked sets share a shingle of their prefixes, and
  the smaller one has it in its even shorter index prefix.
* Index lists are ordered by position and carry set sizes. Blocks of sizes that cannot
  link are skipped, and so are entries whose positions leave too few shingles.
* Lists are not paired out. First each set is compared with the pivot it meets most;
  that answer stands for all sets of the pivot's component, and the differences from
  one pivot p bound the overlap of any two sets without reading them again:
  |x & z| <= |p| - |(p - x) | (p - z)| + |(x - p) & (z - p)|, with sketches of the
  differences. Only pairs of different components that pass are compared afterwards.
  Those of one pivot meet by way of it, once each, and not in every list they share.
* Texts travel to a pair only if signatures, of some bits per shingle, leave it possible:
  a bit that one set has alone is a shingle that the other lacks.

Null and empty texts and texts without words have an empty set and stand alone. A text
of fewer words than a shingle has is one shingle. Rows that repeat an id are one node,
linked with all that any of its texts is; rows without id take their class's component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import WINDOW, discard, pieces, shingles, stored, text_bytes, words
from ratelake.llm.components import components

N = 5
SHARE = 80  # percent
CHUNK = 4 << 20  # shingles whose frequencies are counted together
LOCAL_HOT, HOT = 2, 16  # different texts of a chunk, and of all chunks, with a frequent shingle
HOT_LIST = 1 << 20  # frequent shingles that are ordered by frequency
SMALL = 1 << 20  # ids, of 8 bytes each, that are broadcast
DOUBLINGS, CIRCLE = 3, 3  # steps from pivot to pivot, as powers of two; classes of a circle
WORDS = 4  # 64-bit words of a difference sketch
FAMILY = 30  # percent of similarity from which a pivot's answer says something about others
BITS, MOST_BITS = 4, 1 << 19  # bits of a signature per shingle, at least, and in all
SEEN = 1 << 18  # classes that a task remembers to report once


def sets(array: pa.Array, n: int = N) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each row."""
    hashes, rows, _, _ = words(*text_bytes(array))
    values, row, _ = shingles(hashes, rows, n)
    ends = np.searchsorted(row, np.arange(1, len(array) + 1))
    low = 0
    for high in ends.tolist():
        part = np.sort(values[low:high])
        if len(part) > 1:
            part = part[np.concatenate([[True], part[1:] != part[:-1]])]
        yield part
        low = high


def digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def class_number(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def signature(values: np.ndarray) -> bytes:
    """Bit k is set if a hash is k modulo the number of bits, a power of two."""
    bits = min(MOST_BITS, max(64, 1 << (BITS * len(values) - 1).bit_length()))
    flags = np.zeros(bits, bool)
    flags[(values & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def most_overlap(size_a: int, a: bytes, size_b: int, b: bytes) -> int:
    """A bound of the overlap of two sets from their sizes and signatures: every bit that
    one has alone is a shingle that the other lacks."""
    if len(a) > len(b):
        size_a, a, size_b, b = size_b, b, size_a, a
    short, long = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64).reshape(-1, len(a) // 8)
    alone = np.bitwise_count(short & ~np.bitwise_or.reduce(long)).sum(), np.bitwise_count(long & ~short).sum()
    return min(size_a - int(alone[0]), size_b - int(alone[1]))


def needed(size_a, size_b):
    """Least overlap of linked sets of these sizes: ceil(share * (a + b) / (100 + share))."""
    return -(-SHARE * (size_a + size_b) // (100 + SHARE))


def probe_prefix(size):
    return size - -(-SHARE * size // 100) + 1


def index_prefix(size):
    return size - needed(size, size) + 1


def profile(docs: DataFrame) -> DataFrame:
    """Rows of kind 0: doc_id, n_shingles, digest, class number and signature; of kind 1:
    shingles frequent in a chunk and in how many different sets they occur there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        count = 0

        def frequent() -> pa.RecordBatch:
            values = np.concatenate([*held.values()]) if held else np.zeros(0, np.uint64)
            held.clear()
            values.sort()
            first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
            size = np.diff(np.concatenate([first, [len(values)]]))
            hot = size >= LOCAL_HOT
            n = int(hot.sum())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ones(n, np.int32)), pa.nulls(n, id_type), pa.array(size[hot].astype(np.int64)),
                    pa.nulls(n, pa.binary()), pa.array(values[first[hot]].view(np.int64)), pa.nulls(n, pa.binary()),
                ],
                names,
            )

        id_type = pa.int64()
        for batch in pieces(batches, "text"):
            each = list(sets(batch.column("text")))
            keys = [digest(s) for s in each]
            id_type = batch.column("doc_id").type
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(each), np.int32)), batch.column("doc_id"),
                    pa.array([len(s) for s in each], pa.int64()), pa.array(keys, pa.binary()),
                    pa.array([class_number(k) for k in keys], pa.int64()),
                    pa.array([signature(s) if len(s) else None for s in each], pa.binary()),
                ],
                names,
            )
            held |= zip(keys, each)
            count += sum(map(len, each))
            if count >= CHUNK:
                yield frequent()
                count = 0
        yield frequent()

    names = ["kind", "doc_id", "n_shingles", "digest", "number", "signature"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"kind int, doc_id {kind}, n_shingles bigint, digest binary, number bigint, signature binary"
    )


def prefixes(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """(shingle, cls, size, pos): the probe prefix of every class, once per task at least.

    ``hot``: frequent shingles in the order of frequency, as unsigned numbers.
    """
    by_value = np.argsort(hot, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((hot[by_value], by_value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, rank = shared.value
        seen: set[bytes] = set()
        for batch in pieces(batches, "text"):
            out: list[tuple] = []
            for s in sets(batch.column("text")):
                key = digest(s)
                if len(s) == 0 or key in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(key)
                if len(values):
                    at = np.minimum(np.searchsorted(values, s), len(values) - 1)
                    late = values[at] == s
                    order = np.concatenate([s[~late], s[late][np.argsort(rank[at[late]], kind="stable")]])
                else:
                    order = s
                out.append((order[: probe_prefix(len(s))], class_number(key), len(s)))
            length = [len(p) for p, _, _ in out]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([p for p, _, _ in out]).view(np.int64) if out else np.zeros(0, np.int64)),
                    pa.array(np.repeat(np.array([c for _, c, _ in out], np.int64), length)),
                    pa.array(np.repeat(np.array([n for _, _, n in out], np.int32), length)),
                    pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in length]) if out else np.zeros(0, np.int32)),
                ],
                ["shingle", "cls", "size", "pos"],
            )

    return docs.select("text").mapInArrow(run, "shingle bigint, cls bigint, size int, pos int")


def _read_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shingle, pos, cls) → the entries of lists of two and more, each
    with a pivot whose size can link with its own: the first class of the list, or of
    those entries that the first is too large or too small for.

    The first of a list has the fewest rarer shingles, so it is next to what the list's
    sets have in common. A list of any length streams through: one pivot is remembered.
    """
    names = ["shingle", "a", "size", "pos", "pivot"]
    held: list[np.ndarray] | None = None  # a last row that may be a list of its own
    open_list: tuple[int, int, int, int] | None = None  # shingle, last class, pivot, its size

    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
            held = None
        s, cls = columns[:2]
        if len(s) == 0:
            continue
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != s[:-1]) | (cls[1:] != cls[:-1])
        keep[0] = open_list is None or (open_list[0], open_list[1]) != (int(s[0]), int(cls[0]))
        s, cls, size, pos = (c[keep] for c in columns)
        if len(s) == 0:
            continue
        goes_on = open_list is not None and open_list[0] == int(s[0])
        begins = np.ones(len(s), bool)
        begins[1:] = s[1:] != s[:-1]
        alone = begins.copy()
        alone[:-1] &= s[1:] != s[:-1]
        if goes_on:
            alone[0] = False
        if alone[-1]:
            held = [c[-1:] for c in (s, cls, size, pos)]
        first = np.flatnonzero(begins)
        group = np.cumsum(begins) - 1
        pivot, base = cls[first][group], size[first][group].astype(np.int64)
        if goes_on:
            pivot[group == 0], base[group == 0] = open_list[2], open_list[3]
        while True:  # once per block of sizes
            small, large = np.minimum(base, size), np.maximum(base, size)
            far = np.flatnonzero(100 * small < SHARE * large)
            if len(far) == 0:
                break
            _, at, which = np.unique(group[far], return_index=True, return_inverse=True)
            pivot[far], base[far] = cls[far[at]][which], size[far[at]][which]
        open_list = None if alone[-1] else (int(s[-1]), int(cls[-1]), int(pivot[first[-1]]), int(base[first[-1]]))
        out = ~alone
        yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in (s, cls, size, pos, pivot)], names)


_SKETCH = [f"{name}{k}" for name in ("gone", "extra") for k in range(WORDS)]


def _sketch(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which of 64 * WORDS buckets the shingles outside ``common`` fall in, as bits."""
    rest = np.setdiff1d(values, common, assume_unique=True) % np.uint64(64 * WORDS)
    out = np.zeros(WORDS, np.uint64)
    np.bitwise_or.at(out, (rest >> np.uint64(6)).astype(np.int64), np.uint64(1) << (rest & np.uint64(63)))
    return out.view(np.int64)


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes (null: empty)."""
    for batch in pieces(batches, "text"):
        texts = [zstandard.compress(t or b"", 3) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])


def _near(pairs: DataFrame, classes: DataFrame, share: int, kind: str) -> DataFrame:
    """(a, b, u, v) of the class pairs whose signatures allow a similarity of ``share`` percent."""
    of = classes.select("cls", "rep", "n_shingles", "signature")
    named = pairs.join(of.toDF("a", "u", "size_a", "signature_a"), "a").join(of.toDF("b", "v", "size_b", "signature_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = zip(*(batch.column(c).to_pylist() for c in ("size_a", "signature_a", "size_b", "signature_b")))
            sizes = (batch.column(c).to_numpy() for c in ("size_a", "size_b"))
            most = np.array([most_overlap(*k) for k in known], np.int64)
            near = 100 * most >= share * (sum(sizes) - most)
            yield batch.select(["a", "b", "u", "v"]).filter(pa.array(near))

    return named.filter(F.col("u") != F.col("v")).mapInArrow(run, f"a bigint, b bigint, u {kind}, v {kind}")


def overlaps(pairs: DataFrame, classes: DataFrame, docs: DataFrame, share: int = SHARE) -> DataFrame:
    """(a, b, u, v, size_a, size_b, overlap) of those class pairs (a, b) that may have a
    similarity of ``share`` percent, from whole texts, with sketches of what a lacks of b
    (gone) and has beside it (extra).

    u, v: the ids that stand for the classes; own: the texts are of the classes, not others
    that have the same ids.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = stored(_near(pairs, classes, share, kind), "jaccard-pairs")
    wanted = named.select(F.col("u").alias("doc_id")).union(named.select("v")).distinct()
    if wanted.count() <= SMALL:  # a checked size; otherwise texts are shuffled
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    # Each text travels to its pairs twice, so it is compressed once for all of them.
    texts = stored(texts.mapInArrow(_compressed, f"doc_id {kind}, text binary"), "jaccard-texts")
    with_left = named.join(texts.toDF("u", "text_a"), "u")
    with_both = with_left.join(texts.toDF("v", "text_b"), "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in pieces(batches, "text_a", WINDOW // 4):
            for batch in pieces([whole], "text_b", WINDOW // 4):
                left, right = (
                    list(sets(pa.array([zstandard.decompress(t) for t in batch.column(c).to_pylist()], pa.binary())))
                    for c in ("text_a", "text_b")
                )
                both = [np.intersect1d(x, y, assume_unique=True) for x, y in zip(left, right)]
                gone = np.stack([_sketch(y, z) for y, z in zip(right, both)]) if both else np.zeros((0, WORDS), np.int64)
                extra = np.stack([_sketch(x, z) for x, z in zip(left, both)]) if both else gone
                numbers = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), left, right)
                own = [(class_number(digest(x)), class_number(digest(y))) == (a, b) for a, b, x, y in numbers]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in ("a", "b", "u", "v")], pa.array(own, pa.bool_()), pa.array([len(x) for x in left], pa.int64()),
                        pa.array([len(y) for y in right], pa.int64()), pa.array([len(z) for z in both], pa.int64()),
                        *[pa.array(m[:, k].copy()) for m in (gone, extra) for k in range(WORDS)],
                    ],
                    ["a", "b", "u", "v", "own", "size_a", "size_b", "overlap", *_SKETCH],
                )

    out = stored(
        with_both.select("a", "b", "u", "v", "text_a", "text_b").mapInArrow(
            compare,
            f"a bigint, b bigint, u {kind}, v {kind}, own boolean, size_a bigint, size_b bigint, overlap bigint, "
            + ", ".join(f"{c} bigint" for c in _SKETCH),
        ),
        "jaccard-overlaps",
    )
    discard(named, texts)
    return out


LINKED = f"100 * overlap >= {SHARE} * (size_a + size_b - overlap)"


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    rows = stored(profile(docs), "jaccard-profile")
    known = rows.filter("kind = 0").select("doc_id", "n_shingles", "digest", "number", "signature")
    frequent = (
        rows.filter("kind = 1").groupBy(F.col("number").alias("shingle")).agg(F.sum("n_shingles").alias("n")).filter(F.col("n") >= HOT)
        .orderBy(F.desc("n"), "shingle").limit(HOT_LIST).toArrow()  # a bounded list
    )
    hot = frequent.column("shingle").to_numpy().view(np.uint64)[::-1].copy()
    classes = stored(
        known.filter("n_shingles > 0").groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("number").alias("cls"), F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        ),
        "jaccard-classes",
    )
    lists = prefixes(docs, hot)
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = stored(
        lists.repartition(n_parts, "shingle").sortWithinPartitions("shingle", "pos", "cls")
        .mapInArrow(_read_lists, "shingle bigint, a bigint, size int, pos int, pivot bigint"),
        "jaccard-lists",
    )
    # First every class with the pivot it meets most: one comparison per class at most.
    met = entries.filter("a <> pivot").groupBy("a", "pivot").agg(F.count("*").alias("n"))
    pairs = met.groupBy("a").agg(F.max(F.struct("n", F.col("pivot").alias("b"))).alias("m")).select("a", "m.b")
    first = overlaps(pairs, classes, docs, FAMILY)
    # Then with the pivot's pivot and so on, so that a family has one pivot in common.
    roots = stored(_roots(first), "jaccard-roots")
    second = overlaps(roots.filter("root <> a AND root <> b").select("a", F.col("root").alias("b")), classes, docs, FAMILY)
    compared = first.unionByName(second)
    family = f"own AND 100 * overlap >= {FAMILY} * (size_a + size_b - overlap)"
    by_root = second.filter(family)
    own = first.filter(family).join(roots.filter("root <> a").select("a"), "a", "left_semi")
    # Rows that repeat an id and a text repeat an answer.
    answers = by_root.unionByName(own.join(by_root.select("a"), "a", "left_anti")).dropDuplicates(["a"])
    links = compared.filter(LINKED).select("u", "v")
    groups = stored(components(links, "jaccard-components"), "jaccard-groups")
    later = _between_groups(entries, compared, answers, classes, groups, docs)
    more = later.filter(LINKED).select("u", "v")
    if not more.isEmpty():
        before, groups = groups, stored(components(links.union(more), "jaccard-components"), "jaccard-groups")
        discard(before)
    discard(entries, first, second, roots, later)
    by_class = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component")
    )
    return known.join(by_class, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def _roots(compared: DataFrame) -> DataFrame:
    """(a, b, root): where the way from pivot to pivot ends. It is followed 2^DOUBLINGS
    steps by doubling; there it may circle among a few classes, of which the least is taken.
    """
    step = compared.select("a", "b").distinct()
    walk = step.withColumn("at", F.col("b"))

    def ahead(frame: DataFrame, way: DataFrame, name: str) -> DataFrame:
        return frame.join(way.toDF("at", "_next"), "at", "left").withColumn(name, F.coalesce("_next", "at")).drop("_next")

    for _ in range(DOUBLINGS):
        walk = stored(ahead(walk, walk.select("a", "at"), "at2").drop("at").withColumnRenamed("at2", "at"), "jaccard-walk")
    walk = walk.withColumn("root", F.col("at"))
    for _ in range(CIRCLE):
        walk = ahead(walk, step, "at2").drop("at").withColumnRenamed("at2", "at").withColumn("root", F.least("root", "at"))
    return walk.select("a", "b", "root")


def _between_groups(
    entries: DataFrame, compared: DataFrame, answers: DataFrame, classes: DataFrame, groups: DataFrame, docs: DataFrame
) -> DataFrame:
    """Overlaps of the pairs that no answer has settled yet: of those with one pivot, met
    once each by way of it, and of the others that meet in a list.
    """
    component = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("cls").alias("a"), F.coalesce("component", "rep").alias("component")
    )

    def open_ones(rows: DataFrame, key: str) -> DataFrame:
        """The rows of a key with several components."""
        split = rows.groupBy(key).agg(F.min("component").alias("x"), F.max("component").alias("y"))
        return rows.join(split.filter("x <> y").select(key), key, "left_semi")

    answer = answers.select("a", F.col("b").alias("p"), F.col("size_a").alias("size"), "size_b", "overlap", *_SKETCH)
    family = stored(open_ones(answer.join(component, "a"), "p"), "jaccard-families")
    named = entries.drop("pivot").join(component.join(answer.select("a", "p"), "a", "left"), "a")
    lists = stored(open_ones(named.withColumn("p", F.coalesce("p", "a")), "shingle"), "jaccard-open")
    pairs = _open_pairs(family, lists).distinct()
    done = compared.select("a", "b").union(compared.select("b", "a"))
    out = overlaps(pairs.join(done, ["a", "b"], "left_anti"), classes, docs)
    discard(family, lists)
    return out


def _open_pairs(family: DataFrame, lists: DataFrame) -> DataFrame:
    """(a, b) of classes that may link: a row per pair of one pivot, and a row per list in
    which a pair of different pivots meets."""
    need = f"ceil({SHARE} * (y.size + x.size) / {100 + SHARE})"
    own = f"(y.size - ceil({2 * SHARE} * y.size / {100 + SHARE}) + 1)"
    sizes = f"(y.size < x.size OR (y.size = x.size AND y.a < x.a)) AND 100 * y.size >= {SHARE} * x.size"
    # Of the pivot both keep what neither lacks; beside it they share what both have.
    only = lambda name, s, t: " + ".join(f"bit_count({s}.{name}{k} & ~{t}.{name}{k})" for k in range(WORDS))
    lacking = " , ".join(f"{s}.size_b - {s}.overlap + {only('gone', t, s)}" for s, t in ("xy", "yx"))
    beside = " , ".join(f"{s}.size - {s}.overlap - ({only('extra', s, t)})" for s, t in ("xy", "yx"))
    bound = f"(x.size_b - greatest({lacking}) + least({beside}))"
    within = f"x.p = y.p AND x.component <> y.component AND {sizes} AND {bound} >= {need}"
    across = f"""x.shingle = y.shingle AND x.component <> y.component AND x.p <> y.p AND {sizes}
      AND y.pos < {own} AND least(x.size - x.pos, y.size - y.pos) >= {need}"""
    ends = F.col("y.a").alias("a"), F.col("x.a").alias("b")
    pairs = family.alias("y").join(family.alias("x"), F.expr(within)).select(*ends)
    return pairs.union(lists.alias("y").join(lists.alias("x"), F.expr(across)).select(*ends))
