"""Centroid clustering and hard negatives against plain versions."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelake.llm import ann, centroids, negatives


def vectors(spark, rows, kind="float"):
    schema = f"vec_id bigint, embedding array<{kind}>, label int, cluster string, rank string, dim string, part string"
    return spark.createDataFrame([(*r, "x", "y", "z", "p") for r in rows], schema)


def plain_clusters(rows, k, rounds, dim):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in order[:k]]

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        at = place()
        for n in range(len(centres)):
            own = [v for (_, v), (_, m) in zip(kept, at) if m == n]
            if own:
                centres[n] = [sum(c) // len(own) for c in zip(*own)]
    at = place()
    total = sum(d for d, _ in at)
    return sorted(
        (str(i), n, d, sum(e for e, m in at if m == n), total, hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest())
        for (i, _), (d, n) in zip(kept, at)
    )


def clustered(rows):
    names = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((str(r["vec_id"]), *(r[n] for n in names)) for r in rows.collect())


def awkward(dim):
    inf, nan = float("inf"), float("nan")
    return [(900, None, 1), (901, [], 1), (902, [1.0] * (dim - 1), 1), (903, [None] + [1.0] * (dim - 1), 1),
            (904, [nan] + [0.0] * (dim - 1), 1), (905, [-inf] + [0.0] * (dim - 1), 1), (None, [0.5] * dim, 2),
            (906, [0.25] * dim, None), (907, [0.0] * dim, 3), (907, [0.0] * dim, 3), (907, [0.125] * dim, 4)]


@pytest.mark.parametrize("seed,dim,k,scale", [(1, 64, 16, 0.3), (2, 5, 12, 2.0), (3, 2, 16, 0.05), (4, 64, 16, 0.0)])
def test_clusters(spark, seed, dim, k, scale):
    """Many ties: small grids, equal vectors, and a group of copies of a third of all rows."""
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0, scale, dim)], 0) for i in range(160)]
    rows += [(1000 + i, [0.5] * dim, 0) for i in range(80)] + awkward(dim)
    got = centroids.cluster(vectors(spark, rows).repartition(3), k=k, dim=dim)
    assert clustered(got) == plain_clusters(rows, k, 3, dim)


def test_large_components(spark):
    """Beyond 64-bit sums all stays exact; what no long holds is null."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 10.0 ** (i % 8), 4)], 0) for i in range(60)]
    assert clustered(centroids.cluster(vectors(spark, rows), k=5, dim=4)) == plain_clusters(rows, 5, 3, 4)
    rows += [(100 + i, [3e38 * (-1) ** i] * 4, 0) for i in range(3)]
    got = centroids.cluster(vectors(spark, rows), k=3, dim=4).collect()
    want = plain_clusters(rows, 3, 3, 4)
    assert sorted((str(r["vec_id"]), r["cluster"], r["centroid_sha256"]) for r in got) == [(i, n, h) for i, n, *_, h in want]
    assert [r["distance"] for r in sorted(got, key=lambda r: str(r["vec_id"]))] == [d if d < 2**63 else None for _, _, d, *_ in want]


def test_tree_visits_few_nodes():
    """Far groups: the search skips most centroids, and still finds the nearest."""
    rng = np.random.default_rng(2)
    own = (rng.integers(0, 6, (200, 1)) * 10_000 + rng.integers(0, 50, (200, 8))).astype(np.int64)
    nodes = centroids.tree(own.astype(object))
    points = own[rng.integers(0, 200, 300)] + rng.integers(-9, 9, (300, 8))
    seen = []
    plain = centroids._squared

    def counted(a, b):
        seen.append(len(a))
        return plain(a, b)

    centroids._squared = counted
    try:
        number, squared = centroids.assign(points, own, nodes)
    finally:
        centroids._squared = plain
    every = ((points[:, None] - own[None]) ** 2).sum(axis=2)
    assert (squared == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()
    assert sum(seen) < 0.5 * len(points) * len(own)


def test_empty_clusters(spark):
    assert centroids.cluster(vectors(spark, [])).collect() == []
    assert centroids.cluster(vectors(spark, awkward(64)[:6])).collect() == []


def plain_negatives(rows, shift=True):
    best = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        row = (label, [float(np.float32(x)) for x in v])
        best[i] = min(best.get(i, row), row)
    table = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in best.items()}
    out = []
    for a, (label, v) in table.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, (m, w) in table.items() if i != a and len(w) == len(v))
        for p, i, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(a, i, r + 1, j, -p, -s) for r, (s, j, _) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows):
    df = vectors(spark, rows).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, label).collect())


@pytest.mark.parametrize("seed,dim,scale,shard", [(1, 16, 0.3, 8192), (2, 16, 0.3, 150), (3, 3, 0.02, 100), (4, 7, 3.0, 90)])
def test_hard_negatives(spark, monkeypatch, seed, dim, scale, shard):
    monkeypatch.setattr(negatives, "SHARD", shard)
    monkeypatch.setattr(negatives, "BLOCK", 4)
    monkeypatch.setattr(negatives, "TOGETHER", 16)
    rng = np.random.default_rng(seed)
    groups = rng.normal(0, scale, (10, dim))
    rows = []
    for i in range(900):
        g = int(rng.integers(0, 10))
        rows.append((i, [float(x) for x in groups[g] + rng.normal(0, scale, dim)], g))
    rows += [(1000 + i, [float(x) for x in groups[0]], i % 3) for i in range(300)] + awkward(dim)
    rows += [(2000 + 50 * i, [0.5, 0.25], 1 + i % 2) for i in range(9)] + [(3000, [], 1), (3100, [], 1), (3001, [], 2)]
    assert mined(spark, rows) == plain_negatives(rows)


def test_cells_are_in_order_and_bounds_hold():
    rng = np.random.default_rng(8)
    v = rng.integers(-400, 400, (600, 10)).astype(np.int64)
    index = negatives.Index(v, np.arange(600), np.zeros(600, np.int64))
    query = v[5]
    bounds, rows = [], 0
    for bound, a, b in index.cells(query):
        assert (index.vectors[a:b] @ query <= bound).all()
        bounds.append(bound)
        rows += b - a
    assert rows == 600 and bounds == sorted(bounds, reverse=True)


def test_no_negatives(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [0.5, 0.0], 2)]) == []


def plain_nearest(rows, asks, k):
    table = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = [float(np.float32(x)) for x in v]
            table[i] = min(table.get(i, v), v)
    out = {}
    for q in table:
        if not asks(q):
            continue
        w, scored = np.array(table[q]), []
        for i, v in table.items():
            if i != q and len(v) == len(w):
                v = np.array(v)
                scored.append((-(v * w).sum() / (np.linalg.norm(v) * np.linalg.norm(w)), i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def test_nearest_of_scaled_copies(spark):
    """Equal cosines in double precision go to the smaller ids, however many there are; so
    do nearly equal ones to the larger cosine."""
    rng = np.random.default_rng(3)
    base, near = rng.normal(size=16), rng.normal(size=16)
    rows = [(i, [float(x) for x in base * 2.0 ** (i % 23 - 11)]) for i in range(300, 0, -1)]
    rows += [(1000 + i, [float(x) for x in near + rng.normal(size=16) * 1e-6]) for i in range(250)]
    rows += [(2000 + i, [float(x) for x in rng.normal(size=16)]) for i in range(900)]
    df = vectors(spark, [(i, v, 0) for i, v in rows]).repartition(3).drop("rank", "score")
    asks = {50, 1000, 1100, 2050}
    got = {}
    for r in ann.nearest(df, F.col("vec_id").isin(list(asks)), 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = plain_nearest(rows, lambda q: q in asks, 5)
    assert set(got) == asks
    for q in (50, 1000, 1100):
        assert [(i, round(s, 12)) for _, i, s in sorted(got[q])] == [(i, round(s, 12)) for i, s in want[q]]
    assert [i for _, i, _ in sorted(got[50])] == [1, 2, 3, 4, 5]


def test_nearest_over_many_shards(spark, monkeypatch):
    """Recall over ten shards and more."""
    monkeypatch.setattr(ann, "SHARD", 300)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 24))
    rows = [(i, [float(x) for x in centres[i % 40] + rng.normal(size=24) * 0.6]) for i in range(3600)]
    df = vectors(spark, [(i, v, 0) for i, v in rows]).drop("rank", "score")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 90 == 0, 5).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = plain_nearest(rows, lambda q: q % 90 == 0, 5)
    hits = sum(len(got[q] & {i for i, _ in own}) for q, own in want.items())
    assert hits >= 0.9 * 5 * len(want)
