"""Order and range operators against brute force, with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from ratelake.operators.keyed import absent_rows, compare_keys, first_per_key, insert_if_absent, replace_by_key
from ratelake.operators.ordered import asof_join, prior_of_other_owner
from ratelake.operators.ranges import range_join, range_lookup


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    best = first_per_key(df, ["k"], [F.col("id").desc()])
    assert "WindowGroupLimit" in plan(best) and "Partial" in plan(best)
    assert {(r.k, r.id) for r in best.collect()} == {(0, 999), (1, 997), (2, 998)}


def test_insert_if_absent_is_idempotent_and_null_keys_never_conflict(spark):
    old = spark.createDataFrame([(1, "a", 1), (None, "n", 2)], "k int, s string, v int")
    new = spark.createDataFrame([(1, "a", 9), (2, "b", 5), (2, "b", 4), (None, "n", 7)], "k int, s string, v int")
    out = insert_if_absent(old, new, ["k", "s"], [F.col("v")])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "a", 1), (None, "n", 2), (2, "b", 4), (None, "n", 7)], key=str
    )
    again = absent_rows(out, new.filter("k IS NOT NULL"), ["k", "s"], [F.col("v")])
    assert again.count() == 0


def test_replace_clears_a_parent_that_comes_back_empty(spark):
    old = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (3, "w")], "p int, c string")
    parents = spark.createDataFrame([(1,), (2,)], "p int")
    children = spark.createDataFrame([(2, "new")], "p int, c string")
    once = replace_by_key(old, parents, children, ["p"])
    assert sorted(map(tuple, once.collect())) == [(2, "new"), (3, "w")]
    assert sorted(map(tuple, replace_by_key(once, parents, children, ["p"]).collect())) == [(2, "new"), (3, "w")]


def test_compare_keys(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert {tuple(r) for r in compare_keys(a, b, ["k"]).collect()} == {(1, "missing"), (3, "extra")}


def _rows(seed, n, keys, span):
    rng = random.Random(seed)
    # A third of the rows share one key.
    return [(0 if rng.random() < 1 / 3 else rng.randrange(keys), rng.randrange(span), i) for i in range(n)]


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("bucketed", [True, False])
def test_asof_join(spark, inclusive, bucketed):
    left, right = _rows(1, 300, 6, 200), _rows(2, 120, 6, 200)
    l = spark.createDataFrame(left, "k int, t int, id int")
    r = spark.createDataFrame(right, "k int, u int, rid int")
    bucket = F.floor(F.col("t") / 16) if bucketed else None
    out = asof_join(l, r, ["k"], "t", "u", [F.col("rid")], inclusive, bucket)
    got = {x.id: (x.u, x.rid) for x in out.collect()}
    assert len(got) == len(left)
    for k, t, i in left:
        fits = [(u, -rid) for k2, u, rid in right if k2 == k and (u <= t if inclusive else u < t)]
        want = max(fits, default=None)
        assert got[i] == ((want[0], -want[1]) if want else (None, None))


@pytest.mark.parametrize("bucketed", [True, False])
def test_prior_of_other_owner(spark, bucketed):
    rng = random.Random(3)
    rows = {(rng.choice([0, 0, 1, 2]), rng.randrange(40), rng.choice("aabcd")) for _ in range(150)}
    df = spark.createDataFrame(sorted(rows), "k int, t int, o string")
    bucket = F.floor(F.col("t") / 4) if bucketed else None
    got = {(r.k, r.t, r.o): (r.prior_t, r.prior_o) for r in prior_of_other_owner(df, ["k"], "t", "o", bucket).collect()}
    assert set(got) == rows
    for k, t, o in rows:
        fits = [(t2, o2) for k2, t2, o2 in rows if k2 == k and t2 < t and o2 != o]
        want = min(fits, key=lambda x: (-x[0], x[1]), default=(None, None))
        assert got[(k, t, o)] == want


def test_range_lookup(spark):
    rng = random.Random(4)
    brackets = []
    for pos in range(250):
        lo = round(rng.uniform(0, 60), 2)
        hi = round(lo + rng.choice([0, 0.01, 0.5, 4, 30]), 2)
        kind = rng.random()
        brackets.append((
            0 if rng.random() < 0.4 else rng.randrange(4),
            None if kind < 0.1 else lo, None if 0.1 <= kind < 0.2 else hi, pos,
        ))
    brackets.append((3, None, None, 40))
    facts = [(rng.randrange(4), round(rng.uniform(-5, 70), 2)) for _ in range(300)] + [(1, None), (9, 1.0)]
    f = spark.createDataFrame(facts, "k int, v double")
    b = spark.createDataFrame(brackets, "k int, lo double, hi double, pos int")
    got = {(r.k, r.v): r.pos for r in range_lookup(f, b, ["k"], "v", "lo", "hi", "pos").collect()}
    for k, v in facts:
        fits = [
            pos for k2, lo, hi, pos in brackets
            if v is not None and k2 == k and (lo is None or lo <= v) and (hi is None or v < hi + 1e-9)
        ]
        assert got.get((k, v)) == min(fits, default=None)
    joined = range_join(f, b, ["k"], "v", "lo", "hi", "pos")
    assert joined.count() == sum((k, v) in got for k, v in facts)
    assert "CartesianProduct" not in plan(joined) and "NestedLoop" not in plan(joined)


def parity_side(spark, rows):
    ddl = "carrier string, source_id string, captured_at string, program string, table_index int, bracket_index int, bracket_id string, surcharge_percent double"
    brackets = spark.createDataFrame(rows, ddl)
    return brackets.groupBy("carrier", "source_id", "captured_at").agg(
        F.max(F.lit(None).cast("string")).alias("effective_date"), F.max(F.lit(None).cast("string")).alias("path")
    ), brackets, brackets


def test_parity_reads_each_input_once(spark):
    """Snapshots without paths still match, and the report reads stored levels only."""
    from ratelake.operators.parity import compare_runs

    a = parity_side(spark, [("u", "s", "t", "p", 0, 0, "x", 1.0), ("u", "s", "t", None, 0, 0, "y", 1.0), ("u", "z", "t", "p", 0, 0, "x", 1.0)])
    b = parity_side(spark, [("u", "s", "t", "p", 0, 0, "x", 2.0), ("u", "s", "t", "p", 1, 0, "x", 3.0), ("u", "s", "t", "q", 0, 0, "y", 1.0)])
    feed = "group_key string, bracket_id string, old_value double, new_value double, position int"
    d1 = spark.createDataFrame([("g", "x", 1.0, 2.0, 0), ("g", None, 1.0, 1.0, 1), ("h", "x", 1.0, 2.0, 0)], feed)
    d2 = spark.createDataFrame([("g", "x", 1.0, 2.0, 0), ("g", "x", 1.0, 2.5, 1), ("k", "x", 1.0, 2.0, 0)], feed)
    items = compare_runs(*zip(a, b), (d1, d2))
    assert sorted((r.category, r.scope, r.message) for r in items.collect()) == sorted([
        ("BRACKET_VALUE_MISMATCH", "snapshot", "surcharge_percent mismatch for p x"),
        ("SCOPE_OR_DATE_MISMATCH", "snapshot", "program missing in llm: null"),
        ("SCOPE_OR_DATE_MISMATCH", "snapshot", "extra program in llm: q"),
        ("MISSING_IN_LLM", "snapshot", "snapshot missing in llm"),
        ("BRACKET_VALUE_MISMATCH", "delta", "new_value mismatch for x"),
        ("MISSING_IN_LLM", "delta", "delta group missing in llm"), ("EXTRA_IN_LLM", "delta", "extra delta group in llm"),
    ] + [("SCOPE_OR_DATE_MISMATCH", "delta", None)])
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    # The stored frames: snapshots once, programs and groups of deltas twice.
    assert plan.count("Relation [") == 5
