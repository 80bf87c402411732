"""Gate, normalisation, diff, parity and discovery on literal documents."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from ratelake.operators import parity as P
from ratelake.operators.diff import ID, snapshot_diff, snapshot_pairs
from ratelake.operators.discovery import discover
from ratelake.operators.gate import gate
from ratelake.operators.normalize import flatten_brackets, flatten_tables, normalize
from ratelake.operators.revalidate import revalidate
from ratelake.session import shared_dir

GOOD = {
    "artifact_type": "html", "carrier": "UPS", "source_id": "s1", "effective_date": "January 8, 2026",
    "effective_date_evidence": None,
    "programs": [{
        "program": "ground", "table_title": None, "table_title_evidence": None, "basis_hint": "diesel",
        "brackets": [
            {"range_text": "$1.50 - $1.99", "percent_text": "5.00%", "row_evidence": "r"},
            {"range_text": "2.00 or more", "percent_text": "n/a", "row_evidence": "r"},
        ],
        "table_evidence": None,
    }],
    "history_90d": None, "extra_key": 1,
}


def change(path, value):
    doc = copy.deepcopy(GOOD)
    *head, last = path
    at = doc
    for p in head:
        at = at[p]
    if value is KeyError:
        del at[last]
    else:
        at[last] = value
    return doc


def run_gate(spark, docs):
    rows = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    df = gate(spark.createDataFrame(rows, "i int, raw string"), "raw")
    return [[tuple(e) for e in r.issues] for r in df.orderBy("i").select("issues").collect()]


def test_gate(spark):
    b = ["programs", 0, "brackets", 1]
    cases = [
        (GOOD, []),
        (change(["history_90d"], KeyError), [("history_90d", "Required")]),
        (change(["programs"], KeyError), []),
        (change(["programs"], None), [("programs", "Expected array, received null")]),
        (change(["source_id"], ""), [("source_id", "String must contain at least 1 character(s)")]),
        (change(["source_id"], 5), [("source_id", "Expected string, received number")]),
        (change(["carrier"], "DHL"), [("carrier", "Invalid enum value. Expected 'UPS' | 'FedEx', received 'DHL'")]),
        (change(["carrier"], None), [("carrier", "Expected 'UPS' | 'FedEx', received null")]),
        (change([*b, "range_text"], KeyError), [("programs.0.brackets.1.range_text", "Required")]),
        (change([*b, "row_evidence"], "x" * 301),
         [("programs.0.brackets.1.row_evidence", "String must contain at most 300 character(s)")]),
        (change(["programs", 0, "brackets"], KeyError), []),
        (change(["programs", 0, "basis_hint"], None), []),
        (change(["programs", 0], "x"), [("programs.0", "Expected object, received string")]),
        (change(["history_90d"], {"rows": [{"week_of": "24", "ground_percent_text": None,
                                           "air_percent_text": "", "row_evidence": "r"}]}),
         [("history_90d.rows.0.week_of", "String must contain at least 4 character(s)"),
          ("history_90d.rows.0.air_percent_text", "String must contain at least 1 character(s)")]),
        (change(["links"], [{"href": "/x", "link_text": None, "effective_date": None, "evidence_snippet": "e"}]),
         [("links.0.href", "Invalid url")]),
        ("[]", [("", "Expected object, received array")]),
        ("{\"a", [("", "Invalid JSON")]),
    ]
    got = run_gate(spark, [c[0] for c in cases])
    assert got == [c[1] for c in cases]


def captures(spark, docs):
    """docs: (source, run, captured_at, document)"""
    rows = [("ups", s, r, at, "http://u", "text/html", d if isinstance(d, str) else json.dumps(d)) for s, r, at, d in docs]
    return spark.createDataFrame(
        rows, "carrier string, source_id string, run_id string, captured_at string, source_url string, "
        "content_type string, raw string",
    )


def test_normalize(spark):
    empty = change(["programs"], [])
    flagged = change(["parse_warnings"], [{"code": "PARSER_STRUCTURAL_ERROR", "message": "m", "severity": "error"}])
    other = change(["source_id"], "s2")
    rows = normalize(
        captures(spark, [("s1", "r", "1", GOOD), ("s1", "r", "2", empty), ("s1", "r", "3", flagged),
                         ("s1", "r", "4", other), ("s1", "r", "5", change(["carrier"], 1))]), "raw",
    ).orderBy("captured_at").collect()
    good, none, flag, scope, bad = rows
    table = good.snapshot.tables[0]
    assert (table.program, table.effective_date) == ("ground", "2026-01-08")
    assert [(b.bracket_id, b.min_index, b.max_index, b.surcharge_percent) for b in table.brackets] == [
        ("1.50_1.99", 1.5, 1.99, 5.0), ("2.00_or_more", None, None, None),
    ]
    warnings = ["RANGE_PARSE_FAILED: Could not parse range: 2.00 or more",
                "PERCENT_PARSE_FAILED: Could not parse percent: n/a"]
    assert good.snapshot.parser_diagnostics.messages == warnings
    assert not good.snapshot.parser_diagnostics.structural_error and good.report.candidate_valid
    assert none.snapshot.parser_diagnostics.messages == [
        "TABLE_NOT_FOUND: No programs were extracted from the candidate.",
        "PARSER_STRUCTURAL_ERROR: Structural parse failure.",
    ]
    assert flag.snapshot.parser_diagnostics.structural_error
    assert flag.snapshot.parser_diagnostics.messages[0] == "PARSER_STRUCTURAL_ERROR: m"
    assert scope.snapshot.parser_diagnostics.messages[0] == "SCOPE_AMBIGUOUS: Candidate source_id s2 did not match s1"
    assert bad.snapshot.tables == [] and bad.report.structural_error and not bad.report.candidate_valid
    assert bad.snapshot.parser_diagnostics.messages[-1] == "PARSER_STRUCTURAL_ERROR: Candidate schema validation failed."


def programs(*tables):
    doc = copy.deepcopy(GOOD)
    doc["programs"] = [
        {**GOOD["programs"][0], "program": name,
         "brackets": [{"range_text": r, "percent_text": p, "row_evidence": "r"} for r, p in brackets]}
        for name, brackets in tables
    ]
    return doc


def deltas(spark, docs):
    rows = revalidate(captures(spark, docs), "raw", shared_dir(spark, "t"), [F.col("content_type")])
    return {
        (r.captured_at, r.program, r.bracket_id): (r.prior_captured_at, r.old_value, r.new_value)
        for r in rows.collect()
    }


def test_diff_rules(spark):
    one = programs(("ground", [("1 - 2", "5%"), ("2 - 3", "6%"), ("2 - 3", "7%")]), ("air", [("1+", "1%")]))
    two = programs(("ground", [("1 - 2", "5%"), ("3 - 4", "8%"), ("9 - 10", "n/a")]))
    got = deltas(spark, [("s1", "r1", "2026-01-01", one), ("s1", "r2", "2026-01-02", two), ("s1", "r3", "2026-01-03", two)])
    assert got == {
        ("2026-01-01", "ground", "1.00_2.00"): (None, None, 5.0),
        ("2026-01-01", "ground", "2.00_3.00"): (None, None, 7.0),  # the last of an id wins
        ("2026-01-01", "air", "1.00_plus"): (None, None, 1.0),
        ("2026-01-02", "ground", "2.00_3.00"): ("2026-01-01", 7.0, None),
        ("2026-01-02", "ground", "3.00_4.00"): ("2026-01-01", None, 8.0),
        # no row for 9 - 10 (null both times), none for the removed program, none for an equal version
    }


def test_same_run_is_never_a_prior(spark):
    one, two = programs(("ground", [("1+", "1%")])), programs(("ground", [("1+", "2%")]))
    got = deltas(spark, [("s1", "r1", "2026-01-01", one), ("s1", "r1", "2026-01-02", two)])
    assert got[("2026-01-02", "ground", "1.00_plus")] == (None, None, 2.0)


def sides(spark, value=5.0, path="a"):
    rows = [("ups", "s1", "t", "ground", 0, i, f"b{i}", value + i, "2026-01-01", path) for i in range(3)]
    rows += [("ups", "s2", "t", None, 0, 0, "b0", None, None, path)]
    return spark.createDataFrame(
        rows, "carrier string, source_id string, captured_at string, program string, table_index int, "
        "bracket_index int, bracket_id string, surcharge_percent double, effective_date string, path string",
    )


def compare(a, b):
    snaps = [s.groupBy(*P.KEY).agg(F.max("effective_date").alias("effective_date"), F.max("path").alias("path")) for s in (a, b)]
    return P.compare_runs(tuple(snaps), (a, b), (a, b))


def test_parity(spark):
    a = sides(spark)
    assert compare(a, sides(spark, path="b")).count() == 0
    assert compare(a, sides(spark, 5.009)).count() == 0
    b = sides(spark, 5.5).filter("bracket_id <> 'b1'").withColumn(
        "effective_date", F.when(F.col("source_id") == "s1", "2026-02-01")
    ).union(sides(spark).filter("source_id = 's2'").withColumn("source_id", F.lit("s9")))
    b = b.filter("source_id <> 's2'")
    got = sorted((r.category, r.key, r.message, r.details and tuple(sorted(r.details.items()))) for r in compare(a, b).collect())
    assert got == sorted([
        ("MISSING_IN_LLM", "ups::s2::t", "snapshot missing in llm", None),
        ("EXTRA_IN_LLM", "ups::s9::t", "extra snapshot in llm", None),
        ("SCOPE_OR_DATE_MISMATCH", "ups::s1::t", "effective_date mismatch", (("baseline", "2026-01-01"), ("llm", "2026-02-01"))),
        ("SCOPE_OR_DATE_MISMATCH", "ups::s1::t", "bracket missing in llm: ground b1", None),
        ("BRACKET_VALUE_MISMATCH", "ups::s1::t", "surcharge_percent mismatch for ground b0", (("baseline", "5.0"), ("llm", "5.5"))),
        ("BRACKET_VALUE_MISMATCH", "ups::s1::t", "surcharge_percent mismatch for ground b2", (("baseline", "7.0"), ("llm", "7.5"))),
    ])


def test_applying_the_deltas_to_the_prior_gives_the_current(spark):
    one = programs(("ground", [(f"{i} - {i + 1}", f"{i}%") for i in range(6)]))
    two = programs(("ground", [(f"{i} - {i + 1}", f"{i * (i % 2 + 1)}%") for i in range(2, 9)]))
    got = deltas(spark, [("s1", "r1", "2026-01-01", one), ("s1", "r2", "2026-01-02", two)])
    state = {}
    for (_, _, bracket), (_, _, new) in sorted(got.items()):
        state[bracket] = new
    state = {b: v for b, v in state.items() if v is not None}
    assert state == {f"{i}.00_{i + 1}.00": float(i * (i % 2 + 1)) for i in range(2, 9)}


def test_discovery(spark):
    links = [
        {"href": "/t/a.pdf", "link_text": None, "effective_date": "1/8/2026", "evidence_snippet": "e1"},
        {"href": "https://h/b.pdf?v=1", "link_text": None, "effective_date": None, "evidence_snippet": "e2"},
    ]
    rows = captures(spark, [("s1", "r", "1", change(["links"], links)), ("s1", "r", "2", GOOD), ("s1", "r", "3", "{")])
    rows = rows.select("*", F.lit("c1").alias("child_source_id"), F.lit("https://x.org/p/q").alias("base_url"), F.lit(True).alias("pdf_only"))
    a, b, c = [r.discovered for r in discover(rows, "raw").orderBy("captured_at").collect()]
    assert [(x.url, x.effective_date, x.context_excerpt, x.child_source_id) for x in a.artifacts] == [
        ("https://x.org/t/a.pdf", "2026-01-08", "e1", "c1")
    ]
    assert not a.parser_diagnostics.structural_error
    assert b.parser_diagnostics.messages == ["LINKS_NOT_FOUND: No discoverable artifacts were found."]
    assert b.parser_diagnostics.structural_error and c.parser_diagnostics.structural_error


def test_flat_diff_of_a_table_with_itself_is_empty(spark):
    snaps = normalize(captures(spark, [("s1", "r1", "2026-01-01", GOOD), ("s1", "r2", "2026-01-02", GOOD)]), "raw")
    snaps = snaps.select(*ID, "snapshot")
    pairs = snapshot_pairs(snaps).withColumn("structural_error", F.lit(False))
    tables = flatten_tables(snaps)
    brackets = flatten_brackets(tables).drop("effective_date", "program").join(
        tables.select(*ID, "table_index", "program"), [*ID, "table_index"]
    )
    out = snapshot_diff(pairs, tables.select(*ID, "program", "table_index", "effective_date"), brackets.select(
        *ID, "program", "table_index", "bracket_index", "bracket_id", "index_range", "surcharge_percent"))
    assert out.filter("captured_at = '2026-01-02'").count() == 0
    assert out.filter("captured_at = '2026-01-01'").count() == 1


@pytest.mark.parametrize("raw", ["null", "7", '"x"'])
def test_gate_refuses_scalars(spark, raw):
    assert len(run_gate(spark, [raw])[0]) == 1
