"""JSON with repeated keys and beyond the size of a VARIANT; brackets read once."""

import json

from pyspark.sql import functions as F

from ratelake.operators.gate import gate, with_json
from ratelake.operators.normalize import normalize
from ratelake.operators.registry import parse_responses
from ratelake.session import spread


def document(**changes):
    return {"artifact_type": "html", "carrier": "UPS", "source_id": "s", "effective_date": None, "effective_date_evidence": None,
            "history_90d": None, "programs": [], **changes}


def test_last_value_of_a_repeated_key(spark):
    """Also where the session refused such objects before, and in a plan used on both sides of a join."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    rows = spark.createDataFrame([(1, '{"a": 1, "b": {"x": 1, "x": [2]}, "a": 2}'), (2, '{"a": ')], "k int, raw string")
    doc = with_json(rows, "raw", "doc").select("k", F.to_json("doc").alias("t"))
    assert {r.k: r.t for r in doc.collect()} == {1: '{"a":2,"b":{"x":[2]}}', 2: None}
    both = doc.join(doc.select("k", F.col("t").alias("u")), "k").filter("t = u").collect()
    assert [r.k for r in both] == [1]
    assert [r.error for r in parse_responses(rows, "raw").orderBy("k").collect()] == [None, "Failed to parse LLM JSON output"]


def test_gate_reads_the_last_value(spark):
    text = json.dumps(document())
    raws = [text.replace('"carrier": "UPS"', '"carrier": 7, "carrier": "UPS"'), text.replace('"carrier": "UPS"', '"carrier": "UPS", "carrier": 7'),
            '{"a":1,"a":2}', "{", None]
    rows = spark.createDataFrame(list(enumerate(raws)), "k int, raw string")
    got = {r.k: [(i.path, i.message) for i in r.issues] for r in gate(rows, "raw").collect()}
    assert got[0] == [] and got[1] == [("carrier", "Expected 'UPS' | 'FedEx', received number")]
    assert ("artifact_type", "Required") in got[2] and ("", "Invalid JSON") not in got[2]
    assert got[3] == got[4] == [("", "Invalid JSON")]


def test_gate_on_large_documents(spark):
    """Large ones are checked; of one that the parser refuses, the issue tells its size."""
    def text(*sizes):
        fields = [F.concat(F.lit(f'"f{i}":"'), F.repeat(F.lit("x"), n), F.lit('"')) for i, n in enumerate(sizes)]
        return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))

    mb = 1 << 20
    raw = F.when(F.col("id") == 0, text(17 * mb, 17 * mb)).when(F.col("id") == 1, text(22 * mb)).otherwise(F.repeat(F.lit("{"), 5))
    rows = spark.range(3).select("id", raw.alias("raw"))
    got = {r.id: r.m for r in gate(rows, "raw").select("id", F.col("issues")[0]["message"].alias("m")).collect()}
    assert got == {0: "Required", 1: f"Document of {22 * mb + 9} bytes is not JSON or too large to check", 2: "Invalid JSON"}


def test_normalised_brackets_and_warnings(spark):
    bracket = lambda r, p: {"range_text": r, "percent_text": p, "row_evidence": "e"}
    program = {"program": "ground", "table_title": None, "table_title_evidence": None, "basis_hint": None, "table_evidence": None,
               "brackets": [bracket("$1.00 - $2.00", "5%"), bracket("odd", "n/a"), bracket("3+", "x")]}
    raw = json.dumps(document(programs=[program, {**program, "brackets": []}], effective_date="1/2/2026"))
    rows = spark.createDataFrame([("ups", "s", "2026-01-01", "u", "text/html", raw)],
                                 "carrier string, source_id string, captured_at string, source_url string, content_type string, raw string")
    r = normalize(rows, "raw").first()
    assert [(b.bracket_id, b.min_index, b.surcharge_percent) for b in r.snapshot.tables[0].brackets] == [
        ("1.00_2.00", 1.0, 5.0), ("odd", None, None), ("3.00_plus", 3.0, None)]
    assert r.snapshot.effective_date == "2026-01-02" and r.snapshot.tables[1].brackets == []
    assert [w.message for w in r.report.normalization_warnings] == [
        "Could not parse range: odd", "Could not parse percent: n/a", "Could not parse percent: x"]


def test_spread(spark):
    rows = spark.range(100).coalesce(1)
    assert spread(rows, 3).rdd.getNumPartitions() == 3 and spread(rows, 1) is rows
