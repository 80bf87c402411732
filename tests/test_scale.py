"""What must not grow faster than the input, on rows made here."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from ratelake.sources.readers import read_artifacts
from ratelake.sources.writers import write_artifacts


def _captures(spark, n):
    rows = spark.range(0, n, 1, 1).select(
        F.lit("ups").alias("carrier"), F.lit("s").alias("source_id"), F.concat(F.lit("d"), "id").alias("captured_at"),
        F.lit("a.json").alias("file"), F.concat(F.lit("v"), "id").alias("text"),
    )
    return rows.unionByName(rows).coalesce(1)


def test_artifacts_are_written_by_many_tasks_and_one_file_per_folder(spark, tmp_path):
    write_artifacts(_captures(spark, 40), "text", f"{tmp_path}/run/llm")
    files = glob.glob(f"{tmp_path}/run/llm/**/part-*", recursive=True)
    assert len(files) == 40
    assert len({re.search(r"part-(\d+)", f)[1] for f in files}) > 4


def test_artifacts_are_listed_by_a_task_per_core(spark, tmp_path):
    write_artifacts(_captures(spark, 80), "text", f"{tmp_path}/run/llm")
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    try:
        found = read_artifacts(spark, f"{tmp_path}/run", "llm", "a.json")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= sc.defaultParallelism
    assert found.groupBy("value").count().filter("count = 2").count() == 80


ODD = ["7", "-1.5", "1e999", "true", "null", '"true"', '"7"', '"-1.5"', '"NaN"', '""', '"{}"', "{}", "[]", '"2024-01-01"', '"x"', '"https://a.b/c"']


def test_documents_cleared_by_their_types_have_no_issue(spark):
    import json

    from ratelake.operators.gate import CANDIDATE_RULES, DELTA_RULES, issues, quick_issues, with_json

    whole = {
        "artifact_type": "html", "carrier": "UPS", "source_id": "s", "effective_date": None, "effective_date_evidence": "seen",
        "programs": [{
            "program": "ground_domestic", "table_title": None, "table_title_evidence": None, "basis_hint": None, "table_evidence": None,
            "brackets": [{"range_text": "$1 - $2", "percent_text": "5%", "row_evidence": "r"}],
        }],
        "links": [{"href": "https://example.com/a", "link_text": None, "effective_date": None, "evidence_snippet": "e"}],
        "history_90d": {"rows": [{"week_of": "2024-01-01", "ground_percent_text": None, "air_percent_text": "1%", "row_evidence": "r"}]},
        "parse_warnings": [{"code": "X", "message": "m", "severity": "info"}],
    }
    delta = {n: "x" for n in DELTA_RULES.fields} | {
        "schema_version": "1.0", "old_value": 1.5, "new_value": None, "parser_structural_error": False,
        "publishability": {"is_publishable": True, "reasons": []},
    }

    def places(x, at=()):
        yield at
        for k, v in x.items() if isinstance(x, dict) else enumerate(x) if isinstance(x, list) else ():
            yield from places(v, (*at, k))

    def changed(doc, at, value):
        if not at:
            return value
        copy = json.loads(json.dumps(doc))
        node = copy
        for k in at[:-1]:
            node = node[k]
        if value is None:
            del node[at[-1]]
        else:
            node[at[-1]] = "@@"
        return json.dumps(copy).replace('"@@"', value or "")

    for doc, rules in ((whole, CANDIDATE_RULES), (delta, DELTA_RULES)):
        texts = [json.dumps(doc)] + [changed(doc, p, v) for p in places(doc) for v in [*ODD, None] if p or v]
        texts += [changed(doc, p, json.dumps("x" * n)) for p in places(doc) for n in (3, 4, 32, 33, 201, 301) if p]
        rows = with_json(spark.createDataFrame([(t,) for t in texts], "raw string"), "raw", "doc").filter("doc is not null")
        doc_column, root = F.col("doc"), F.lit("")
        both = rows.select("raw", issues(doc_column, rules, root).alias("a"), quick_issues(doc_column, rules).alias("b"))
        assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).take(1) == []
        assert both.filter(F.size("b") > 0).count() > len(texts) / 3


def test_tasks_of_candidates_grow_with_the_orders(spark, tmp_path, monkeypatch):
    from ratelake.plans import model

    monkeypatch.setattr(model, "TASK_DOCUMENTS", 100)
    day = F.lit("2024-01-01").cast("timestamp").alias("o_orderdate")
    spark.range(0, 2000, 1, 1).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), day).write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    rows = model.candidate_rows(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 20
    assert rows.count() == 2000


def test_overlapping_brackets_are_not_met_one_by_one(spark):
    import random

    from ratelake.operators.ranges import range_lookup

    pick, inf = random.Random(5), float("inf")
    brackets = [("t", -1.0, 2000.0 + k, 900 + k) for k in range(50)] + [("t", 3.0, 3.0, 2), ("t", 8.0, 7.0, 1), ("t", 1e16, inf, 0), ("u", None, -5.0, 3)]
    for k in range(300):
        low = pick.randrange(0, 4000) / 4
        brackets.append(("t", low, low + pick.choice([0.0, 0.25, 0.5, 1.0, 3.75, 64.0]), 1000 - k))
    values = [("t", x / 8) for x in range(-16, 8100, 3)] + [("t", 3.0), ("t", 2e16), ("t", inf), ("t", float("nan")), ("u", -7.0), ("u", 1.0)]
    facts = spark.createDataFrame(values, "k string, v double")
    found = range_lookup(facts, spark.createDataFrame(brackets, "k string, low double, high double, pos int"), ["k"], "v", "low", "high", "pos")
    rows = {(r["k"], r["v"]): r["pos"] for r in found.collect()}
    wanted = {}
    for k, v in values:
        hits = [p for t, a, b, p in brackets if t == k and (a is None or v >= a) and (b is None or v < b + 1e-9)]
        if hits and v == v:
            wanted[k, v] = min(hits)
    assert rows == wanted
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "_bin" in line and "<" in line]


def test_artifacts_leave_the_folders_and_texts_of_a_partitioned_write(spark, tmp_path):
    from ratelake.sources.writers import ARTIFACT_KEYS

    odd = ["a b", "a/b", "a=b%", "é:+?", "", None, "q\"'#*\\[]{}^~&", "tab\there"]
    rows = spark.createDataFrame(
        [("ups", x, f"d{k % 2}", "a.json", f"xé{k}{j}" if k != 3 else None) for k, x in enumerate(odd) for j in range(2)],
        [*ARTIFACT_KEYS, "text"],
    )
    write_artifacts(rows, "text", f"{tmp_path}/a")
    rows.repartition(3, *ARTIFACT_KEYS).select(*ARTIFACT_KEYS, F.col("text").alias("value")).write.partitionBy(*ARTIFACT_KEYS).text(f"{tmp_path}/b")

    def texts(root):
        found = {}
        for path in glob.glob(f"{root}/**/part-*", recursive=True):
            with open(path, newline="") as f:
                found.setdefault(path[len(root):].rsplit("/", 1)[0], []).extend(f.readlines())
        return {folder: sorted(lines) for folder, lines in found.items()}

    assert texts(f"{tmp_path}/a") == texts(f"{tmp_path}/b")
    write_artifacts(rows, "text", f"{tmp_path}/a")
    assert {folder: len(lines) for folder, lines in texts(f"{tmp_path}/a").items()} == {folder: 4 if folder else 0 for folder in texts(f"{tmp_path}/b")}
    assert not glob.glob(f"{tmp_path}/a/_temporary*")
    # The mode of a file is not set by a process of its own, nor is there a file of checksums.
    assert not glob.glob(f"{tmp_path}/a/**/.*.crc", recursive=True, include_hidden=True)


def test_artifacts_of_a_failed_write_are_not_left_in_part(spark, tmp_path):
    import pytest

    broken = F.when(F.col("captured_at") == "d7", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("text"))
    with pytest.raises(Exception, match="lost"):
        write_artifacts(_captures(spark, 40).withColumn("text", broken), "text", f"{tmp_path}/run/llm")
    assert not glob.glob(f"{tmp_path}/run/llm/**/part-*", recursive=True)


def test_compressed_feeds_and_documents_are_read_alike(spark, tmp_path):
    from ratelake.operators.folders import run_tables
    from ratelake.sources.writers import write_deltas, write_documents

    document = F.struct(
        F.lit("1.0").alias("schema_version"), F.lit("ups").alias("carrier"), F.lit("s").alias("source_id"),
        F.col("id").cast("string").alias("captured_at"), F.lit("u").alias("source_url"), F.lit("c").alias("content_type"),
        F.lit(None).cast("string").alias("effective_date"), F.array().cast(
            "array<struct<program:string,effective_date:string,brackets:array<struct<bracket_id:string,index_range:string,"
            "min_index:double,max_index:double,surcharge_percent:double,surcharge_text:string>>>>").alias("tables"),
        F.struct(F.lit(False).alias("structural_error"), F.array().cast("array<string>").alias("messages")).alias("parser_diagnostics"),
    )
    delta = spark.range(0, 500, 1, 2).select(
        F.lit("1.0").alias("schema_version"), F.lit("ups").alias("carrier"), F.lit("s").alias("source_id"),
        F.col("id").cast("string").alias("captured_at"), F.lit(None).cast("string").alias("prior_captured_at"),
        F.lit(None).cast("string").alias("program"), F.lit(None).cast("string").alias("effective_date"), F.lit("b").alias("bracket_id"),
        F.lit("r").alias("index_range"), F.lit(1.0).alias("old_value"), F.lit(2.0).alias("new_value"), F.lit("g").alias("group_key"),
        F.struct(F.lit(True).alias("is_publishable"), F.array().cast("array<string>").alias("reasons")).alias("publishability"),
        F.lit(False).alias("parser_structural_error"),
    )
    seen = []
    for how in ("none", "gzip"):
        write_documents(spark.range(500).select(document.alias("d")), "d", f"{tmp_path}/{how}/snapshots", compression=how)
        write_deltas(delta, f"{tmp_path}/{how}/changes", how)
        snapshots, _, _, deltas = run_tables(spark, f"{tmp_path}/{how}")
        at = deltas.orderBy("position").select("captured_at").collect()
        seen.append((sorted(r["captured_at"] for r in snapshots.collect()), [r[0] for r in at]))
    assert seen[0] == seen[1] and len(seen[0][0]) == len(seen[0][1]) == 500
    size = {how: sum(len(open(f, "rb").read()) for f in glob.glob(f"{tmp_path}/{how}/*/part-*")) for how in ("none", "gzip")}
    assert size["gzip"] * 10 < size["none"]


def test_numbers_of_range_texts_are_cast_only_where_something_matched(spark):
    import math

    from ratelake.functions.brackets import parse_percent_text, parse_range_text

    texts = {
        "$1.50 - $2": (1.5, 2.0, "1.50_2.00", True), "5+": (5.0, None, "5.00_plus", True), ">= 7.25": (7.25, None, "7.25_plus", True),
        "less than $3": (None, 3.0, "lt_3.00", True), "n/a": (None, None, "n/a", False), "": (None, None, "unknown_range", False),
        None: (None, None, None, False), "1 - x, 4 and above": (4.0, None, "4.00_plus", True),
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = rows.select("t", parse_range_text(F.col("t")).alias("r"))
    assert {r["t"]: tuple(r["r"]) for r in parsed.collect()} == texts
    percent = rows.sparkSession.createDataFrame([("5%",), ("n/a",), ("-1,0.5 %",), ("1e999",), ("",), (None,)], "t string")
    found = {r[0]: r[1] for r in percent.select("t", parse_percent_text(F.col("t"))).collect()}
    assert found == {"5%": 5.0, "n/a": None, "-1,0.5 %": -10.5, "1e999": math.inf, "": None, None: None}
    # An empty text is never cast: that gives no number either, but throws inside for every row.
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(regexp_extract" not in plan


def test_workers_need_no_package_to_write_artifacts(tmp_path):
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    from ratelake.sources.writers import _moved_rows, _staged_rows

    code = "import pickle, sys; [f for f in pickle.loads(sys.stdin.buffer.read())]"
    sent = cloudpickle.dumps([_staged_rows("stage", "job"), _moved_rows("stage", "path")])
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], input=sent, cwd=tmp_path, env=clean, check=True)


def test_snapshots_of_a_run_are_merged_by_hash(spark):
    """Equal rows are merged without a sort before the largest texts of a key are looked for."""
    from ratelake.plans.model import side_snapshots

    side = spark.createDataFrame(
        [("u", "s", "t", None, "p1"), ("u", "s", "t", "d", "p0"), ("u", "s", "t", "d", "p0"), ("u", None, "t", None, "p")],
        "carrier string, source_id string, captured_at string, effective_date string, path string",
    )
    found = side_snapshots(side)
    assert sorted(map(str, found.collect())) == sorted(map(str, side.groupBy("carrier", "source_id", "captured_at").agg(
        F.max("effective_date").alias("effective_date"), F.max("path").alias("path")).collect()))
    physical = found._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in physical.splitlines()[-2]


def _feed_run(folder, feeds):
    import json
    import os

    snapshot = {"schema_version": "1.0", "carrier": "ups", "source_id": "s", "captured_at": "t", "source_url": "u", "content_type": "c",
                "effective_date": None, "tables": [{"program": "p", "effective_date": None, "brackets": [
                    {"bracket_id": "b", "index_range": "r", "min_index": None, "max_index": None, "surcharge_percent": v, "surcharge_text": ""}
                    for v in (1, len(feeds))]}], "parser_diagnostics": {"structural_error": False, "messages": []}}
    os.makedirs(f"{folder}/snapshots/ups/s/t")
    with open(f"{folder}/snapshots/ups/s/t/parsed.json", "w") as f:
        json.dump(snapshot, f)
    for name, lines in feeds.items():
        os.makedirs(f"{folder}/changes/{name}")
        with open(f"{folder}/changes/{name}/fsc_delta_records.jsonl", "w") as f:
            f.write("\n".join(lines))


def _delta(bracket, old, new):
    return ('{"schema_version":"1.0","carrier":"ups","source_id":"s","captured_at":"t","prior_captured_at":null,"program":null,'
            f'"effective_date":null,"bracket_id":"x","bracket_id":"{bracket}","index_range":"r","old_value":{old},"new_value":{new},'
            '"group_key":"g","publishability":{"is_publishable":true,"reasons":[]},"parser_structural_error":false}')


def test_feeds_of_run_folders_are_checked_once_and_merged_by_hash(spark, tmp_path):
    from ratelake.operators.folders import _stored_feed, compare_run_folders

    pad = [_delta("c", 1, k) for k in range(300)]
    _feed_run(f"{tmp_path}/a", {"1": [_delta("b", 1, 9), "", *pad], "2": [_delta("b", -0.0, 2), "", _delta("b", "null", 2)]})
    _feed_run(f"{tmp_path}/b", {"1": [*pad, _delta("c", 1, 5)], "2": [], "3": [_delta("b", 1, 9), _delta("b", -0.0, 2.5)]})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")  # a feed is read in many blocks
    try:
        found = compare_run_folders(spark, f"{tmp_path}/a", f"{tmp_path}/b")
        rows = sorted((r["message"], r["details"] and (r["details"]["baseline"], r["details"]["llm"])) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == [
        ("new_value mismatch for b", ("2.0", "2.5")), ("new_value mismatch for c", ("299.0", "5.0")), ("old_value mismatch for b", (None, "-0.0")),
        ("surcharge_percent mismatch for p b", ("2.0", "3.0")),
    ]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "FileScan text" not in plan and "SortAggregate" not in plan
    with open(f"{tmp_path}/b/changes/3/fsc_delta_records.jsonl", "a") as f:
        f.write('\n\n{"x"\n')
    with pytest.raises(Exception, match=r"Invalid JSONL at .*/3/fsc_delta_records\.jsonl:3"):
        _stored_feed(spark, f"{tmp_path}/b", True)


def test_numbers_of_checked_records_are_those_of_the_text(spark, tmp_path):
    from ratelake.sources.readers import read_run_deltas

    numbers = ["0", "-0", "0.0", "-0.0", "-0e5", "1e-400", "-1e-400", "1e400", "0.1", "123456789012345678901234567890123456789012.5", "1.7976931348623157e308",
               "2.5E-3", "9007199254740993", "12345678901234567890.123456789012345678", "null"]
    _feed_run(f"{tmp_path}/a", {"1": [_delta(f"b{k}", n, n) for k, n in enumerate(numbers)]})
    strict, loose = (
        sorted(str(r) for r in read_run_deltas(spark, f"{tmp_path}/a", s).drop("position").collect()) for s in (True, False)
    )
    assert strict == loose and len(strict) == len(numbers)


def test_artifacts_are_read_by_tasks_as_by_the_index(spark, tmp_path, monkeypatch):
    """Odd folder names, hidden and empty files, all ends of lines; no state of a file in the plan."""
    import gzip
    import os

    from ratelake.sources import readers as R

    names = ["a b", "é +%", "x=1,y;z", "q'(1)*~!$&@:", 'b#[c]{d}|^`<>"', "n b　 ", "日本", "\x7f\x85t", "_=k", "_hid", ".dot",
             "c._COPYING_", "_metadata", "back\\slash"]
    whole = [b'{"x":\n1}\n', b"", b"\xef\xbb\xbfabc", b"  \n", b"\xff\xfe bad"]
    parts = [b"a\rb\n\n  \nc\r\nd", b"", b"\xef\xbb\xbfabc\n\t\n", b"\xc2\x85x\x0b y\x0c z\n", b"\xff\n"]
    for run in ("r1", "r 2"):
        for k, n in enumerate(names):
            folder = f"{tmp_path}/out/{run}/llm/{n}/s/t{k}"
            os.makedirs(f"{folder}/file=a.json")
            for name, data in (("a.json", whole[k % 5]), ("file=a.json/part-0.txt", parts[k % 5]), ("file=a.json/a.json", b"inner"),
                               ("part-1", b"no"), ("b.json", b"no"), ("file=a.json/part-2.txt", b"x" * (k * 100))):
                with open(f"{folder}/{name}", "wb") as f:
                    f.write(data)
    os.symlink(f"{tmp_path}/none", f"{tmp_path}/out/r1/llm/a b/broken")

    def rows(df):
        return sorted(map(tuple, df.select(F.hex("value"), "file_path").collect()))

    def compared(run):
        found = read_artifacts(spark, f"{tmp_path}/out/{run}", "llm", "a.json")
        assert rows(found) == rows(R._indexed_artifacts(spark, f"{tmp_path}/out/{run}/llm", "a.json"))
        return found

    monkeypatch.setattr(R, "_READ_BYTES", 500)
    for run in ("r1", "*", "none", "none*"):
        found = compared(run)
        assert "FileScan text" not in found._jdf.queryExecution().sparkPlan().toString()
    monkeypatch.setattr(R, "LISTED", 2)  # folders of more entries are walked by one task
    found = compared("*")
    # Texts are never taken for as small as their paths, and broadcast.
    assert int(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > 1 << 40
    with gzip.open(f"{tmp_path}/out/r1/llm/a b/s/t0/file=a.json/part-3.txt.gz", "wb") as f:
        f.write(b"packed\n")
    assert ("7061636B6564", ) in [r[:1] for r in rows(compared("r1"))]


def test_workers_need_no_package_to_read_artifacts(tmp_path):
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    from ratelake.sources.readers import _texts, _walked

    os.makedirs(f"{tmp_path}/f/g")
    with open(f"{tmp_path}/f/g/a.json", "w") as f:
        f.write("x")
    code = (
        "import pickle, sys, pyarrow as pa; walk, read = pickle.loads(sys.stdin.buffer.read()); found = [*walk(['f'])]; "
        "cols = [pa.array(c) for c in zip(*found)]; batch = pa.RecordBatch.from_arrays(cols, ['path', 'file_path', 'whole']); "
        "assert next(read(iter([batch]))).column(0).to_pylist() == [b'x'], found"
    )
    sent = cloudpickle.dumps([_walked("a.json"), _texts()])
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], input=sent, cwd=tmp_path, env=clean, check=True)
