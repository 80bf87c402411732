import json
import os
import re

import pytest
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.sources import readers as R
from ratelake.sources import writers as W

REGISTRY = {"version": "1.0", "sources": [
    {"id": "a", "carrier": "ups", "mode": "DISCOVERY", "url": "https://h/x", "parser_id": "p", "artifact_type": "html",
     "diff_enabled": False, "child_source_id": "b"},
    {"id": "b", "carrier": "ups", "mode": "DIRECT", "url": None, "parser_id": "p", "artifact_type": "pdf",
     "diff_enabled": True, "discovered_only": True},
]}


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb" if isinstance(text, bytes) else "w") as f:
        f.write(text if isinstance(text, (str, bytes)) else json.dumps(text, indent=1))


def snapshot(carrier, at, date):
    return {"schema_version": "1.0", "carrier": carrier, "source_id": "s", "captured_at": at, "source_url": "u",
            "content_type": "text/html", "effective_date": date, "tables": [],
            "parser_diagnostics": {"structural_error": False, "messages": []}}


def test_registry(spark, tmp_path):
    put(f"{tmp_path}/ok.json", REGISTRY)
    rows = R.read_registry(spark, f"{tmp_path}/ok.json").orderBy("id").collect()
    assert [(r.id, r.child_source_id, r.discovered_only) for r in rows] == [("a", "b", None), ("b", None, True)]
    bad = json.loads(json.dumps(REGISTRY))
    bad["sources"][1]["mode"] = "OTHER"
    bad["sources"][0]["url"] = "nope"
    put(f"{tmp_path}/bad.json", bad)
    with pytest.raises(Exception, match="(?s)Registry failed schema validation: /sources/0/url Invalid url; /sources/1/mode"):
        R.read_registry(spark, f"{tmp_path}/bad.json").collect()


def test_manifest_rows(spark, tmp_path):
    child = {"source_id": "c", "url": "https://h/x.pdf", "captured_at": "soon", "snapshot_dir": "d", "parsed_path": None,
             "changes_path": None, "status": "error", "error": {"message": "m"}, "effective_date_hint": None}
    source = {"source_id": "s", "carrier": "ups", "mode": "DIRECT", "status": "success", "captured_at": None,
              "snapshot_dir": None, "parsed_path": None, "discovery_path": None, "changes_path": None, "error": None,
              "child_artifacts": [child]}
    put(f"{tmp_path}/r1/run_manifest.json", {
        "schema_version": "1.0", "run_id": "r1", "out_dir": "o", "run_dir": "d", "registry_path": "p",
        "started_at": "2026-01-01T00:00:00Z", "ended_at": "?", "sources": [source]})
    now = F.lit("2026-02-02 00:00:00").cast("timestamp")
    manifests = R.read_manifests(spark, str(tmp_path))
    run = R.manifest_runs(manifests, now).first()
    assert (str(run.started_at), str(run.ended_at)) == ("2026-01-01 00:00:00", "2026-02-02 00:00:00")
    sources = R.manifest_sources(manifests)
    assert sources.first().captured_at is None
    got = R.manifest_children(sources, now).first()
    assert (got.parent_source_id, got.source_id, str(got.captured_at)) == ("s", "c", "2026-02-02 00:00:00")


def test_snapshots_of_a_run(spark, tmp_path):
    run = f"{tmp_path}/run"
    assert R.read_run_snapshots(spark, run).count() == 0  # no such folder
    put(f"{run}/snapshots/ups/s/t1/parsed.json", snapshot("ups", "t1", "2026-01-01"))
    put(f"{run}/snapshots/ups/s/t2/parsed.json", snapshot("ups", "t1", "2026-01-02"))
    put(f"{run}/snapshots/ups/s/t2/meta.json", {"x": 1})
    rows = R.read_run_snapshots(spark, run).collect()
    assert [(r.captured_at, r.effective_date) for r in rows] == [("t1", "2026-01-02")]
    put(f"{run}/snapshots/ups/s/t3/parsed.json", {**snapshot("ups", "t3", None), "tables": None})
    with pytest.raises(Exception, match="failed schema validation"):
        R.read_run_snapshots(spark, run).collect()


def test_json_lines(spark, tmp_path):
    put(f"{tmp_path}/x.jsonl", '{"a": 1}\n\n{"a": 2}\n')
    assert R.read_json_lines(spark, str(tmp_path), "a INT", "*.jsonl").count() == 2
    put(f"{tmp_path}/y.jsonl", '{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match=r"Invalid JSONL at .*y\.jsonl:2"):
        R.read_json_lines(spark, str(tmp_path), "a INT", "*.jsonl").collect()
    loose = R.read_json_lines(spark, str(tmp_path), "a INT", "*.jsonl", strict=False)
    assert [r.a for r in loose.collect() if r._corrupt_record] == [None]
    assert R.read_json_lines(spark, f"{tmp_path}/none", "a INT").count() == 0


def test_bad_lines_of_many_blocks(spark, tmp_path):
    """Files cut into many blocks, blank lines of all kinds, lines longer than a block."""
    want, texts = [], {}
    for f in ("one", "two", "three"):
        lines, n = [], 0
        for k in range(400):
            kind = (k * 7 + len(f)) % 23
            if kind == 0:
                lines.append(["", "   ", "\t\u00a0", "\r"][k % 4])
                continue
            n += 1
            bad = kind == 1 and f != "three"
            text = '{"a": ' if bad else json.dumps({"a": k, "pad": "x" * (k % 90 + (900 if k % 50 == 3 else 0))})
            lines.append(text + ("\r" if k % 9 == 0 else ""))
            if bad:
                want.append((f, n, lines[-1]))
        texts[f] = "\n".join(lines) + ("\n" if f == "one" else "")
        put(f"{tmp_path}/feed/{f}.jsonl", texts[f])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert R.feed_lines(spark, f"{tmp_path}/feed").select("file_path", "place.block").distinct().count() > 30
        got = R.bad_json_lines(spark, f"{tmp_path}/feed", "a INT, pad STRING").collect()
        assert sorted((os.path.basename(r.file_path)[:-6], r.line, r.value) for r in got) == sorted(want)
        first = min(want)
        with pytest.raises(Exception, match=rf"Invalid JSONL at .*one\.jsonl:{first[1]}\b"):
            R.read_json_lines(spark, f"{tmp_path}/feed", "a INT").collect()
        good = R.read_json_lines(spark, f"{tmp_path}/feed/three.jsonl", "a INT, pad STRING")
        assert good.columns == ["a", "pad", "file_path"]
        assert good.count() == sum(1 for line in texts["three"].split("\n") if line.strip())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_delta_feed_names_the_bad_line(spark, tmp_path):
    put(f"{tmp_path}/run/changes/ups/s/t/fsc_delta_records.jsonl", '\n{"x": 1}\n\n{"y"\n')
    with pytest.raises(Exception, match=r"Invalid JSONL at .*fsc_delta_records\.jsonl:2"):
        R.read_run_deltas(spark, f"{tmp_path}/run").collect()


def test_path_keys_and_artifacts(spark, tmp_path):
    put(f"{tmp_path}/llm/ups/s1/2026-01-01T00:00:00Z/extraction_response.json", {"x": 1})
    put(f"{tmp_path}/llm/short/extraction_response.json", {"x": 1})
    put(f"{tmp_path}/raw/a.pdf", b"abc")
    files = R.read_text_documents(spark, str(tmp_path), "extraction_response.json")
    rows = R.with_path_keys(files, "llm").collect()
    assert [(r.carrier, r.source_id, r.captured_at) for r in rows] == [("ups", "s1", "2026-01-01T00:00:00Z")]
    pdf = R.read_binary_artifacts(spark, str(tmp_path)).first()
    assert pdf.content_hash_sha256 == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_append_absent(spark, tmp_path):
    path = f"{tmp_path}/t"
    batch = spark.createDataFrame([("a", "1", 1.0), ("a", "1", 2.0), ("b", "1", 3.0)], "s string, p string, v double")
    for _ in range(2):
        W.append_absent(batch, path, ["s", "p"], [F.col("v").desc()])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", "1", 2.0), ("b", "1", 3.0)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_append_absent_reads_touched_partitions(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    ddl = "k string, p string, q int, v int"
    first = spark.createDataFrame([("a", "x", 1, 1), ("b", "y", 2, 2), (None, "x", 1, 3)], ddl)
    second = spark.createDataFrame([("a", "x", 1, 9), ("c", "x", 1, 4), ("b", "z", 2, 5), ("n", None, 1, 6), (None, "x", 1, 7)], ddl)
    for batch in (first, second, second.filter("k is not null and p is not null")):
        W.append_absent(batch, path, ["k", "p", "q"], [F.col("v").asc()], ["p", "q"])
    want = [1, 2, 3, 4, 5, 6, 7]
    assert sorted(r.v for r in spark.read.schema(ddl).parquet(path).collect()) == want
    table = W.stored(spark, path, first)
    plan = plan_of(W.touched_rows(table, second.filter("p = 'x'"), ["p"]))
    assert re.search(r"PartitionFilters: \[[^\]]*p#\d+ = x\)", plan)
    both = plan_of(W.touched_rows(table, second.filter("p = 'z'"), ["p", "q"]))
    assert re.search(r"PartitionFilters: \[[^\]]*p#\d+ = z\).*q#\d+ = 2\)", both)
    monkeypatch.setattr(W, "LITERAL_PARTITIONS", 1)
    assert sorted(r.v for r in W.touched_rows(table, second, ["p", "q"]).collect()) == [1, 3, 4, 5, 7]


def test_publish_children(spark, tmp_path):
    keys = schemas.SNAPSHOT_KEY
    ddl = "run_id string, source_id string, captured_at string"
    parents = spark.createDataFrame([("r", "a", "1"), ("r", "b", "1")], ddl)
    rows = spark.createDataFrame([("r", "a", "1", 0), ("r", "b", "1", 0), ("r", "b", "1", 1)], ddl + ", n int")
    root = str(tmp_path)
    W.publish_children(parents, {"rows": rows}, root, keys, "0001")
    # b comes back without children; a load that never commits stays invisible.
    W.publish_children(parents.filter("source_id = 'b'"), {"rows": rows.limit(0)}, root, keys, "0002")
    rows.withColumn("n", F.lit(9)).withColumn("load_id", F.lit("0003")).write.parquet(f"{root}/rows/load=0003")
    assert sorted(map(tuple, W.current_children(spark, root, "rows", keys).collect())) == [("r", "a", "1", 0)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("ups", "s", None, 1.5)], "carrier string, source_id string, x string, v double")
    W.write_deltas(df, f"{tmp_path}/d")
    assert spark.read.json(f"{tmp_path}/d").count() == 1
    W.write_documents(df.select(F.struct("*").alias("doc")), "doc", f"{tmp_path}/j")
    assert json.loads(spark.read.text(f"{tmp_path}/j").first()[0]) == {"carrier": "ups", "source_id": "s", "x": None, "v": 1.5}
    W.write_report(spark.createDataFrame([(0, "# a"), (1, "")], "n int, line string").orderBy("n"), f"{tmp_path}/r")
    assert sorted(r[0] for r in spark.read.text(f"{tmp_path}/r").collect()) == ["", "# a"]
    W.write_parity(df.withColumn("category", F.lit("X")), f"{tmp_path}/p")
    assert os.path.isdir(f"{tmp_path}/p/category=X")
