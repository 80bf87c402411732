"""Whole runs loaded under one commit: manifests, retries, replaced children, compaction."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.operators.persist import compact_runs, persist_runs, read_run_table, run_tables
from ratelake.sources import loads
from ratelake.sources import readers as R
from ratelake.sources.manifests import manifest_texts, write_manifests



def clock():
    return F.lit("2030-01-01 00:00:00").cast("timestamp")


def put(path, document):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(document if isinstance(document, str) else json.dumps(document, indent=2))


def parsed(source, at, *tables):
    return {"schema_version": "1.0", "carrier": "ups", "source_id": source, "captured_at": at, "source_url": "u",
            "content_type": "text/html", "effective_date": "2026-01-01",
            "tables": [{"program": p, "effective_date": None, "brackets": [
                {"bracket_id": b, "index_range": b, "min_index": 1.5, "max_index": None, "surcharge_percent": v,
                 "surcharge_text": str(v)} for b, v in values]} for p, values in tables],
            "parser_diagnostics": {"structural_error": False, "messages": []}}


def source(source_id, at, path=None, children=(), status="success", error=None):
    return {"source_id": source_id, "carrier": "ups", "mode": "DIRECT", "status": status, "captured_at": at,
            "snapshot_dir": None, "parsed_path": path, "discovery_path": None, "changes_path": None, "error": error,
            "child_artifacts": list(children)}


def child(source_id, url, at, path=None):
    return {"source_id": source_id, "url": url, "captured_at": at, "snapshot_dir": "d", "parsed_path": path,
            "changes_path": None, "status": "success", "error": None, "effective_date_hint": None}


def manifest(run, sources, ended="2026-01-02T00:00:00Z"):
    return {"schema_version": "1.0", "run_id": run, "out_dir": "/out", "run_dir": f"/out/{run}", "registry_path": "r.json",
            "started_at": "2026-01-01T00:00:00Z", "ended_at": ended, "sources": sources}


T1, T2 = "2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z"


def put_run(root, run="r1", rate=5.0):
    folder = f"{root}/{run}"
    put(f"{folder}/snapshots/ups/a b/t1/parsed.json", parsed("a b", T1, ("ground", [("x", rate), ("y", 6.0)]), ("air", [])))
    put(f"{folder}/snapshots/ups/c/t2/parsed.json", parsed("c", T2, ("ground", [("z", None)])))
    put(f"{folder}/run_manifest.json", manifest(run, [
        source("a b", T1, "snapshots/ups/a b/t1/parsed.json"),
        source("bad", None, None, status="error", error={"message": "m"}),
        source("hub", T1, None, [child("c", "https://h/c", T2, "./snapshots/ups/c/t2/parsed.json"), child("d", "https://h/d", "soon")]),
    ], None))
    return folder


def counts(spark, store):
    return {t: read_run_table(spark, store, t).count() for t in schemas.RUN_TABLES}


def everything(spark, store):
    return {t: sorted(str(r) for r in read_run_table(spark, store, t).collect()) for t in schemas.RUN_TABLES}


def test_one_run(spark, tmp_path):
    folder, store = put_run(tmp_path), f"{tmp_path}/store"
    assert persist_runs(spark, folder, store, "1", clock())
    assert counts(spark, store) == {
        "runs": 1, "run_sources": 3, "child_artifacts": 2, "snapshots": 2, "rate_tables": 3, "rate_brackets": 3}
    run = read_run_table(spark, store, "runs").first()
    assert (str(run.started_at), str(run.ended_at)) == ("2026-01-01 00:00:00", "2030-01-01 00:00:00")
    rows = read_run_table(spark, store, "rate_brackets").orderBy("source_id", "bracket_index").collect()
    assert [(r.source_id, r.table_index, r.bracket_id, str(r.min_index), r.max_index, r.surcharge_percent and str(r.surcharge_percent))
            for r in rows] == [("a b", 0, "x", "1.5000", None, "5.0000"), ("a b", 0, "y", "1.5000", None, "6.0000"),
                               ("c", 0, "z", "1.5000", None, None)]
    assert [r.effective_date for r in read_run_table(spark, store, "rate_tables").collect()] == [None] * 3
    assert json.loads(read_run_table(spark, store, "snapshots").filter("source_id = 'c'").first().parsed_json)["source_id"] == "c"
    late = read_run_table(spark, store, "child_artifacts").filter("source_id = 'd'").first()
    assert str(late.captured_at) == "2030-01-01 00:00:00"


def test_again_and_killed_before_the_commit(spark, tmp_path):
    folder, store = put_run(tmp_path), f"{tmp_path}/store"
    persist_runs(spark, folder, store, "1", clock())
    before = everything(spark, store)
    assert not persist_runs(spark, folder, store, "1", clock())
    assert everything(spark, store) == before
    # A load that got as far as some tables, with other rates.
    dead = run_tables(spark, put_run(f"{tmp_path}/new", rate=9.0), clock())
    for table in ("rate_brackets", "snapshots", "runs"):
        loads.write_rows(dead[table], store, table, "2")
    assert everything(spark, store) == before
    # Run again under its id, it takes effect as a whole.
    assert persist_runs(spark, f"{tmp_path}/new/r1", store, "2", clock())
    after = everything(spark, store)
    assert [t for t in after if after[t] != before[t]] == ["run_sources", "rate_brackets"]
    assert len(after["run_sources"]) == 4  # a source without a time never conflicts
    assert any("9.0000" in r for r in after["rate_brackets"]) and not any("5.0000" in r for r in after["rate_brackets"])


def test_a_parse_without_tables_clears_them(spark, tmp_path):
    store = f"{tmp_path}/store"
    persist_runs(spark, put_run(tmp_path), store, "1", clock())
    folder = put_run(f"{tmp_path}/new")
    put(f"{folder}/snapshots/ups/a b/t1/parsed.json", parsed("a b", T1))
    persist_runs(spark, folder, store, "2", clock())
    assert counts(spark, store)["rate_tables"] == 1 and counts(spark, store)["snapshots"] == 2
    kept = read_run_table(spark, store, "snapshots").filter("source_id = 'a b'").first()
    assert len(json.loads(kept.parsed_json)["tables"]) == 2  # the snapshot stays as it came first


def test_one_key_twice_in_a_run(spark, tmp_path):
    """The first capture gives the snapshot, the last one the tables."""
    folder, store = f"{tmp_path}/r", f"{tmp_path}/store"
    put(f"{folder}/snapshots/ups/s/one/parsed.json", {**parsed("s", T1, ("ground", [("x", 1.0)])), "source_url": "first"})
    put(f"{folder}/snapshots/ups/s/two/parsed.json", parsed("s", T1, ("air", [("y", 2.0)]), ("sea", [])))
    put(f"{folder}/run_manifest.json", manifest("r", [
        source("s", T1, "snapshots/ups/s/one/parsed.json"),
        source("s", "2026-01-01T01:00:00+01:00", "snapshots/ups/s/two/parsed.json"),
    ]))
    persist_runs(spark, folder, store, "1", clock())
    assert counts(spark, store) == {
        "runs": 1, "run_sources": 1, "child_artifacts": 0, "snapshots": 1, "rate_tables": 2, "rate_brackets": 1}
    assert read_run_table(spark, store, "snapshots").first().source_url == "first"
    assert {r.program for r in read_run_table(spark, store, "rate_tables").collect()} == {"air", "sea"}


@pytest.mark.parametrize("path,text,at,message", [
    ("snapshots/none/parsed.json", None, T1, "No snapshot document at"),
    ("snapshots/ups/s/t/parsed.json", '{"tables": [', T1, "No snapshot document at"),
    ("snapshots/ups/s/t/parsed.json", parsed("s", T1), "soon", "Invalid captured_at for snapshot s: soon"),
])
def test_a_bad_capture_fails_the_whole_load(spark, tmp_path, path, text, at, message):
    folder, store = f"{tmp_path}/r", f"{tmp_path}/store"
    if text is not None:
        put(f"{folder}/{path}", text)
    put(f"{folder}/run_manifest.json", manifest("r", [source("s", at, path)]))
    with pytest.raises(Exception, match=message):
        persist_runs(spark, folder, store, "1", clock())
    assert sum(counts(spark, store).values()) == 0


def test_fifty_loads_compacted(spark, tmp_path):
    """Readers see the same, from fewer files, and go on loading afterwards."""
    root, keys = str(tmp_path), ["k"]
    for i in range(50):
        rows = spark.createDataFrame([(i % 20, i), (100 + i, i)], "k int, v int").coalesce(1)
        kids = spark.createDataFrame([(100 + i, i)] if i % 3 == 0 else [(i % 20, i), (100 + i, -i)], "k int, n int").coalesce(1)
        loads.write_load(spark, {"p": rows, "c": kids}, root, f"{i:04d}")

    def now():
        p = loads.loaded_rows(spark, root, "p", "k int, v int")
        c = loads.loaded_rows(spark, root, "c", "k int, n int")
        files = p.select(F.col("v"), F.input_file_name().alias("f")).select("f").distinct().count()
        return (sorted(map(tuple, loads.parents(p, keys).collect())),
                sorted(map(tuple, loads.children(c, p, keys).collect())), files)

    p0, c0, files = now()
    assert len(p0) == 70 and len(c0) < 84
    half = loads.visible_loads(spark, root)[:30]
    assert loads.compact(spark, root, "0049a", {"p": ("k int, v int", keys)}, {"c": "k int, n int"}, "p", half) == half
    assert now()[:2] == (p0, c0)
    loads.compact(spark, root, "0049b", {"p": ("k int, v int", keys)}, {"c": "k int, n int"}, "p")
    p1, c1, fewer = now()
    assert (p1, c1) == (p0, c0) and fewer < files / 4 and loads.visible_loads(spark, root) == ["0049b"]
    loads.remove_replaced(spark, root, ["p", "c"])
    assert now()[:2] == (p0, c0) and len(os.listdir(f"{root}/p")) == 1
    loads.write_load(spark, {"p": spark.createDataFrame([(0, 9)], "k int, v int"), "c": spark.createDataFrame([], "k int, n int")}, root, "0050")
    p2, c2, _ = now()
    assert [r[:2] for r in p2] == [r[:2] for r in p0] and not [r for r in c2 if r[0] == 0]
    # Names of replaced loads are never free again.
    assert not loads.write_load(spark, {"p": spark.createDataFrame([(7, 7)], "k int, v int")}, root, "0003")


def test_compacted_runs(spark, tmp_path):
    store = f"{tmp_path}/store"
    for i in range(4):
        put_run(f"{tmp_path}/{i}", "r1", float(i))
        put_run(f"{tmp_path}/{i}", f"q{i}", float(i))
        persist_runs(spark, f"{tmp_path}/{i}", store, f"{i}", clock())
    before = everything(spark, store)
    assert len(before["run_sources"]) == 2 + 4 + 4 * 3  # the null-key source of r1 four times
    assert compact_runs(spark, store, "3z") == ["0", "1", "2", "3"]
    assert everything(spark, store) == before
    assert compact_runs(spark, store, "3z") == []


def sources_frame(spark, sizes):
    rows = [(run, i, f"s{i}", "x" * 50, [(f"c{j}", f"https://h/{i}/{j}") for j in range(i % 3)]) for run, n in sizes.items() for i in range(n)]
    ddl = "run_id string, position int, source_id string, parsed_path string, child_artifacts array<struct<source_id:string,url:string>>"
    return spark.createDataFrame(rows, ddl)


def test_manifests_of_both_forms(spark, tmp_path):
    sizes = {"small": 3, "large": 60, "none": 0}
    sources = sources_frame(spark, sizes).repartition(4)
    runs = spark.createDataFrame([(r, "/o") for r in sizes], "run_id string, out_dir string")
    texts = manifest_texts(runs, sources, limit=2000)
    assert {r.run_id: r.n for r in texts.groupBy("run_id").agg(F.count("*").alias("n")).collect()} == {"small": 1, "large": 61, "none": 1}
    write_manifests(texts, str(tmp_path))
    for found in (R.read_manifests(spark, str(tmp_path)),):
        assert sorted((r.run_id, r.out_dir) for r in R.manifest_runs(found, clock()).collect()) == [(r, "/o") for r in sorted(sizes)]
        back = R.manifest_sources(found)
        assert sorted((r.run_id, r.position, r.source_id) for r in back.collect()) == sorted(
            (r.run_id, r.position, r.source_id) for r in sources.collect())
        kids = R.manifest_children(back, clock()).collect()
        assert sorted((r.run_id, r.parent_source_id, r.child_position, r.url) for r in kids) == sorted(
            (r.run_id, r.source_id, j, c.url) for r in sources.collect() for j, c in enumerate(r.child_artifacts))


def test_broken_manifest(spark, tmp_path):
    put(f"{tmp_path}/r/run_manifest.json", '{"run_id": "r", ')
    with pytest.raises(Exception, match="Invalid manifest at .*r/run_manifest.json"):
        R.read_manifests(spark, str(tmp_path)).collect()
    assert R.read_manifests(spark, f"{tmp_path}/nowhere").count() == 0
