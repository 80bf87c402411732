"""A run folder checked again, in the layout of named files."""

import json
import os

import pytest

from ratelake import schemas
from ratelake.operators.revalidate import revalidate_run_folder, write_revalidated
from ratelake.sources import readers as R


def put(path, document):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(document if isinstance(document, str) else json.dumps(document, indent=2))


def candidate(source, percent="5.00%", date="January 5, 2026"):
    return {"artifact_type": "html", "carrier": "UPS", "source_id": source, "effective_date": date, "effective_date_evidence": None,
            "programs": [{"program": "ground", "table_title": None, "table_title_evidence": None, "basis_hint": None, "table_evidence": None,
                          "brackets": [{"range_text": "$1.00 - $2.00", "percent_text": percent, "row_evidence": "r"}]}],
            "links": [], "history_90d": None, "parse_warnings": []}


def stored(source, at, percent):
    return {"schema_version": "1.0", "carrier": "ups", "source_id": source, "captured_at": at, "source_url": "u", "content_type": "text/html",
            "effective_date": "2026-01-01", "tables": [{"program": "ground", "effective_date": "2026-01-01", "brackets": [
                {"bracket_id": "1.00_2.00", "index_range": "x", "min_index": 1.0, "max_index": 2.0, "surcharge_percent": percent,
                 "surcharge_text": "t"}]}], "parser_diagnostics": {"structural_error": False, "messages": []}}


@pytest.fixture
def registry(spark):
    rows = [
        ("diffed", "https://h/diffed", True), ("plain", "https://h/plain", False), ("no_url", None, True), ("no_meta", "https://h/m", True),
        ("first", "https://h/f", True),
    ]
    return spark.createDataFrame(
        [(i, "ups", "DIRECT", u, "p", "pdf" if i == "plain" else "html", d) for i, u, d in rows],
        "id string, carrier string, mode string, url string, parser_id string, artifact_type string, diff_enabled boolean",
    )


@pytest.fixture
def out(tmp_path):
    def response(source, at, text, url=""):
        put(f"{tmp_path}/r2/llm/ups/{source}/{at}/extraction_response.json", text)
        if source != "no_meta":
            put(f"{tmp_path}/r2/snapshots/ups/{source}/{at}/meta.json", {"final_url": url, "status_code": 200})

    response("diffed", "2026-02-01T00:00:00Z", candidate("diffed", "7.00%"), "https://final/1")
    response("diffed", "2026-02-02T00:00:00Z", '{"not": ')
    response("plain", "2026-02-01T00:00:00Z", candidate("plain"))
    response("no_url", "2026-02-01T00:00:00Z", candidate("no_url"))
    response("no_meta", "2026-02-01T00:00:00Z", candidate("no_meta"))
    response("nobody", "2026-02-01T00:00:00Z", candidate("nobody"))
    response("first", "2026-02-01T00:00:00Z", candidate("first"))
    put(f"{tmp_path}/r2/llm/short/extraction_response.json", candidate("x"))
    # Earlier, later and own snapshots of the diffed source.
    put(f"{tmp_path}/r0/snapshots/ups/diffed/a/parsed.json", stored("diffed", "2026-01-01T00:00:00Z", 5.0))
    put(f"{tmp_path}/r1/snapshots/ups/diffed/a/parsed.json", stored("diffed", "2026-01-20T02:00:00+02:00", 6.0))
    put(f"{tmp_path}/r1/snapshots/ups/diffed/b/parsed.json", stored("diffed", "2026-03-01T00:00:00Z", 9.0))
    put(f"{tmp_path}/r1/snapshots/ups/diffed/c/parsed.json", stored("diffed", "never", 8.0))
    put(f"{tmp_path}/r2/snapshots/ups/diffed/z/parsed.json", stored("diffed", "2026-01-30T00:00:00Z", 1.0))
    put(f"{tmp_path}/r1/snapshots/ups/plain/a/parsed.json", stored("plain", "2026-01-01T00:00:00Z", 4.0))
    return str(tmp_path)


def test_run_folder(spark, registry, out):
    result = revalidate_run_folder(spark, f"{out}/r2", out, registry)
    assert sorted((r.source_id, r.error) for r in result.errors.collect()) == [
        ("no_meta", "Missing capture metadata for no_meta at 2026-02-01T00:00:00Z"),
        ("no_url", "Missing source URL for no_url at 2026-02-01T00:00:00Z"),
        ("nobody", "Source nobody not found in registry"),
    ]
    rows = {(r.source_id, r.captured_at[:10]): r for r in result.snapshots.collect()}
    assert sorted(rows) == [("diffed", "2026-02-01"), ("diffed", "2026-02-02"), ("first", "2026-02-01"), ("plain", "2026-02-01")]
    assert rows["diffed", "2026-02-01"].snapshot.source_url == "https://final/1"
    assert rows["plain", "2026-02-01"].snapshot.source_url == "https://h/plain"
    assert rows["plain", "2026-02-01"].snapshot.content_type == "application/pdf"
    assert not rows["diffed", "2026-02-02"].report.candidate_valid
    got = sorted((r.source_id, r.captured_at[:10], r.prior_captured_at, r.old_value, r.new_value) for r in result.deltas.collect())
    # The broken one has no programs, so it gives no records; a source that is not diffed neither.
    assert got == [("diffed", "2026-02-01", "2026-01-20T02:00:00+02:00", 6.0, 7.0), ("first", "2026-02-01", None, None, 5.0)]


def test_written_and_read_again(spark, registry, out):
    result = revalidate_run_folder(spark, f"{out}/r2", out, registry)
    write_revalidated(result, f"{out}/new/r2")
    docs = R.read_artifacts(spark, f"{out}/new/r2", "snapshots", "parsed.json")
    keyed = R.with_path_keys(docs, "snapshots").collect()
    assert sorted((r.source_id, r.captured_at) for r in keyed) == sorted((r.source_id, r.captured_at) for r in result.snapshots.collect())
    assert all(json.loads(r.value)["source_id"] == r.source_id for r in keyed)
    assert R.read_run_deltas(spark, f"{out}/new/r2").count() == 2
    reports = R.read_artifacts(spark, f"{out}/new/r2", "llm", "validation_report.json")
    assert reports.count() == 4 and json.loads(reports.first().value)["schema_version"] == "1.0"


def test_no_folders(spark, registry, tmp_path):
    result = revalidate_run_folder(spark, f"{tmp_path}/none", str(tmp_path), registry)
    assert result.errors.count() == result.snapshots.count() == result.deltas.count() == 0
    assert schemas.SNAPSHOT_KEY == ["run_id", "source_id", "captured_at"]
