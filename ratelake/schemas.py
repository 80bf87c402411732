"""Schemas of the documents and flat tables, as DDL."""

WARNING = "STRUCT<code STRING, message STRING, severity STRING>"
ISSUE = "STRUCT<path STRING, message STRING>"

REGISTRY = (
    "version STRING, sources ARRAY<STRUCT<id STRING, carrier STRING, mode STRING, url STRING, "
    "parser_id STRING, artifact_type STRING, diff_enabled BOOLEAN, child_source_id STRING, "
    "discovered_only BOOLEAN>>"
)

CAPTURE_META = (
    "captured_at STRING, final_url STRING, status_code INT, content_hash_sha256 STRING, "
    "viewport STRUCT<width INT, height INT>, user_agent STRING, "
    "timings STRUCT<navigation_ms BIGINT, settle_ms BIGINT, total_ms BIGINT>, "
    "discovered_from STRUCT<source_id STRING, captured_at STRING, content_hash STRING>, "
    "effective_date_hint STRING"
)

CANDIDATE = (
    "artifact_type STRING, carrier STRING, source_id STRING, effective_date STRING, "
    "effective_date_evidence STRING, "
    "programs ARRAY<STRUCT<program STRING, table_title STRING, table_title_evidence STRING, "
    "basis_hint STRING, brackets ARRAY<STRUCT<range_text STRING, percent_text STRING, "
    "row_evidence STRING>>, table_evidence STRING>>, "
    "links ARRAY<STRUCT<href STRING, link_text STRING, effective_date STRING, "
    "evidence_snippet STRING>>, "
    "history_90d STRUCT<rows ARRAY<STRUCT<week_of STRING, ground_percent_text STRING, "
    "air_percent_text STRING, row_evidence STRING>>>, "
    f"parse_warnings ARRAY<{WARNING}>"
)

BRACKET = (
    "STRUCT<bracket_id STRING, index_range STRING, min_index DOUBLE, max_index DOUBLE, "
    "surcharge_percent DOUBLE, surcharge_text STRING>"
)
TABLE = f"STRUCT<program STRING, effective_date STRING, brackets ARRAY<{BRACKET}>>"

SNAPSHOT = (
    "schema_version STRING, carrier STRING, source_id STRING, captured_at STRING, "
    "source_url STRING, content_type STRING, effective_date STRING, "
    f"tables ARRAY<{TABLE}>, "
    "parser_diagnostics STRUCT<structural_error BOOLEAN, messages ARRAY<STRING>>"
)

DELTA = (
    "schema_version STRING, carrier STRING, source_id STRING, captured_at STRING, "
    "prior_captured_at STRING, program STRING, effective_date STRING, bracket_id STRING, "
    "index_range STRING, old_value DOUBLE, new_value DOUBLE, group_key STRING, "
    "publishability STRUCT<is_publishable BOOLEAN, reasons ARRAY<STRING>>, "
    "parser_structural_error BOOLEAN"
)

REPORT = (
    f"schema_version STRING, candidate_valid BOOLEAN, errors ARRAY<{ISSUE}>, "
    f"candidate_warnings ARRAY<{WARNING}>, normalization_warnings ARRAY<{WARNING}>, "
    "structural_error BOOLEAN, table_count INT, effective_date STRING"
)

ERROR = "STRUCT<message STRING, stack STRING>"
CHILD = (
    "STRUCT<source_id STRING, url STRING, captured_at STRING, snapshot_dir STRING, "
    "parsed_path STRING, changes_path STRING, status STRING, "
    f"error {ERROR}, effective_date_hint STRING>"
)
SOURCE = (
    "STRUCT<source_id STRING, carrier STRING, mode STRING, status STRING, "
    "captured_at STRING, snapshot_dir STRING, parsed_path STRING, discovery_path STRING, "
    f"changes_path STRING, error {ERROR}, child_artifacts ARRAY<{CHILD}>>"
)
MANIFEST = (
    "schema_version STRING, run_id STRING, out_dir STRING, run_dir STRING, "
    f"registry_path STRING, started_at STRING, ended_at STRING, sources ARRAY<{SOURCE}>"
)
# A manifest held as lines: its head, then one line per source with its place.
MANIFEST_LINE = f"{MANIFEST}, position INT, source {SOURCE}"

DISCOVERED = (
    "schema_version STRING, carrier STRING, source_id STRING, captured_at STRING, "
    "artifacts ARRAY<STRUCT<url STRING, effective_date STRING, context_excerpt STRING, "
    "child_source_id STRING>>, "
    "parser_diagnostics STRUCT<structural_error BOOLEAN, messages ARRAY<STRING>>"
)

FUEL_PRICES = (
    "series_id STRING, period STRING, value DECIMAL(12,4), units STRING, description STRING, "
    "request_params STRING, captured_at TIMESTAMP"
)

APPLIED = (
    "carrier STRING, program STRING, week_ending_date STRING, table_effective_date STRING, "
    "bracket_id STRING, bracket_range STRING, applied_percent DECIMAL(8,4), "
    "fuel_price DECIMAL(12,4), fuel_index STRING, reason STRING, source_run_id STRING"
)

# The tables a run is loaded into.
RUN_TABLES = {
    "runs": (
        "run_id STRING, out_dir STRING, run_dir STRING, registry_path STRING, started_at TIMESTAMP, ended_at TIMESTAMP"
    ),
    "run_sources": (
        "run_id STRING, source_id STRING, carrier STRING, mode STRING, status STRING, captured_at TIMESTAMP, "
        f"snapshot_dir STRING, parsed_path STRING, discovery_path STRING, changes_path STRING, error {ERROR}"
    ),
    "child_artifacts": (
        "run_id STRING, parent_source_id STRING, source_id STRING, url STRING, captured_at TIMESTAMP, "
        "snapshot_dir STRING, parsed_path STRING, changes_path STRING, status STRING, "
        f"effective_date_hint STRING, error {ERROR}"
    ),
    "snapshots": (
        "run_id STRING, source_id STRING, captured_at TIMESTAMP, carrier STRING, source_url STRING, "
        "content_type STRING, effective_date STRING, "
        "parser_diagnostics STRUCT<structural_error BOOLEAN, messages ARRAY<STRING>>, parsed_json STRING"
    ),
    "rate_tables": (
        "run_id STRING, source_id STRING, captured_at TIMESTAMP, table_index INT, program STRING, "
        "effective_date STRING, bracket_count INT"
    ),
    "rate_brackets": (
        "run_id STRING, source_id STRING, captured_at TIMESTAMP, table_index INT, bracket_index INT, "
        "bracket_id STRING, index_range STRING, min_index DECIMAL(12,4), max_index DECIMAL(12,4), "
        "surcharge_percent DECIMAL(12,4), surcharge_text STRING"
    ),
}

# Unique keys of the flat tables (insert-if-absent and replace-by-key use them).
KEYS = {
    "runs": ["run_id"],
    "run_sources": ["run_id", "source_id", "captured_at"],
    "child_artifacts": ["run_id", "parent_source_id", "source_id", "url", "captured_at"],
    "snapshots": ["run_id", "source_id", "captured_at"],
    "rate_tables": ["run_id", "source_id", "captured_at", "table_index"],
    "rate_brackets": ["run_id", "source_id", "captured_at", "table_index", "bracket_index"],
    "fuel_prices": ["series_id", "period"],
    "applied_rates": ["carrier", "program", "week_ending_date"],
}
SNAPSHOT_KEY = KEYS["snapshots"]
