"""Queries for the schema gate, normalisation and discovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelake.operators.discovery import discover, discovered_links
from ratelake.operators.gate import CANDIDATE_RULES, assertion_message, gate, json_type, with_json
from ratelake.operators.normalize import (
    candidates, flatten_brackets, flatten_tables, normalize, positions, scope_warnings, structural_error, warning_messages,
)
from ratelake.operators.registry import parse_responses
from ratelake.plans import REGISTRY
from ratelake.plans.duck import CANDIDATES_CTE, NORMAL_CTE, date_text
from ratelake.plans.model import candidate_rows

query = REGISTRY.query


def _issue_rows(spark, sf_dir):
    gated = gate(candidate_rows(spark, sf_dir), "raw")
    rows = positions(gated, F.col("issues"), ["o_orderkey"], ("_pos", "_i"))
    return rows.select("o_orderkey", "_i.*")


_ISSUE_ROWS = f"""WITH {CANDIDATES_CTE},
rows AS (SELECT o_orderkey, unnest(issues) AS issue FROM gated),
issue_rows AS (SELECT o_orderkey, split_part(issue, ' ', 1) AS path, substr(issue, strpos(issue, ' ') + 1) AS message FROM rows)
SELECT * FROM issue_rows"""


@query("candidate_gate", f"""WITH {CANDIDATES_CTE}
SELECT o_orderkey, CAST(len(issues) AS INTEGER) AS n_issues, array_to_string(issues, '; ') AS issues FROM gated""")
def candidate_gate(spark, sf_dir):
    gated = gate(candidate_rows(spark, sf_dir), "raw")
    texts = F.transform("issues", lambda e: F.concat_ws(" ", e["path"], e["message"]))
    return gated.select("o_orderkey", F.size("issues").alias("n_issues"), F.array_join(texts, "; ").alias("issues"))


@query("gate_strings", _ISSUE_ROWS + " WHERE starts_with(message, 'String must')")
def gate_strings(spark, sf_dir):
    return _issue_rows(spark, sf_dir).filter(F.startswith("message", F.lit("String must")))


@query("gate_enums", _ISSUE_ROWS + " WHERE starts_with(message, 'Invalid enum') OR contains(message, '|')")
def gate_enums(spark, sf_dir):
    return _issue_rows(spark, sf_dir).filter(
        F.startswith("message", F.lit("Invalid enum")) | F.contains("message", F.lit("|"))
    )


_FIELDS = ["effective_date", "programs", "links", "history_90d", "parse_warnings"]


@query("missing_vs_null", f"WITH {CANDIDATES_CTE} SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN doc IS NULL THEN 'bad' WHEN json_extract(doc, '$.{f}') IS NULL THEN 'missing' "
    f"ELSE CASE json_type(doc, '$.{f}') WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN 'string' "
    f"WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' END END AS {f}" for f in _FIELDS) + " FROM docs")
def missing_vs_null(spark, sf_dir):
    doc = F.col("doc")
    rows = with_json(candidate_rows(spark, sf_dir), "raw", "doc").select("o_orderkey", "doc")

    def state(name):
        v = F.try_variant_get(doc, f"$.{name}", "variant")
        return F.when(doc.isNull(), "bad").when(v.isNull(), "missing").otherwise(json_type(v))

    return rows.select("o_orderkey", *[state(f).alias(f) for f in _FIELDS])


@query("schema_assert", f"""WITH {CANDIDATES_CTE}
SELECT o_orderkey, 'Candidate ' || o_orderkey || ' failed schema validation: ' || array_to_string(list_transform(issues,
  lambda e: CASE WHEN starts_with(e, ' ') THEN '<root>' || e
    ELSE '/' || replace(split_part(e, ' ', 1), '.', '/') || substr(e, strpos(e, ' ')) END), '; ') AS error
FROM gated WHERE len(issues) > 0""")
def schema_assert(spark, sf_dir):
    gated = gate(candidate_rows(spark, sf_dir), "raw", CANDIDATE_RULES)
    label = F.concat(F.lit("Candidate "), "o_orderkey")
    return gated.select("o_orderkey", assertion_message(F.col("issues"), label).alias("error")).filter(
        F.col("error").isNotNull()
    )


@query("parse_responses", f"""WITH {CANDIDATES_CTE}
SELECT o_orderkey, CASE WHEN doc IS NULL THEN 'Failed to parse LLM JSON output' END AS error FROM docs""")
def parsed_responses(spark, sf_dir):
    return parse_responses(candidate_rows(spark, sf_dir), "raw").select("o_orderkey", "error")


_SCOPE = """CASE WHEN lower(json_extract_string(doc, '$.carrier')) <> lower(carrier) THEN
  'SCOPE_AMBIGUOUS: Candidate carrier ' || json_extract_string(doc, '$.carrier') || ' did not match ' || carrier END"""
_SCOPE_ID = """CASE WHEN json_extract_string(doc, '$.source_id') <> source_id THEN
  'SCOPE_AMBIGUOUS: Candidate source_id ' || json_extract_string(doc, '$.source_id') || ' did not match ' || source_id END"""
_DATE_MESSAGE = """CASE WHEN date_text IS NULL THEN 'MISSING_EFFECTIVE_DATE: Effective date was missing.'
  WHEN effective_date IS NULL THEN 'MISSING_EFFECTIVE_DATE: Could not normalize effective date: ' || date_text END"""


@query("scope_warnings", f"""WITH {NORMAL_CTE}
SELECT o_orderkey, concat_ws('; ', {_SCOPE}, {_SCOPE_ID}) AS warnings FROM valid""")
def scoped(spark, sf_dir):
    rows = candidates(candidate_rows(spark, sf_dir), "raw").filter("valid")
    found = scope_warnings(F.col("candidate"), F.col("carrier"), F.col("source_id"))
    return rows.select("o_orderkey", F.array_join(warning_messages(found), "; ").alias("warnings"))


_FLAGGED = "list_contains(list_transform(warns, lambda w: json_extract_string(w, '$.code')), 'PARSER_STRUCTURAL_ERROR')"


@query("structural_flag", f"""WITH {NORMAL_CTE}
SELECT o_orderkey, {_FLAGGED} OR n_programs = 0 AS structural_error FROM valid""")
def structural_flag(spark, sf_dir):
    rows = candidates(candidate_rows(spark, sf_dir), "raw").filter("valid")
    c = F.col("candidate")
    return rows.select(
        "o_orderkey", structural_error(c["parse_warnings"], c["programs"]).alias("structural_error")
    )


_BRACKET_MESSAGES = """bracket_messages AS (
  SELECT o_orderkey, string_agg(message, '; ' ORDER BY table_index, bracket_index, pos) AS messages, count(*) AS n FROM (
    SELECT o_orderkey, table_index, bracket_index, 0 AS pos, 'RANGE_PARSE_FAILED: Could not parse range: ' || range_text AS message FROM parsed WHERE NOT parsed
    UNION ALL
    SELECT o_orderkey, table_index, bracket_index, 1, 'PERCENT_PARSE_FAILED: Could not parse percent: ' || percent_text FROM parsed WHERE pct IS NULL)
  GROUP BY o_orderkey)"""


@query("warning_messages", f"""WITH {NORMAL_CTE}, {_BRACKET_MESSAGES}
SELECT o_orderkey, concat_ws('; ',
  nullif(array_to_string(list_transform(warns, lambda w: json_extract_string(w, '$.code') || ': ' || json_extract_string(w, '$.message')), '; '), ''),
  {_SCOPE}, {_SCOPE_ID}, {_DATE_MESSAGE}, messages,
  CASE WHEN n_programs = 0 THEN 'TABLE_NOT_FOUND: No programs were extracted from the candidate.' END,
  CASE WHEN n_programs = 0 AND NOT {_FLAGGED} THEN 'PARSER_STRUCTURAL_ERROR: Structural parse failure.' END) AS messages
FROM dated LEFT JOIN bracket_messages USING (o_orderkey)
UNION ALL
SELECT o_orderkey, array_to_string(list_transform(issues, lambda e: 'SCHEMA_ERROR: ' || e), '; ')
  || '; PARSER_STRUCTURAL_ERROR: Candidate schema validation failed.' FROM gated WHERE len(issues) > 0""")
def messages(spark, sf_dir):
    rows = normalize(candidate_rows(spark, sf_dir), "raw")
    return rows.select("o_orderkey", F.array_join("snapshot.parser_diagnostics.messages", "; ").alias("messages"))


@query("validation_report", f"""WITH {NORMAL_CTE}, {_BRACKET_MESSAGES}
SELECT o_orderkey, true AS candidate_valid, 0 AS n_errors, CAST(len(warns) AS INTEGER) AS n_candidate_warnings,
  CAST(({_SCOPE} IS NOT NULL)::INTEGER + ({_SCOPE_ID} IS NOT NULL)::INTEGER + (effective_date IS NULL)::INTEGER
    + coalesce(n, 0) + (n_programs = 0)::INTEGER AS INTEGER) AS n_warnings,
  {_FLAGGED} OR n_programs = 0 AS structural_error, CAST(n_programs AS INTEGER) AS table_count, effective_date
FROM dated LEFT JOIN bracket_messages USING (o_orderkey)
UNION ALL
SELECT o_orderkey, false, CAST(len(issues) AS INTEGER), 0, 0, true, 0, NULL FROM gated WHERE len(issues) > 0""")
def validation_report(spark, sf_dir):
    rows = normalize(candidate_rows(spark, sf_dir), "raw").select("o_orderkey", "report.*")
    return rows.select(
        "o_orderkey", "candidate_valid", F.size("errors").alias("n_errors"),
        F.size("candidate_warnings").alias("n_candidate_warnings"),
        F.size("normalization_warnings").alias("n_warnings"),
        "structural_error", "table_count", "effective_date",
    )


@query("normalize_snapshot", f"""WITH {NORMAL_CTE}
SELECT o_orderkey, CAST(table_index AS INTEGER) AS table_index, CAST(bracket_index AS INTEGER) AS bracket_index, program,
  effective_date, bracket_id, range_text AS index_range, low AS min_index, high AS max_index,
  pct AS surcharge_percent, percent_text AS surcharge_text FROM parsed""")
def normalize_snapshot(spark, sf_dir):
    rows = normalize(candidate_rows(spark, sf_dir), "raw").select("o_orderkey", "snapshot")
    return flatten_brackets(flatten_tables(rows))


@query("discovered_links", f"""WITH {CANDIDATES_CTE},
fixed AS (SELECT *, list_filter(issues, lambda e: NOT (starts_with(e, 'links.') AND ends_with(e, ' Invalid url'))) AS left_over FROM gated),
found AS (SELECT o_orderkey, source_url, json_extract_string(doc, '$.links[0].href') AS href,
  json_extract_string(doc, '$.links[0].effective_date') AS date_text,
  json_extract_string(doc, '$.links[0].evidence_snippet') AS context_excerpt
  FROM fixed WHERE doc IS NOT NULL AND len(left_over) = 0),
resolved AS (SELECT *, CASE WHEN starts_with(href, '/') THEN 'https://example.com' || href ELSE href END AS url FROM found WHERE href IS NOT NULL)
SELECT o_orderkey, 0 AS link_index, url, {date_text('date_text')} AS effective_date, context_excerpt
FROM resolved WHERE ends_with(url, '.pdf')""")
def links_found(spark, sf_dir):
    return discovered_links(_discover(spark, sf_dir).select("o_orderkey", "discovered"))


def _discover(spark, sf_dir):
    rows = candidate_rows(spark, sf_dir).select(
        "*",
        F.concat(F.lit("child_"), "source_id").alias("child_source_id"),
        F.col("source_url").alias("base_url"),
        F.lit(True).alias("pdf_only"),
    )
    return discover(rows, "raw")


@query("discovery_diagnostics", f"""WITH {CANDIDATES_CTE},
fixed AS (SELECT *, list_filter(issues, lambda e: NOT (starts_with(e, 'links.') AND ends_with(e, ' Invalid url'))) AS left_over,
  coalesce(json_extract(doc, '$.parse_warnings[*]'), []) AS warns FROM gated),
counted AS (SELECT *, CASE WHEN len(left_over) = 0 AND ends_with(json_extract_string(doc, '$.links[0].href'), '.pdf') THEN 1 ELSE 0 END AS n FROM fixed)
SELECT o_orderkey, n AS n_artifacts, len(left_over) > 0 OR n = 0 OR {_FLAGGED} AS structural_error,
  CASE WHEN len(left_over) > 0 THEN 'PARSER_STRUCTURAL_ERROR: Candidate schema validation failed.; ' ||
    array_to_string(list_transform(left_over, lambda e: CASE WHEN starts_with(e, ' ') THEN '<root>:' || e
      ELSE split_part(e, ' ', 1) || ':' || substr(e, strpos(e, ' ')) END), '; ')
  ELSE concat_ws('; ', nullif(array_to_string(list_transform(warns, lambda w: json_extract_string(w, '$.code') || ': ' || json_extract_string(w, '$.message')), '; '), ''),
    CASE WHEN n = 0 THEN 'LINKS_NOT_FOUND: No discoverable artifacts were found.' END) END AS messages
FROM counted""")
def discovery_diagnostics(spark, sf_dir):
    d = _discover(spark, sf_dir).select("o_orderkey", "discovered.*")
    return d.select(
        "o_orderkey", F.size("artifacts").alias("n_artifacts"), "parser_diagnostics.structural_error",
        F.array_join("parser_diagnostics.messages", "; ").alias("messages"),
    )
