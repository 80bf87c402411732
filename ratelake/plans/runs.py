"""Queries for run bookkeeping, change feeds and parity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelake import fixed
from ratelake.functions.keys import group_key
from ratelake.operators import parity as P
from ratelake.operators import registry as R
from ratelake.operators.diff import ID, merge_programs, snapshot_diff, snapshot_pairs
from ratelake.operators.folders import compare_run_folders
from ratelake.operators.keyed import (
    compare_keys, first_per_key, insert_if_absent, key_except, key_intersect, key_union, replace_by_key,
)
from ratelake.operators.revalidate import revalidate
from ratelake.plans import REGISTRY
from ratelake.plans.duck import NORMAL_CTE
from ratelake.plans.model import (
    PRICES_CTE, REGISTRY_CTE, SIDES_CTE, VERSIONS_CTE, candidate_rows, price_series, read, registry, run_sides,
    side_deltas, side_snapshots, versions,
)
from ratelake.session import shared_dir
from ratelake.sources.writers import write_deltas, write_documents

query = REGISTRY.query


# --- tables ---------------------------------------------------------------------

@query("insert_if_absent", f"""WITH {PRICES_CTE},
existing AS (SELECT * FROM prices WHERE period <= '2024-01-20'),
incoming AS (SELECT CASE WHEN event_id % 97 <> 0 THEN event_type END AS series_id, strftime(ts, '%Y-%m-%d') AS period, value, event_id FROM events)
SELECT series_id, period, value FROM existing
UNION ALL
SELECT series_id, period, value FROM (SELECT * FROM incoming WHERE series_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY series_id, period ORDER BY event_id) = 1) ANTI JOIN existing USING (series_id, period)
UNION ALL
SELECT series_id, period, value FROM incoming WHERE series_id IS NULL""")
def inserted(spark, sf_dir):
    existing = price_series(spark, sf_dir).filter(F.col("period") <= "2024-01-20")
    incoming = read(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 97 != 0, F.col("event_type")).alias("series_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("period"), "value", "event_id",
    )
    out = insert_if_absent(
        existing.withColumn("event_id", F.lit(None).cast("bigint")), incoming,
        ["series_id", "period"], [F.col("event_id")],
    )
    return out.drop("event_id")


@query("replace_by_key", """
SELECT l_suppkey, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem
WHERE l_suppkey % 4 <> 0 OR (l_suppkey % 8 <> 0 AND l_linenumber < 4) GROUP BY l_suppkey""")
def replaced(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity")
    parents = read(spark, sf_dir, "supplier").filter(F.col("s_suppkey") % 4 == 0).select(
        F.col("s_suppkey").alias("l_suppkey")
    )
    children = lines.filter((F.col("l_suppkey") % 8 == 4) & (F.col("l_linenumber") < 4))
    table = replace_by_key(lines, parents, children, ["l_suppkey"])
    return table.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


_KEY_SIDES = """a AS (SELECT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE l_returnflag <> 'A'),
b AS (SELECT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE l_linestatus = 'F')"""


def _key_sides(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem")
    named = [F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p")]
    return (
        rows.filter(F.col("l_returnflag") != "A").select(*named),
        rows.filter(F.col("l_linestatus") == "F").select(*named),
    )


@query("key_union", f"WITH {_KEY_SIDES} SELECT * FROM a UNION SELECT * FROM b")
def keys_union(spark, sf_dir):
    return key_union(*_key_sides(spark, sf_dir), ["s", "p"])


@query("key_except", f"WITH {_KEY_SIDES} SELECT * FROM a EXCEPT SELECT * FROM b")
def keys_except(spark, sf_dir):
    return key_except(*_key_sides(spark, sf_dir), ["s", "p"])


@query("key_intersect", f"WITH {_KEY_SIDES} SELECT * FROM a INTERSECT SELECT * FROM b")
def keys_intersect(spark, sf_dir):
    return key_intersect(*_key_sides(spark, sf_dir), ["s", "p"])


@query("key_compare", f"""WITH {_KEY_SIDES}
SELECT *, 'missing' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT *, 'extra' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def keys_compared(spark, sf_dir):
    return compare_keys(*_key_sides(spark, sf_dir), ["s", "p"])


# --- registry and captures --------------------------------------------------------

@query("runnable_sources", f"""WITH {REGISTRY_CTE}
SELECT id, mode, diff_enabled FROM registry WHERE NOT coalesce(discovered_only, false)""")
def runnable(spark, sf_dir):
    return R.runnable_sources(registry(spark, sf_dir)).select("id", "mode", "diff_enabled")


_LINES_SQL = "CASE WHEN l_orderkey % 20 = 0 THEN concat('src_x', l_suppkey % 9) ELSE concat('src_', l_suppkey) END"


def _lines(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(F.expr(_LINES_SQL).alias("source_id"), "l_returnflag", "l_shipdate")


@query("registry_join", f"""WITH {REGISTRY_CTE}
SELECT mode AS reg_mode, carrier AS reg_carrier, l_returnflag, count(*) AS n FROM lineitem JOIN registry ON id = {_LINES_SQL} GROUP BY ALL""")
def joined_registry(spark, sf_dir):
    rows = R.registry_join(_lines(spark, sf_dir), registry(spark, sf_dir))
    return rows.groupBy("reg_mode", "reg_carrier", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("registry_missing", f"""WITH {REGISTRY_CTE}
SELECT DISTINCT {_LINES_SQL} AS source_id FROM lineitem WHERE {_LINES_SQL} NOT IN (SELECT id FROM registry)""")
def missing_registry(spark, sf_dir):
    return R.registry_missing(_lines(spark, sf_dir), registry(spark, sf_dir))


_CAPTURES_CTE = """captures AS (
  SELECT 'src_' || (o_custkey % 100) AS source_id, strftime(o_orderdate, '%Y-%m-%d') AS captured_at,
    sha256('page ' || o_orderkey) AS content_hash_sha256,
    CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN 'https://final.example.com/' || o_orderkey END AS final_url
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey % 100, o_orderdate ORDER BY o_orderkey) = 1)"""


def _captures(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders").select(
        F.concat(F.lit("src_"), F.col("o_custkey") % 100).alias("source_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("captured_at"),
        F.sha2(F.concat(F.lit("page "), k), 256).alias("content_hash_sha256"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("https://final.example.com/"), k)).alias("final_url"),
        k,
    )
    return first_per_key(rows, ["source_id", "captured_at"], [k]).drop("o_orderkey")


@query("resolve_source_url", f"""WITH {REGISTRY_CTE}, {_CAPTURES_CTE}
SELECT source_id, captured_at, coalesce(nullif(final_url, ''), url) AS source_url,
  CASE WHEN artifact_type = 'html' THEN 'text/html' ELSE 'application/pdf' END AS content_type,
  CASE WHEN coalesce(nullif(final_url, ''), url) IS NULL THEN 'Missing source URL for ' || source_id || ' at ' || captured_at END AS error
FROM captures JOIN registry ON id = source_id""")
def resolved_urls(spark, sf_dir):
    rows = R.resolve_source_url(_captures(spark, sf_dir), registry(spark, sf_dir))
    return rows.select("source_id", "captured_at", "source_url", "content_type", "error")


@query("provenance_join", f"""WITH {REGISTRY_CTE}, {_CAPTURES_CTE},
children AS (SELECT DISTINCT 'src_' || l_suppkey AS child_source_id, strftime(l_shipdate, '%Y-%m-%d') AS parent_captured_at FROM lineitem)
SELECT child_source_id, parent_captured_at, r.id AS parent_source_id, content_hash_sha256 AS parent_content_hash
FROM children JOIN registry r USING (child_source_id) JOIN captures c ON c.source_id = r.id AND c.captured_at = parent_captured_at""")
def provenance(spark, sf_dir):
    children = read(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("src_"), "l_suppkey").alias("child_source_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("parent_captured_at"),
    ).distinct()
    return R.provenance_join(children, _captures(spark, sf_dir), registry(spark, sf_dir))


@query("capture_meta", """
SELECT page_id, sha256(html) AS content_hash_sha256, page_id % 500 AS navigation_ms, 750 + page_id % 500 AS total_ms FROM pages""")
def capture_metas(spark, sf_dir):
    k = F.col("page_id") % 500
    rows = read(spark, sf_dir, "pages").select(
        "page_id", "html", k.alias("navigation_ms"), F.lit(750).alias("settle_ms"), (k + 750).alias("total_ms")
    )
    return R.capture_meta(rows, "html").select(
        "page_id", "content_hash_sha256", "timings.navigation_ms", "timings.total_ms"
    )


_REQUEST_SQL = """'Extract FSC table data from this artifact.' || chr(10) || chr(10) || 'carrier: ' || CASE WHEN doc_id % 2 = 0 THEN 'UPS' ELSE 'FedEx' END
 || chr(10) || 'source_id: ' || source || chr(10) || 'artifact_type: ' || CASE WHEN doc_id % 3 = 0 THEN 'pdf' ELSE 'html' END
 || chr(10) || chr(10) || 'ARTIFACT_TEXT:' || chr(10) || '<<<' || chr(10) || text || chr(10) || '>>>'
 || CASE WHEN doc_id % 3 = 0 THEN '' ELSE chr(10) || chr(10) || 'DOM_MAP (if present):' || chr(10) || '<<<' || chr(10) || 'PAGE_TITLE: ' || lang || chr(10) || '>>>' END"""


@query("extraction_requests", f"""
SELECT doc_id, 'm1' AS model, length({_REQUEST_SQL}) AS n_chars, sha256({_REQUEST_SQL}) AS prompt_hash FROM documents""")
def requests(spark, sf_dir):
    k = F.col("doc_id")
    rows = read(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(k % 2 == 0, "ups").otherwise("FEDEX").alias("carrier"),
        F.col("source").alias("source_id"),
        F.when(k % 3 == 0, "pdf").otherwise("html").alias("artifact_type"),
        F.col("text").alias("artifact_text"),
        F.when(k % 3 != 0, F.concat(F.lit("PAGE_TITLE: "), "lang")).alias("outline"),
    )
    sent = R.extraction_requests(rows, "m1", "batch", "system", F.lit("2026-01-01T00:00:00Z"))
    record = F.from_json("request", "model STRING, user_prompt STRING")
    return sent.select("doc_id", record.alias("_r")).select(
        "doc_id", "_r.model",
        F.length("_r.user_prompt").cast("bigint").alias("n_chars"),
        F.sha2("_r.user_prompt", 256).alias("prompt_hash"),
    )


_STATUS_SQL = f"""WITH {REGISTRY_CTE},
visits AS (SELECT 'run_' || year(o_orderdate) AS run_id, o_orderkey % 13 <> 0 AS response_ok, 'src_' || (o_custkey % 100) AS source_id FROM orders)
SELECT run_id, source_id, error, CASE WHEN error IS NULL THEN 'success' ELSE 'error' END AS status, count(*) AS n FROM (
  SELECT v.run_id, v.source_id, CASE WHEN coalesce(r.url, '') = '' THEN 'Source ' || v.source_id || ' is missing a URL'
    WHEN lower(r.carrier) NOT IN ('ups', 'fedex') THEN 'Unsupported carrier: ' || r.carrier
    WHEN NOT response_ok THEN 'Failed to parse LLM JSON output'
    WHEN r.mode = 'DISCOVERY' AND r.child_source_id IS NULL THEN 'Discovery source ' || v.source_id || ' missing child_source_id'
    WHEN r.mode = 'DISCOVERY' AND c.id IS NULL THEN 'Child source ' || r.child_source_id || ' not found in registry' END AS error
  FROM visits v JOIN registry r ON r.id = v.source_id LEFT JOIN registry c ON c.id = r.child_source_id) GROUP BY ALL"""


@query("run_status", _STATUS_SQL)
def statuses(spark, sf_dir):
    reg = registry(spark, sf_dir)
    visits = read(spark, sf_dir, "orders").select(
        F.concat(F.lit("run_"), F.year("o_orderdate")).alias("run_id"),
        (F.col("o_orderkey") % 13 != 0).alias("response_ok"),
        F.concat(F.lit("src_"), F.col("o_custkey") % 100).alias("source_id"),
    )
    wanted = reg.select(F.col("id").alias("source_id"), "carrier", "mode", "url", "child_source_id")
    done = R.run_status(visits.join(wanted, "source_id"), reg)
    return done.groupBy("run_id", "source_id", "error", "status").agg(F.count(F.lit(1)).alias("n"))


@query("run_manifest", """
WITH visits AS (
  SELECT 'run_' || year(o_orderdate) AS run_id, 'src_' || (o_custkey % 50) AS source_id, count(*) AS n,
    strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%SZ') AS captured_at FROM orders GROUP BY ALL),
sources AS (SELECT *, CASE WHEN n % 7 = 0 THEN 'error' ELSE 'success' END AS status FROM visits)
SELECT run_id, source_id, CAST(json_object('source_id', source_id, 'status', status, 'captured_at', CASE WHEN n % 7 <> 0 THEN captured_at END,
  'child_artifacts', list_transform(range(n % 3), lambda i: json_object('source_id', 'child_' || i, 'status', 'success'))) AS VARCHAR) AS line FROM sources
UNION ALL
SELECT run_id, NULL, CAST(json_object('schema_version', '1.0', 'run_id', run_id, 'out_dir', '/out', 'n_sources', count(*),
  'n_errors', count(*) FILTER (status = 'error'), 'n_children', sum(n % 3)::BIGINT) AS VARCHAR) FROM sources GROUP BY run_id""")
def manifest(spark, sf_dir):
    run_id = F.concat(F.lit("run_"), F.year("o_orderdate")).alias("run_id")
    orders = read(spark, sf_dir, "orders")
    n = F.col("n")
    visits = orders.groupBy(run_id, F.concat(F.lit("src_"), F.col("o_custkey") % 50).alias("source_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("at")
    )
    child = lambda i: F.struct(
        F.concat(F.lit("child_"), i).alias("source_id"), F.lit("success").alias("status")
    )
    children = F.slice(F.transform(F.sequence(F.lit(0), F.lit(2)), child), F.lit(1), (n % 3).cast("int"))
    sources = visits.select(
        "run_id", "source_id",
        F.when(n % 7 == 0, "error").otherwise("success").alias("status"),
        F.when(n % 7 != 0, F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("captured_at"),
        children.alias("child_artifacts"),
    )
    runs = orders.select(run_id, F.lit("/out").alias("out_dir")).distinct()
    return R.run_manifest(runs, sources)


# --- change feed -----------------------------------------------------------------

@query("prior_snapshot", """
WITH s AS (SELECT DISTINCT CASE WHEN o_custkey % 2 = 0 THEN 'ups' ELSE 'fedex' END AS carrier, 'cust_' || o_custkey AS source_id,
  'run_' || (o_orderkey % 5) AS run_id, o_orderdate AS captured_at FROM orders)
SELECT c.carrier, c.source_id, c.run_id, strftime(c.captured_at, '%Y-%m-%d') AS captured_at,
  strftime(p.captured_at, '%Y-%m-%d') AS prior_captured_at, p.run_id AS prior_run_id
FROM s c LEFT JOIN s p ON c.carrier = p.carrier AND c.source_id = p.source_id AND p.captured_at < c.captured_at AND p.run_id <> c.run_id
QUALIFY row_number() OVER (PARTITION BY c.carrier, c.source_id, c.run_id, c.captured_at ORDER BY p.captured_at DESC NULLS LAST, p.run_id) = 1""")
def prior_snapshot(spark, sf_dir):
    c = F.col("o_custkey")
    rows = read(spark, sf_dir, "orders").select(
        F.when(c % 2 == 0, "ups").otherwise("fedex").alias("carrier"),
        F.concat(F.lit("cust_"), c).alias("source_id"),
        F.concat(F.lit("run_"), F.col("o_orderkey") % 5).alias("run_id"),
        F.col("o_orderdate").alias("captured_at"),
    )
    pairs = snapshot_pairs(rows)
    return pairs.select(
        "carrier", "source_id", "run_id",
        F.date_format("captured_at", "yyyy-MM-dd").alias("captured_at"),
        F.date_format("prior_captured_at", "yyyy-MM-dd").alias("prior_captured_at"),
        "prior_run_id",
    )


_ID = "carrier, source_id, run_id, captured_at"
_MERGED_CTE = f"""merged AS (SELECT {_ID}, program, bracket_id, index_range, surcharge_percent FROM versions
  QUALIFY row_number() OVER (PARTITION BY {_ID}, program, bracket_id
    ORDER BY table_index DESC, l_orderkey DESC, l_partkey DESC, l_suppkey DESC) = 1)"""


@query("merge_programs", f"""WITH {VERSIONS_CTE}, {_MERGED_CTE} SELECT * FROM merged""")
def merged(spark, sf_dir):
    return merge_programs(versions(spark, sf_dir), ID)


def _diff_sql(ids: str, merged_name: str, dates: str, flag: str) -> str:
    """Delta rows from ids, merged brackets and program dates (CTE names)."""
    return f"""pairs AS (
  SELECT c.*, p.captured_at AS prior_captured_at, p.run_id AS prior_run_id FROM {ids} c LEFT JOIN {ids} p
    ON c.carrier = p.carrier AND c.source_id = p.source_id AND p.captured_at < c.captured_at AND p.run_id <> c.run_id
  QUALIFY row_number() OVER (PARTITION BY c.carrier, c.source_id, c.run_id, c.captured_at ORDER BY p.captured_at DESC NULLS LAST, p.run_id) = 1),
cur AS (SELECT p.*, m.program, m.bracket_id, m.index_range, m.surcharge_percent FROM pairs p JOIN {merged_name} m USING ({_ID})),
old AS (SELECT p.*, m.program, m.bracket_id, m.index_range, m.surcharge_percent FROM pairs p JOIN {merged_name} m
  ON p.carrier = m.carrier AND p.source_id = m.source_id AND p.prior_run_id = m.run_id AND p.prior_captured_at = m.captured_at),
old_dates AS (SELECT p.*, d.program, d.effective_date FROM pairs p JOIN {dates} d
  ON p.carrier = d.carrier AND p.source_id = d.source_id AND p.prior_run_id = d.run_id AND p.prior_captured_at = d.captured_at),
both_sides AS (
  SELECT coalesce(c.carrier, o.carrier) AS carrier, coalesce(c.source_id, o.source_id) AS source_id, coalesce(c.run_id, o.run_id) AS run_id,
    coalesce(c.captured_at, o.captured_at) AS captured_at, coalesce(c.prior_captured_at, o.prior_captured_at) AS prior_captured_at,
    coalesce(c.program, o.program) AS program, coalesce(c.bracket_id, o.bracket_id) AS bracket_id,
    coalesce(c.index_range, o.index_range) AS index_range, o.surcharge_percent AS old_value, c.surcharge_percent AS new_value
  FROM cur c FULL OUTER JOIN old o ON c.carrier = o.carrier AND c.source_id = o.source_id AND c.run_id = o.run_id
    AND c.captured_at = o.captured_at AND coalesce(c.program, '-') = coalesce(o.program, '-') AND c.bracket_id = o.bracket_id),
deltas AS (
  SELECT b.*, coalesce(d.effective_date, od.effective_date) AS effective_date, {flag} AS broken FROM both_sides b
  JOIN {dates} d ON b.carrier = d.carrier AND b.source_id = d.source_id AND b.run_id = d.run_id AND b.captured_at = d.captured_at
    AND b.program IS NOT DISTINCT FROM d.program
  LEFT JOIN old_dates od ON b.carrier = od.carrier AND b.source_id = od.source_id AND b.run_id = od.run_id AND b.captured_at = od.captured_at
    AND b.program IS NOT DISTINCT FROM od.program
  WHERE old_value IS DISTINCT FROM new_value)
SELECT {_ID}, prior_captured_at, program, effective_date, bracket_id, index_range, old_value, new_value,
  coalesce(left(effective_date, 4), 'unknown') || '-fuel_surcharge-' || coalesce(effective_date, 'unknown') || '-' || carrier || '-' || coalesce(program, 'unknown') AS group_key,
  concat_ws(',', CASE WHEN effective_date IS NULL THEN 'EFFECTIVE_DATE_UNKNOWN' END,
    CASE WHEN program IS NULL OR program = 'unknown' THEN 'PROGRAM_UNKNOWN' END,
    CASE WHEN broken THEN 'PARSER_STRUCTURAL_ERROR' END) AS reasons FROM deltas"""


def _delta_rows(deltas):
    return deltas.select(
        *ID, "prior_captured_at", "program", "effective_date", "bracket_id", "index_range", "old_value", "new_value",
        "group_key", F.array_join("publishability.reasons", ",").alias("reasons"),
    )


@query("snapshot_diff", f"""WITH {VERSIONS_CTE}, {_MERGED_CTE},
ids AS (SELECT DISTINCT {_ID} FROM versions),
dates AS (SELECT {_ID}, program, arg_min(effective_date, table_index) FILTER (effective_date IS NOT NULL) AS effective_date FROM versions GROUP BY ALL),
{_diff_sql('ids', 'merged', 'dates', "b.source_id = 's_3'")}""")
def diffed(spark, sf_dir):
    rows = versions(spark, sf_dir)
    ids = rows.select(*ID).distinct()
    pairs = snapshot_pairs(ids).withColumn("structural_error", F.col("source_id") == "s_3")
    tables = rows.select(*ID, "program", "table_index", "effective_date").distinct()
    brackets = rows.drop("effective_date")
    return _delta_rows(snapshot_diff(pairs, tables, brackets))


@query("revalidate_run", f"""WITH {NORMAL_CTE},
last_capture AS (SELECT {_ID}, o_orderkey, len(issues) > 0 OR n_flag > 0 AS broken FROM (
    SELECT *, coalesce(json_array_length(json_extract(doc, '$.programs')), 0) = 0 OR
      list_contains(list_transform(coalesce(json_extract(doc, '$.parse_warnings[*]'), []), lambda w: json_extract_string(w, '$.code')), 'PARSER_STRUCTURAL_ERROR') AS n_flag FROM gated)
  QUALIFY row_number() OVER (PARTITION BY {_ID} ORDER BY o_orderkey DESC) = 1),
merged AS (SELECT {_ID}, program, bracket_id, range_text AS index_range, pct AS surcharge_percent FROM parsed SEMI JOIN last_capture USING (o_orderkey)
  QUALIFY row_number() OVER (PARTITION BY {_ID}, program, bracket_id ORDER BY table_index DESC, bracket_index DESC) = 1),
dates AS (SELECT DISTINCT {_ID}, json_extract_string(tab, '$.program') AS program, effective_date FROM cand_tables SEMI JOIN last_capture USING (o_orderkey)),
{_diff_sql('last_capture', 'merged', 'dates',
  "(SELECT broken FROM last_capture l WHERE l.carrier = b.carrier AND l.source_id = b.source_id AND l.run_id = b.run_id AND l.captured_at = b.captured_at)")}""".replace("n_flag > 0", "n_flag"))
def revalidated(spark, sf_dir):
    rows = candidate_rows(spark, sf_dir)
    deltas = revalidate(rows, "raw", shared_dir(spark, "revalidate"), [F.col("o_orderkey").desc()])
    return _delta_rows(deltas)


# --- parity ----------------------------------------------------------------------

_SNAP_KEY = "carrier, source_id, captured_at"
_PARITY_CTE = f"""{SIDES_CTE},
bs AS (SELECT {_SNAP_KEY}, max(effective_date) AS effective_date, max(path) AS path FROM base GROUP BY ALL),
cs AS (SELECT {_SNAP_KEY}, max(effective_date) AS effective_date, max(path) AS path FROM cand GROUP BY ALL),
compared AS (SELECT {_SNAP_KEY}, b.effective_date AS bd, c.effective_date AS cd, b.path AS bp, c.path AS cp
  FROM bs b FULL OUTER JOIN cs c USING ({_SNAP_KEY})),
matched AS (SELECT * FROM compared WHERE bp IS NOT NULL AND cp IS NOT NULL),
bprog AS (SELECT DISTINCT {_SNAP_KEY}, coalesce(program, 'null') AS program, 1 AS one FROM base),
cprog AS (SELECT DISTINCT {_SNAP_KEY}, coalesce(program, 'null') AS program, 1 AS one FROM cand),
progs AS (SELECT {_SNAP_KEY}, program, b.one AS b1, c.one AS c1 FROM bprog b FULL OUTER JOIN cprog c USING ({_SNAP_KEY}, program)),
bval AS (SELECT {_SNAP_KEY}, coalesce(program, 'null') AS program, bracket_id, surcharge_percent AS v, 1 AS one FROM base
  QUALIFY row_number() OVER (PARTITION BY {_SNAP_KEY}, program, bracket_id ORDER BY table_index DESC, l_orderkey DESC, l_partkey DESC, l_suppkey DESC) = 1),
cval AS (SELECT {_SNAP_KEY}, coalesce(program, 'null') AS program, bracket_id, surcharge_percent AS v, 1 AS one FROM cand
  QUALIFY row_number() OVER (PARTITION BY {_SNAP_KEY}, program, bracket_id ORDER BY table_index DESC, l_orderkey DESC, l_partkey DESC, l_suppkey DESC) = 1),
vals AS (SELECT {_SNAP_KEY}, program, bracket_id, b.v AS bv, c.v AS cv, b.one AS b1, c.one AS c1
  FROM bval b FULL OUTER JOIN cval c USING ({_SNAP_KEY}, program, bracket_id)
  SEMI JOIN (SELECT * FROM progs WHERE b1 = 1 AND c1 = 1) USING ({_SNAP_KEY}, program)),
snap_items AS (SELECT CASE WHEN cp IS NULL THEN 'MISSING_IN_LLM' ELSE 'EXTRA_IN_LLM' END AS category, carrier || '::' || source_id || '::' || captured_at AS key,
  CASE WHEN cp IS NULL THEN 'snapshot missing in llm' ELSE 'extra snapshot in llm' END AS message, bp AS baseline_path, cp AS llm_path, NULL AS a, NULL AS b
  FROM compared WHERE bp IS NULL OR cp IS NULL),
date_items AS (SELECT 'SCOPE_OR_DATE_MISMATCH' AS category, carrier || '::' || source_id || '::' || captured_at AS key,
  'effective_date mismatch' AS message, bp AS baseline_path, cp AS llm_path, bd AS a, cd AS b FROM matched WHERE bd IS DISTINCT FROM cd),
prog_items AS (SELECT 'SCOPE_OR_DATE_MISMATCH' AS category, carrier || '::' || source_id || '::' || captured_at AS key,
  CASE WHEN c1 IS NULL THEN 'program missing in llm: ' ELSE 'extra program in llm: ' END || program AS message, bp AS baseline_path, cp AS llm_path, NULL AS a, NULL AS b
  FROM progs JOIN matched USING ({_SNAP_KEY}) WHERE b1 IS NULL OR c1 IS NULL),
bracket_items AS (SELECT CASE WHEN b1 = 1 AND c1 = 1 THEN 'BRACKET_VALUE_MISMATCH' ELSE 'SCOPE_OR_DATE_MISMATCH' END AS category,
  carrier || '::' || source_id || '::' || captured_at AS key,
  CASE WHEN c1 IS NULL THEN 'bracket missing in llm: ' WHEN b1 IS NULL THEN 'extra bracket in llm: ' ELSE 'surcharge_percent mismatch for ' END
    || program || ' ' || bracket_id AS message, bp AS baseline_path, cp AS llm_path,
  CASE WHEN b1 = 1 AND c1 = 1 THEN CAST(bv AS VARCHAR) END AS a, CASE WHEN b1 = 1 AND c1 = 1 THEN CAST(cv AS VARCHAR) END AS b
  FROM vals JOIN matched USING ({_SNAP_KEY})
  WHERE b1 IS NULL OR c1 IS NULL OR NOT coalesce(abs(bv - cv) <= 0.01, bv IS NULL AND cv IS NULL))"""


def _delta_side(name: str) -> str:
    return f"""{name}_d AS (SELECT coalesce(left(effective_date, 4), 'unknown') || '-fuel_surcharge-' || coalesce(effective_date, 'unknown')
    || '-' || carrier || '-' || coalesce(program, 'unknown') AS key, source_id || '/' || bracket_id AS id,
    surcharge_percent - 1 AS o, surcharge_percent AS n, table_index, l_orderkey, l_partkey, l_suppkey FROM {name}),
{name}_g AS (SELECT key, count(*) AS cnt FROM {name}_d GROUP BY key),
{name}_v AS (SELECT key, id, o, n, 1 AS one FROM {name}_d
  QUALIFY row_number() OVER (PARTITION BY key, id ORDER BY table_index DESC, l_orderkey DESC, l_partkey DESC, l_suppkey DESC) = 1)"""


_DELTA_CTE = f"""{_delta_side('base')}, {_delta_side('cand')},
groups AS (SELECT key, b.cnt AS bc, c.cnt AS cc FROM base_g b FULL OUTER JOIN cand_g c USING (key)),
dvals AS (SELECT key, id, b.o AS bo, c.o AS co, b.n AS bn, c.n AS cn, b.one AS b1, c.one AS c1 FROM base_v b FULL OUTER JOIN cand_v c USING (key, id)
  SEMI JOIN (SELECT key FROM groups WHERE bc IS NOT NULL AND cc IS NOT NULL) USING (key)),
delta_items AS (
  SELECT CASE WHEN cc IS NULL THEN 'MISSING_IN_LLM' ELSE 'EXTRA_IN_LLM' END AS category, key,
    CASE WHEN cc IS NULL THEN 'delta group missing in llm' ELSE 'extra delta group in llm' END AS message, NULL AS a, NULL AS b FROM groups WHERE bc IS NULL OR cc IS NULL
  UNION ALL SELECT 'SCOPE_OR_DATE_MISMATCH', key, 'delta record count mismatch', CAST(bc AS VARCHAR), CAST(cc AS VARCHAR) FROM groups WHERE bc <> cc
  UNION ALL SELECT 'SCOPE_OR_DATE_MISMATCH', key, CASE WHEN c1 IS NULL THEN 'delta bracket missing in llm: ' ELSE 'extra delta bracket in llm: ' END || id, NULL, NULL
    FROM dvals WHERE b1 IS NULL OR c1 IS NULL
  UNION ALL SELECT 'BRACKET_VALUE_MISMATCH', key, 'old_value mismatch for ' || id, CAST(bo AS VARCHAR), CAST(co AS VARCHAR) FROM dvals
    WHERE b1 = 1 AND c1 = 1 AND NOT coalesce(abs(bo - co) <= 0.01, bo IS NULL AND co IS NULL)
  UNION ALL SELECT 'BRACKET_VALUE_MISMATCH', key, 'new_value mismatch for ' || id, CAST(bn AS VARCHAR), CAST(cn AS VARCHAR) FROM dvals
    WHERE b1 = 1 AND c1 = 1 AND NOT coalesce(abs(bn - cn) <= 0.01, bn IS NULL AND cn IS NULL))"""


def _item_rows(items):
    """Items with the details as two columns, doubles kept as text of both sides."""
    return items.select(
        "category", "key", "message", "baseline_path", "llm_path",
        F.col("details")["baseline"].alias("a"), F.col("details")["llm"].alias("b"),
    )


def _parity(spark, sf_dir):
    sides = run_sides(spark, sf_dir)
    compared = P.compare_snapshots(*[side_snapshots(s) for s in sides])
    return sides, compared


@query("parity_snapshots", f"WITH {_PARITY_CTE} SELECT * FROM snap_items")
def parity_snapshots(spark, sf_dir):
    return _item_rows(P.snapshot_items(_parity(spark, sf_dir)[1]))


@query("parity_dates", f"WITH {_PARITY_CTE} SELECT * FROM date_items")
def parity_dates(spark, sf_dir):
    return _item_rows(P.date_items(_parity(spark, sf_dir)[1]))


@query("parity_programs", f"WITH {_PARITY_CTE} SELECT * FROM prog_items")
def parity_programs(spark, sf_dir):
    sides, compared = _parity(spark, sf_dir)
    return _item_rows(P.program_items(P.compare_programs(compared, *sides)))


@query("parity_brackets", f"WITH {_PARITY_CTE} SELECT * FROM bracket_items")
def parity_brackets(spark, sf_dir):
    sides, compared = _parity(spark, sf_dir)
    return _item_rows(P.bracket_items(P.compare_programs(compared, *sides), *sides))


@query("parity_delta_groups", f"WITH {SIDES_CTE}, {_DELTA_CTE} SELECT * FROM delta_items")
def parity_delta_groups(spark, sf_dir):
    items = P.delta_items(*[side_deltas(s) for s in run_sides(spark, sf_dir)])
    return _item_rows(items).drop("baseline_path", "llm_path")


_ALL_ITEMS = """SELECT category, 'snapshot' AS scope, key, message FROM snap_items UNION ALL SELECT category, 'snapshot', key, message FROM date_items
UNION ALL SELECT category, 'snapshot', key, message FROM prog_items UNION ALL SELECT category, 'snapshot', key, message FROM bracket_items
UNION ALL SELECT category, 'delta', key, message FROM delta_items"""


def _report(spark, sf_dir):
    sides = run_sides(spark, sf_dir)
    return P.compare_runs(
        tuple(side_snapshots(s) for s in sides), sides, sides, tuple(side_deltas(s) for s in sides)
    )


@query("parity_report", f"WITH {_PARITY_CTE}, {_DELTA_CTE} {_ALL_ITEMS}")
def parity_report(spark, sf_dir):
    return _report(spark, sf_dir).select("category", "scope", "key", "message")


@query("parity_counts", f"""WITH {_PARITY_CTE}, {_DELTA_CTE}
SELECT category, scope, count(*) AS n_items FROM ({_ALL_ITEMS}) GROUP BY ALL""")
def parity_counts(spark, sf_dir):
    return P.category_counts(_report(spark, sf_dir))


def _write_run(side, run_dir: str) -> None:
    """A side's rows as a run folder: one document per snapshot, and its delta feed."""
    text = lambda c: F.col(c).cast("string")
    bracket = F.struct(
        "bracket_index", "bracket_id", text("bracket_id").alias("index_range"), F.lit(None).cast("double").alias("min_index"),
        F.lit(None).cast("double").alias("max_index"), "surcharge_percent", F.lit("").alias("surcharge_text"),
    )
    tables = side.groupBy(*P.KEY, "table_index", "program").agg(
        F.max("effective_date").alias("_date"), F.array_sort(F.collect_list(bracket)).alias("brackets")
    )
    table = F.struct("table_index", "program", F.lit(None).cast("string").alias("effective_date"), "brackets")
    snapshots = tables.groupBy(*P.KEY).agg(
        F.max("_date").alias("effective_date"), F.array_sort(F.collect_list(table)).alias("tables")
    )
    document = F.struct(
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"), *P.KEY, F.lit("https://example.com").alias("source_url"),
        F.lit("text/html").alias("content_type"), "effective_date", "tables",
        F.struct(F.lit(False).alias("structural_error"), F.array().cast("array<string>").alias("messages")).alias("parser_diagnostics"),
    )
    write_documents(snapshots.withColumn("_doc", document), "_doc", f"{run_dir}/snapshots", compression="gzip")
    none = F.lit(None).cast("string")
    # In order before they are widened: the sort then moves the narrow rows.
    deltas = side.orderBy("table_index", "bracket_index").select(
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"), *P.KEY, none.alias("prior_captured_at"), "program", "effective_date",
        F.concat_ws("/", "source_id", "bracket_id").alias("bracket_id"), text("bracket_id").alias("index_range"),
        (F.col("surcharge_percent") - 1).alias("old_value"), F.col("surcharge_percent").alias("new_value"),
        group_key(F.col("carrier"), F.col("program"), F.col("effective_date")).alias("group_key"),
        F.struct(F.lit(True).alias("is_publishable"), F.array().cast("array<string>").alias("reasons")).alias("publishability"),
        F.lit(False).alias("parser_structural_error"),
    )
    write_deltas(deltas, f"{run_dir}/changes", "gzip")


@query("compare_run_folders", f"WITH {_PARITY_CTE}, {_DELTA_CTE} {_ALL_ITEMS}")
def compare_folders(spark, sf_dir):
    """Both runs written as folders of documents and feeds, and compared from their paths."""
    base = shared_dir(spark, "runs")
    for name, side in zip(("baseline", "candidate"), run_sides(spark, sf_dir)):
        _write_run(side, f"{base}/{name}")
    return compare_run_folders(spark, f"{base}/baseline", f"{base}/candidate").select("category", "scope", "key", "message")
