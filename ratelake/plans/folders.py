"""Queries over run folders: written from the given tables, loaded, checked and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratelake import fixed, schemas
from ratelake.operators.normalize import normalize
from ratelake.operators.persist import compact_runs, persist_runs, read_run_table, run_tables
from ratelake.operators.registry import invoke_provider
from ratelake.operators.revalidate import revalidate_run_folder
from ratelake.plans import REGISTRY
from ratelake.plans.duck import NORMAL_CTE
from ratelake.plans.model import (
    CANDIDATE_SQL, CONTEXT_SQL, REGISTRY_CTE, SNAPSHOTS_CTE, read, registry, snapshots,
)
from ratelake.plans.runs import _ID, _delta_rows, _diff_sql
from ratelake.session import shared_dir, stored_once
from ratelake.sources import loads
from ratelake.sources.manifests import manifest_texts, write_manifests
from ratelake.sources.readers import (
    bad_json_lines, manifest_sources, read_binary_artifacts, read_json_documents, read_json_lines, read_manifests,
    read_registry, read_text_documents, with_path_keys,
)
from ratelake.sources.writers import write_artifacts

query = REGISTRY.query

RUNS = 7
NOW = "2030-01-01 00:00:00"


def _day(k):
    return F.date_add(F.lit("2024-01-01").cast("date"), k.cast("int")).cast("string")


def _write_runs(spark, sf_dir, out_dir: str, version: int) -> None:
    """The suppliers' captures as run folders. Every fifth capture failed; every fourth is
    a child of a hub. The second version holds even runs only, parsed anew: some captures
    without tables, the others without their last one."""
    k = F.col("captured_at")
    rows = snapshots(spark, sf_dir).withColumn("k", k).withColumn("day", _day(k)).drop("captured_at")
    rows = stored_once(rows, "captures")
    k, failed, child = F.col("k"), F.col("k") % 5 == 4, F.col("k") % 4 == 1
    tables = F.col("snapshot.tables")
    if version == 2:
        tables = F.when(k % 3 == 0, F.slice(tables, 1, 0)).otherwise(F.slice(tables, 1, 4))
    at = F.concat("day", F.lit("T00:00:00Z"))
    document = F.to_json(F.struct(
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"), "carrier", "source_id", at.alias("captured_at"),
        F.lit(f"https://example.com/v{version}").alias("source_url"), F.lit("text/html").alias("content_type"),
        F.col("snapshot.effective_date").alias("effective_date"), tables.alias("tables"),
        F.struct(F.lit(False).alias("structural_error"), F.array().cast("array<string>").alias("messages")).alias("parser_diagnostics"),
    ), {"ignoreNullFields": "false"})
    documents = rows.filter(~failed).select(
        "run_id", "carrier", "source_id", F.col("day").alias("captured_at"), F.lit(fixed.SNAPSHOT_FILE).alias("file"),
        document.alias("value"),
    )
    none = F.lit(None).cast("string")
    path = F.when(~failed, F.concat(
        F.lit("snapshots/carrier="), "carrier", F.lit("/source_id="), "source_id", F.lit("/captured_at="), "day",
        F.lit(f"/file={fixed.SNAPSHOT_FILE}"),
    ))
    status = F.when(failed, "error").otherwise("success").alias("status")
    error = F.when(failed, F.struct(F.concat(F.lit("no text "), k).alias("message"), none.alias("stack"))).alias("error")
    one = F.struct(
        "source_id", F.concat(F.lit("https://example.com/c/"), k).alias("url"),
        F.when(failed, "soon").otherwise(at).alias("captured_at"), none.alias("snapshot_dir"), path.alias("parsed_path"),
        none.alias("changes_path"), status, error, none.alias("effective_date_hint"),
    )
    hubs = (
        rows.filter(child).groupBy("run_id", F.expr("k div 4 % 3").alias("h"))
        .agg(F.array_sort(F.collect_list(F.struct("k", one.alias("c")))).alias("all"))
        .select(
            "run_id", (F.lit(1000000) + F.col("h")).cast("int").alias("position"), F.concat(F.lit("hub_"), "h").alias("source_id"),
            none.alias("carrier"), F.lit("DISCOVERY").alias("mode"), F.lit("success").alias("status"),
            F.lit("2024-01-01T00:00:00Z").alias("captured_at"), none.alias("parsed_path"),
            F.lit(None).cast("struct<message:string,stack:string>").alias("error"),
            F.transform("all", lambda x: x["c"]).alias("child_artifacts"),
        )
    )
    direct = rows.filter(~child).select(
        "run_id", k.cast("int").alias("position"), "source_id", "carrier", F.lit("DIRECT").alias("mode"), status,
        F.when(~failed, at).alias("captured_at"), path.alias("parsed_path"), error,
        F.array().cast(hubs.schema["child_artifacts"].dataType).alias("child_artifacts"),
    )
    sources = direct.unionByName(hubs)
    runs = rows.select("run_id").distinct().select(
        "run_id", F.lit("/out").alias("out_dir"), F.concat(F.lit("/out/"), "run_id").alias("run_dir"),
        F.lit("registry.json").alias("registry_path"), F.lit("2024-01-01T00:00:00Z").alias("started_at"),
        F.when(F.substring("run_id", 5, 9).cast("int") % 3 != 0, "2024-02-01T00:00:00Z").alias("ended_at"),
    )
    for r in range(RUNS):
        own = F.col("run_id") == f"run_{r}"
        if version == 1 or r % 2 == 0:
            write_artifacts(documents.filter(own), "value", f"{out_dir}/run_{r}/snapshots")
            # Both forms: lines for some runs, one document for the others.
            texts = manifest_texts(runs.filter(own), sources.filter(own), **({"limit": 0} if r % 2 else {}))
            write_manifests(texts, f"{out_dir}/run_{r}")


_MANIFEST_SQL = f"""WITH {SNAPSHOTS_CTE},
caps AS (SELECT *, captured_at AS k, captured_at % 5 = 4 AS failed, captured_at % 4 = 1 AS child,
  strftime(DATE '2024-01-01' + CAST(captured_at AS INTEGER), '%Y-%m-%d') AS day FROM snaps)"""


@query("manifest_round_trip", f"""{_MANIFEST_SQL}
SELECT * EXCLUDE (place), CAST(row_number() OVER (PARTITION BY run_id ORDER BY place) AS INTEGER) AS position FROM (
SELECT run_id, k AS place, source_id, CASE WHEN failed THEN 'error' ELSE 'success' END AS status,
  CASE WHEN NOT failed THEN day || 'T00:00:00Z' END AS captured_text,
  CASE WHEN NOT failed THEN 'snapshots/carrier=' || carrier || '/source_id=' || source_id || '/captured_at=' || day || '/file=parsed.json' END AS parsed_path,
  CASE WHEN failed THEN 'no text ' || k END AS message, '' AS children FROM caps WHERE NOT child
UNION ALL
SELECT run_id, 1000000 + k // 4 % 3, 'hub_' || (k // 4 % 3), 'success', '2024-01-01T00:00:00Z', NULL, NULL,
  string_agg(source_id || ' ' || CASE WHEN failed THEN 'soon' ELSE day || 'T00:00:00Z' END, ',' ORDER BY k)
FROM caps WHERE child GROUP BY run_id, k // 4 % 3)""")
def manifests(spark, sf_dir):
    """Manifests written in both forms and flattened again."""
    base = shared_dir(spark, "manifests")
    _write_runs(spark, sf_dir, base, 1)
    rows = manifest_sources(read_manifests(spark, base))
    children = F.transform("child_artifacts", lambda c: F.concat_ws(" ", c["source_id"], c["captured_at"]))
    place = F.row_number().over(Window.partitionBy("run_id").orderBy("position"))
    return rows.select(
        "run_id", place.alias("position"), "source_id", "status", "captured_text", "parsed_path", F.col("error.message").alias("message"),
        F.array_join(children, ",").alias("children"),
    )


_COLUMNS = ["tab", "run_id", "source_id", "captured_at", "i", "j", "info"]
_LOADED_SQL = f"""{_MANIFEST_SQL},
twice AS (SELECT * FROM caps WHERE CAST(right(run_id, 1) AS INTEGER) % 2 = 0),
parsed_tables AS (SELECT t.*, strftime(DATE '2024-01-01' + CAST(captured_at AS INTEGER), '%Y-%m-%dT%H:%M:%SZ') AS at_text FROM snap_tables t
  WHERE captured_at % 5 <> 4 AND (CAST(right(run_id, 1) AS INTEGER) % 2 = 1 OR (captured_at % 3 <> 0 AND table_index < 4)))
SELECT 'runs' AS tab, run_id, NULL AS source_id, CASE WHEN CAST(right(run_id, 1) AS INTEGER) % 3 <> 0 THEN '2024-02-01T00:00:00Z'
  ELSE '2030-01-01T00:00:00Z' END AS captured_at, -1 AS i, -1 AS j, 'registry.json' AS info
FROM (SELECT DISTINCT run_id FROM caps)
UNION ALL SELECT 'run_sources', run_id, source_id, CASE WHEN NOT failed THEN day || 'T00:00:00Z' END, -1, -1,
  CASE WHEN failed THEN 'error no text ' || k ELSE 'success' END FROM caps WHERE NOT child
UNION ALL SELECT 'run_sources', run_id, source_id, NULL, -1, -1, 'error no text ' || k FROM twice WHERE NOT child AND failed
UNION ALL SELECT DISTINCT 'run_sources', run_id, 'hub_' || (k // 4 % 3), '2024-01-01T00:00:00Z', -1, -1, 'success'
  FROM caps WHERE child
UNION ALL SELECT 'child_artifacts', run_id, source_id, CASE WHEN failed THEN '2030-01-01T00:00:00Z' ELSE day || 'T00:00:00Z' END, -1, -1,
  'hub_' || (k // 4 % 3) || ' https://example.com/c/' || k FROM caps WHERE child
UNION ALL SELECT 'snapshots', run_id, source_id, day || 'T00:00:00Z', -1, -1, carrier || ' https://example.com/v1' FROM caps WHERE NOT failed
UNION ALL SELECT 'rate_tables', run_id, source_id, at_text, table_index, -1, concat_ws(' ', program, own_date, '10') FROM parsed_tables
UNION ALL SELECT 'rate_brackets', run_id, source_id, at_text, table_index, bracket_index,
  concat_ws(' ', bracket_id, index_range, CAST(CAST(min_index AS DECIMAL(12,4)) AS VARCHAR), CAST(CAST(max_index AS DECIMAL(12,4)) AS VARCHAR),
    CAST(CAST(surcharge_percent AS DECIMAL(12,4)) AS VARCHAR))
FROM snap_brackets SEMI JOIN parsed_tables USING (run_id, source_id, captured_at, table_index)
  JOIN (SELECT DISTINCT captured_at, at_text FROM parsed_tables) USING (captured_at)"""


def _all_tables(spark, store):
    """All six tables as rows of one shape."""
    info = {
        "runs": ["registry_path"], "run_sources": ["status", "error.message"], "child_artifacts": ["parent_source_id", "url"],
        "snapshots": ["carrier", "source_url"], "rate_tables": ["program", "effective_date", "bracket_count"],
        "rate_brackets": ["bracket_id", "index_range", "min_index", "max_index", "surcharge_percent"],
    }
    out = None
    for table, names in info.items():
        rows = read_run_table(spark, store, table)
        has = rows.columns
        at = F.col("captured_at" if "captured_at" in has else "ended_at")

        def given(name, other, has=has):
            return F.col(name) if name in has else other

        shaped = rows.select(
            F.lit(table).alias("tab"), "run_id", given("source_id", F.lit(None).cast("string")).alias("source_id"),
            F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured_at"),
            given("table_index", F.lit(-1)).alias("i"), given("bracket_index", F.lit(-1)).alias("j"),
            F.concat_ws(" ", *[F.col(n).cast("string") for n in names]).alias("info"),
        )
        out = shaped if out is None else out.unionByName(shaped)
    return out.select(*_COLUMNS)


def _loaded(spark, sf_dir) -> str:
    """Loads: all runs; one that dies before its commit; the first one again; even runs anew."""
    base, now = shared_dir(spark, "persist"), F.lit(NOW).cast("timestamp")
    _write_runs(spark, sf_dir, f"{base}/v1", 1)
    _write_runs(spark, sf_dir, f"{base}/v2", 2)
    store = f"{base}/store"
    persist_runs(spark, f"{base}/v1", store, "load-1", now)
    dead = run_tables(spark, f"{base}/v2", now)
    for table in ("runs", "run_sources", "snapshots"):
        loads.write_rows(dead[table], store, table, "load-2")
    persist_runs(spark, f"{base}/v1", store, "load-1", now)
    persist_runs(spark, f"{base}/v2", store, "load-3", now)
    return store


@query("persist_run", _LOADED_SQL)
def persisted(spark, sf_dir):
    return _all_tables(spark, _loaded(spark, sf_dir))


@query("compact_loads", _LOADED_SQL)
def compacted(spark, sf_dir):
    """The same tables after their loads were merged and the old folders removed."""
    store = _loaded(spark, sf_dir)
    compact_runs(spark, store, "load-4")
    loads.remove_replaced(spark, store, ["runs", "run_sources", "child_artifacts", "snapshots", "rate_tables", "rate_brackets"])
    return _all_tables(spark, store)


# --- a run folder checked again ---------------------------------------------------------

# The suppliers take the place of orders in the candidate texts: one capture each.
_AS_ORDERS = {
    "o_orderkey": "s_suppkey", "o_custkey": "s_nationkey",
    "o_orderdate": "CAST(DATE '2024-01-01' + CAST(s_suppkey AS INTEGER) AS TIMESTAMP)",
}
_ORDERS_CTE = "orders AS (SELECT " + ", ".join(f"{sql} AS {n}" for n, sql in _AS_ORDERS.items()) + " FROM supplier)"
CHECKED_RUN = "run_3"
_META_URL = "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('https://final.example.com/', o_orderkey) END"


def _candidates(spark, sf_dir):
    days = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("o_orderkey"), F.col("s_nationkey").alias("o_custkey"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_suppkey").cast("int")).cast("timestamp").alias("o_orderdate"),
    )
    return days.select(
        "o_orderkey", *[F.expr(sql).alias(name) for name, sql in CONTEXT_SQL.items()],
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("captured_at"), F.expr(CANDIDATE_SQL).alias("raw"),
        F.expr(_META_URL).alias("final_url"),
    )


def _revalidated(spark, sf_dir):
    """Responses of one run in its folder, snapshots of the others in theirs; every
    thirteenth capture has lost its metadata."""
    base = shared_dir(spark, "revalidate-folder")
    rows = stored_once(_candidates(spark, sf_dir), "candidates")
    own = rows.filter(F.col("run_id") == CHECKED_RUN)
    write_artifacts(own.withColumn("file", F.lit(fixed.RESPONSE_FILE)), "raw", f"{base}/{CHECKED_RUN}/llm")
    meta = F.to_json(F.struct("captured_at", "final_url"))
    metas = own.filter(F.col("o_orderkey") % 13 != 5).withColumn("file", F.lit(fixed.META_FILE)).withColumn("meta", meta)
    write_artifacts(metas, "meta", f"{base}/{CHECKED_RUN}/snapshots")
    done = normalize(rows, "raw").withColumn("file", F.lit(fixed.SNAPSHOT_FILE)).withColumn(
        "text", F.to_json("snapshot", {"ignoreNullFields": "false"})
    )
    done = stored_once(done.select("run_id", "carrier", "source_id", "captured_at", "file", "text"), "normalised")
    for k in range(6):
        if f"run_{k}" != CHECKED_RUN:
            write_artifacts(done.filter(F.col("run_id") == f"run_{k}"), "text", f"{base}/run_{k}/snapshots")
    return revalidate_run_folder(spark, f"{base}/{CHECKED_RUN}", base, registry(spark, sf_dir))


_CHECKED_CTE = f"""WITH {_ORDERS_CTE}, {NORMAL_CTE}, {REGISTRY_CTE},
seen AS (SELECT g.*, left(captured_at, 10) AS day, r.id, r.diff_enabled, g.o_orderkey % 13 <> 5 AS has_meta,
    coalesce(nullif({_META_URL}, ''), r.url) AS found_url,
    coalesce(json_array_length(json_extract(doc, '$.programs')), 0) = 0 OR len(issues) > 0 OR
      list_contains(list_transform(coalesce(json_extract(doc, '$.parse_warnings[*]'), []), lambda w: json_extract_string(w, '$.code')), 'PARSER_STRUCTURAL_ERROR') AS broken
  FROM gated g LEFT JOIN registry r ON r.id = g.source_id),
judged AS (SELECT *, CASE WHEN id IS NULL THEN 'Source ' || source_id || ' not found in registry'
    WHEN NOT has_meta THEN 'Missing capture metadata for ' || source_id || ' at ' || day
    WHEN found_url IS NULL THEN 'Missing source URL for ' || source_id || ' at ' || day END AS error FROM seen)"""


@query("revalidate_errors", f"""{_CHECKED_CTE}
SELECT carrier, source_id, day AS captured_at, error FROM judged WHERE run_id = '{CHECKED_RUN}' AND error IS NOT NULL""")
def revalidate_errors(spark, sf_dir):
    return _revalidated(spark, sf_dir).errors


@query("revalidate_snapshots", f"""{_CHECKED_CTE}
SELECT j.carrier, j.source_id, j.day AS captured_at, found_url AS source_url,
  CASE WHEN r.artifact_type = 'html' THEN 'text/html' ELSE 'application/pdf' END AS content_type,
  broken AS structural_error, len(j.issues) AS n_errors, CASE WHEN len(j.issues) = 0 THEN v.effective_date END AS effective_date,
  CASE WHEN len(j.issues) = 0 THEN CAST(v.n_programs AS INTEGER) ELSE 0 END AS n_tables
FROM judged j JOIN registry r ON r.id = j.source_id LEFT JOIN dated v USING (o_orderkey)
WHERE j.run_id = '{CHECKED_RUN}' AND error IS NULL""")
def revalidate_snapshots(spark, sf_dir):
    return _revalidated(spark, sf_dir).snapshots.select(
        "carrier", "source_id", "captured_at", "snapshot.source_url", "snapshot.content_type",
        F.col("snapshot.parser_diagnostics.structural_error").alias("structural_error"),
        F.size("report.errors").cast("bigint").alias("n_errors"), "snapshot.effective_date",
        F.size("snapshot.tables").alias("n_tables"),
    )


@query("revalidate_run_folder", f"""{_CHECKED_CTE},
chosen AS (SELECT {_ID}, o_orderkey, broken FROM judged WHERE run_id <> '{CHECKED_RUN}' OR (error IS NULL AND diff_enabled)),
merged AS (SELECT {_ID}, program, bracket_id, range_text AS index_range, pct AS surcharge_percent FROM parsed SEMI JOIN chosen USING (o_orderkey)
  QUALIFY row_number() OVER (PARTITION BY {_ID}, program, bracket_id ORDER BY table_index DESC, bracket_index DESC) = 1),
dates AS (SELECT DISTINCT {_ID}, json_extract_string(tab, '$.program') AS program, effective_date FROM cand_tables SEMI JOIN chosen USING (o_orderkey)),
records AS (SELECT * FROM ({{}}))
SELECT * REPLACE (left(captured_at, 10) AS captured_at, left(prior_captured_at, 10) AS prior_captured_at) FROM records
WHERE run_id = '{CHECKED_RUN}'""".replace("records AS (SELECT * FROM ({}))", "records AS (WITH " + _diff_sql(
    "chosen", "merged", "dates",
    "(SELECT broken FROM chosen l WHERE l.carrier = b.carrier AND l.source_id = b.source_id AND l.run_id = b.run_id AND l.captured_at = b.captured_at)",
) + ")"))
def revalidate_folder(spark, sf_dir):
    return _delta_rows(_revalidated(spark, sf_dir).deltas)


# --- feeds and documents ------------------------------------------------------------------

_LINE_SQL = """CASE WHEN l_partkey % 17 = 0 THEN '' WHEN l_partkey % 101 = 5 THEN concat('{"a": ', l_orderkey)
  WHEN l_suppkey % 97 = 3 THEN 'oops' ELSE concat('{"a": ', l_orderkey, ', "b": "x"}') END"""
_LINE_ORDER = ["l_orderkey", "l_partkey", "l_suppkey"]


def _feed(spark, sf_dir) -> str:
    """Order lines as feeds by line number, a file each, some lines blank or broken."""
    path = shared_dir(spark, "feed")
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("feed"), *_LINE_ORDER, F.expr(_LINE_SQL).alias("value"))
    ordered = rows.repartition("feed").sortWithinPartitions("feed", *_LINE_ORDER)
    ordered.select("feed", "value").write.partitionBy("feed").text(path)
    return path


_FEED_CTE = f"""WITH lines AS (SELECT l_linenumber AS feed, {', '.join(_LINE_ORDER)}, {_LINE_SQL} AS value FROM lineitem),
numbered AS (SELECT feed, value, row_number() OVER (PARTITION BY feed ORDER BY {', '.join(_LINE_ORDER)}) AS line
  FROM lines WHERE value <> '')"""


@query("feed_bad_lines", f"""{_FEED_CTE}
SELECT CAST(feed AS INTEGER) AS feed, line, value FROM numbered WHERE NOT json_valid(value)""")
def feed_bad_lines(spark, sf_dir):
    bad = bad_json_lines(spark, _feed(spark, sf_dir), "a BIGINT, b STRING", "part-*")
    return bad.select(F.regexp_extract("file_path", "/feed=([0-9]+)/", 1).cast("int").alias("feed"), "line", "value")


@query("feed_rows", f"""{_FEED_CTE}
SELECT CAST(feed AS INTEGER) AS feed, CASE WHEN json_valid(value) THEN CAST(json_extract_string(value, '$.a') AS BIGINT) END AS a,
  CASE WHEN NOT json_valid(value) THEN value END AS broken, count(*) AS n FROM numbered GROUP BY ALL""")
def feed_rows(spark, sf_dir):
    rows = read_json_lines(spark, _feed(spark, sf_dir), "a BIGINT, b STRING", "part-*", strict=False)
    rows = rows.withColumn("feed", F.regexp_extract("file_path", "/feed=([0-9]+)/", 1).cast("int"))
    # A broken line has no fields, whatever could be read of it.
    a = F.when(F.col("_corrupt_record").isNull(), F.col("a"))
    return rows.groupBy("feed", a.alias("a"), F.col("_corrupt_record").alias("broken")).agg(F.count(F.lit(1)).alias("n"))


@query("capture_documents", f"""WITH {_ORDERS_CTE}
SELECT {CONTEXT_SQL['carrier']} AS carrier, {CONTEXT_SQL['source_id']} AS source_id, strftime(o_orderdate, '%Y-%m-%d') AS captured_at,
  {_META_URL} AS final_url, CAST(o_orderkey % 5 * 100 AS INTEGER) AS status_code FROM orders""")
def capture_documents(spark, sf_dir):
    """Documents read with their schema, keys from their paths, and a folder that does not exist."""
    base = shared_dir(spark, "captures")
    rows = _candidates(spark, sf_dir).withColumn("status_code", (F.col("o_orderkey") % 5 * 100).cast("int"))
    text = F.to_json(F.struct("final_url", "status_code", F.lit("x").alias("unknown")))
    write_artifacts(rows.withColumn("file", F.lit(fixed.META_FILE)).withColumn("text", text), "text", f"{base}/snapshots")
    write_artifacts(rows.limit(1).withColumn("file", F.lit("other.txt")), "raw", f"{base}/other")
    found = read_json_documents(spark, f"{base}/snapshots", schemas.CAPTURE_META, "part-*")
    none = read_json_documents(spark, f"{base}/none", schemas.CAPTURE_META, "part-*")
    keyed = with_path_keys(found.drop("captured_at").unionByName(none.drop("captured_at")), "snapshots")
    return keyed.select("carrier", "source_id", "captured_at", "final_url", "status_code")


@query("registry_document", f"""WITH {REGISTRY_CTE}
SELECT id, carrier, mode, url, parser_id, artifact_type, diff_enabled, child_source_id, discovered_only FROM registry""")
def registry_document(spark, sf_dir):
    """The registry as one document, checked and flattened again."""
    path = shared_dir(spark, "registry")
    rows = registry(spark, sf_dir)
    # Optional fields are left out where they are null, the others are written as null.
    optional = ["child_source_id", "discovered_only"]
    text = F.to_json(F.struct(*[c for c in rows.columns if c not in optional]), {"ignoreNullFields": "false"})
    extra = F.to_json(F.struct(*optional))
    source = F.when(extra == "{}", text).otherwise(F.concat(F.substr(text, F.lit(1), F.length(text) - 1), F.lit(","), F.substr(extra, F.lit(2))))
    one = rows.select(source.alias("s")).agg(F.concat(F.lit('{"version":"1.0","sources":['), F.array_join(F.sort_array(F.collect_list("s")), ","), F.lit("]}")).alias("value"))
    one.coalesce(1).write.text(path)
    return read_registry(spark, path)


@query("text_artifacts", """SELECT item_id, length(text) AS n_chars, sha256(text) AS text_hash, sha256(text || chr(10)) AS file_hash FROM benchmark""")
def text_artifacts(spark, sf_dir):
    """Artifacts in files of their own, read as whole texts and as bytes with their hash."""
    path = shared_dir(spark, "artifacts")
    read(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("value")).write.partitionBy("item_id").text(path)
    item = F.regexp_extract("path", "/item_id=([0-9]+)/", 1).cast("bigint").alias("item_id")
    texts = read_text_documents(spark, path, "part-*").select(F.col("file_path").alias("path"), F.regexp_replace("value", "\n$", "").alias("t"))
    files = read_binary_artifacts(spark, path, "part-*").select("path", F.col("content_hash_sha256").alias("file_hash"))
    return texts.select(item, F.length("t").cast("bigint").alias("n_chars"), F.sha2("t", 256).alias("text_hash")).join(
        files.select(item, "file_hash"), "item_id"
    )


@query("provider_batches", """SELECT conv_id, turn, length(text) AS n_chars, text LIKE '%e%' AS ok FROM conversations""")
def provider_batches(spark, sf_dir):
    """Rows sent in batches through a provider that the caller supplies."""
    def provider(batch):
        return batch.assign(n_chars=batch["text"].str.len(), ok=batch["text"].str.contains("e", regex=False))[
            ["conv_id", "turn", "n_chars", "ok"]
        ]

    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    turn = rows.schema["turn"].dataType.simpleString()
    return invoke_provider(rows, provider, f"conv_id bigint, turn {turn}, n_chars bigint, ok boolean")
