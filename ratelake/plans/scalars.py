"""Queries for the scalar functions and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelake.functions.brackets import fallback_bracket_id, parse_percent_text, parse_range_text
from ratelake.functions.dates import date_warning, file_safe, iso_seconds, parse_date_text, parse_timestamp
from ratelake.functions.keys import group_key, snapshot_key
from ratelake.functions.numbers import (
    format_percent, format_price, to_decimal, to_finite, two_decimals, within_tolerance,
)
from ratelake.functions.text import (
    absolute_path, collapse_whitespace, content_type, relative_path, sha256_hex, truncate,
)
from ratelake.functions.urls import is_valid_url
from ratelake.operators.diff import publishability
from ratelake.plans import REGISTRY
from ratelake.plans.duck import clean_range, collapse, date_text, percent, range_parts
from ratelake.plans.model import DATE_TEXT_SQL, PERCENT_TEXT_SQL, RANGE_TEXT_SQL, read

query = REGISTRY.query


@query("normalize_whitespace", f"""
SELECT 'd' || doc_id AS id, {collapse('text')} AS normal FROM documents
UNION ALL SELECT 'c' || conv_id || '/' || turn, {collapse('text')} FROM conversations""")
def normalize_whitespace(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    talk = read(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("/"), "turn").alias("id"), "text"
    )
    return docs.union(talk).select("id", collapse_whitespace(F.col("text")).alias("normal"))


@query("truncate_text", "SELECT doc_id, left(text, 300) AS head, left(text, 120) AS short FROM documents")
def truncate_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(
        "doc_id", truncate(F.col("text"), 300).alias("head"), truncate(F.col("text"), 120).alias("short")
    )


@query("content_hash", "SELECT doc_id, sha256(text) AS content_hash FROM documents")
def content_hash(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", sha256_hex(F.col("text")).alias("content_hash"))


@query("tolerance_equal", """
SELECT a, b, coalesce(abs(a - b) <= 0.01, a IS NULL AND b IS NULL) AS same, count(*) AS n
FROM (SELECT nullif(l_discount, 0) AS a, nullif(l_tax, 0) AS b FROM lineitem) GROUP BY ALL""")
def tolerance_equal(spark, sf_dir):
    pairs = read(spark, sf_dir, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("a"), F.nullif("l_tax", F.lit(0.0)).alias("b")
    )
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("a", "b", within_tolerance(F.col("a"), F.col("b")).alias("same"), "n")


_PARTS = range_parts("clean", "range_text")
_RANGES = f"""WITH texts AS (SELECT p_partkey, {RANGE_TEXT_SQL} AS range_text FROM part),
cleaned AS (SELECT *, {clean_range('range_text')} AS clean FROM texts)"""


@query("range_parse", f"""{_RANGES}
SELECT p_partkey, range_text, {_PARTS['low']} AS low, {_PARTS['high']} AS high,
  {_PARTS['bracket_id']} AS bracket_id, {_PARTS['parsed']} AS parsed FROM cleaned""")
def range_parse(spark, sf_dir):
    texts = read(spark, sf_dir, "part").select("p_partkey", F.expr(RANGE_TEXT_SQL).alias("range_text"))
    return texts.withColumn("_r", parse_range_text(F.col("range_text"))).select("p_partkey", "range_text", "_r.*")


@query("range_fallback", """
WITH t AS (SELECT p_partkey, lower(replace(p_name, ' ', '  ') || ' $' || p_type) AS s FROM part)
SELECT p_partkey, replace(trim(regexp_replace(replace(s, '$', ''), '\\s+', ' ', 'g')), ' ', '_') AS bracket_id FROM t
UNION ALL SELECT s_suppkey, 'unknown_range' FROM supplier""")
def range_fallback(spark, sf_dir):
    text = F.concat(F.replace("p_name", F.lit(" "), F.lit("  ")), F.lit(" $"), F.upper("p_type"))
    named = read(spark, sf_dir, "part").select("p_partkey", fallback_bracket_id(text).alias("bracket_id"))
    empty = read(spark, sf_dir, "supplier").select(
        "s_suppkey", fallback_bracket_id(F.when(F.col("s_suppkey") >= 0, " $, ")).alias("bracket_id")
    )
    return named.union(empty)


@query("bracket_id_format", "SELECT c_custkey, printf('%.2f', c_acctbal) AS formatted FROM customer")
def bracket_id_format(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", two_decimals(F.col("c_acctbal")).alias("formatted"))


@query("percent_parse", f"""
WITH t AS (SELECT p_partkey, {PERCENT_TEXT_SQL} AS percent_text FROM part)
SELECT p_partkey, percent_text, {percent('percent_text')} AS value FROM t""")
def percent_parse(spark, sf_dir):
    texts = read(spark, sf_dir, "part").select("p_partkey", F.expr(PERCENT_TEXT_SQL).alias("percent_text"))
    return texts.withColumn("value", parse_percent_text(F.col("percent_text")))


@query("date_parse", f"""
WITH t AS (SELECT o_orderkey, {DATE_TEXT_SQL} AS date_text FROM orders)
SELECT o_orderkey, date_text, {date_text('date_text')} AS day,
  CASE WHEN date_text IS NULL THEN 'Effective date was missing.'
    WHEN {date_text('date_text')} IS NULL THEN 'Could not normalize effective date: ' || date_text END AS warning
FROM t""")
def date_parse(spark, sf_dir):
    texts = read(spark, sf_dir, "orders").select("o_orderkey", F.expr(DATE_TEXT_SQL).alias("date_text"))
    text = F.col("date_text")
    return texts.select(
        "o_orderkey", text, parse_date_text(text).alias("day"), date_warning(text)["message"].alias("warning")
    )


@query("group_key", """
SELECT key, count(*) AS n FROM (
  SELECT coalesce(strftime(day, '%Y'), 'unknown') || '-fuel_surcharge-' || coalesce(strftime(day, '%Y-%m-%d'), 'unknown')
    || '-' || l_linestatus || '-' || coalesce(program, 'unknown') AS key
  FROM (SELECT CASE WHEN l_linenumber <> 2 THEN l_shipdate END AS day, l_linestatus, nullif(l_returnflag, 'N') AS program FROM lineitem))
GROUP BY key""")
def group_keys(spark, sf_dir):
    day = F.when(F.col("l_linenumber") != 2, F.date_format("l_shipdate", "yyyy-MM-dd"))
    key = group_key(F.col("l_linestatus"), F.nullif("l_returnflag", F.lit("N")), day)
    return read(spark, sf_dir, "lineitem").groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query("snapshot_key", """
SELECT o_orderstatus || '::cust_' || o_custkey || '::' || strftime(o_orderdate, '%Y-%m-%d') AS key, count(*) AS n
FROM orders GROUP BY 1""")
def snapshot_keys(spark, sf_dir):
    key = snapshot_key(
        F.col("o_orderstatus"), F.concat(F.lit("cust_"), "o_custkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return read(spark, sf_dir, "orders").groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query("format_values", """
SELECT o_orderkey, coalesce(printf('%.2f', x) || '%', 'n/a') AS percent, coalesce(printf('$%.3f', x), 'n/a') AS price
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS x FROM orders)""")
def format_values(spark, sf_dir):
    x = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", format_percent(x).alias("percent"), format_price(x).alias("price")
    )


@query("timestamp_parse", """
SELECT o_orderkey, CAST(epoch(TRY_CAST(t AS TIMESTAMP)) AS BIGINT) AS seconds FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'soon' WHEN o_orderkey % 11 = 0 THEN ''
    ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS t FROM orders)""")
def timestamp_parse(spark, sf_dir):
    k = F.col("o_orderkey")
    text = (
        F.when(k % 7 == 0, "soon").when(k % 11 == 0, "")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    return read(spark, sf_dir, "orders").select("o_orderkey", F.unix_seconds(parse_timestamp(text)).alias("seconds"))


@query("iso_format", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y-%m-%dT%H-%M-%SZ') AS file_name FROM events""")
def iso_format(spark, sf_dir):
    iso = iso_seconds(F.col("ts"))
    return read(spark, sf_dir, "events").select("event_id", iso.alias("iso"), file_safe(iso).alias("file_name"))


@query("json_access", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.none') AS missing FROM events""")
def json_access(spark, sf_dir):
    doc = F.try_parse_json("props")
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.try_variant_get(doc, "$.k", "int").alias("k"),
        F.try_variant_get(doc, "$.none", "string").alias("missing"),
    )


@query("relative_paths", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN 'snapshots/ups/' || o_custkey || '/parsed.json' END AS rel,
  CASE WHEN o_orderkey % 5 <> 0 THEN '/out/run_' || year(o_orderdate) || '/snapshots/ups/' || o_custkey || '/parsed.json' END AS again
FROM orders""")
def relative_paths(spark, sf_dir):
    root = F.concat(F.lit("/out/run_"), F.year("o_orderdate"), F.lit("/"))
    path = F.concat(
        F.when(F.col("o_orderkey") % 5 == 0, "/elsewhere/").otherwise(root),
        F.lit("snapshots/ups/"), F.col("o_custkey"), F.lit("/parsed.json"),
    )
    rel = relative_path(root, path)
    return read(spark, sf_dir, "orders").select("o_orderkey", rel.alias("rel"), absolute_path(root, rel).alias("again"))


@query("decimal_sink", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(l_extendedprice AS DECIMAL(12,4)) AS price, CAST(nullif(l_discount, 0) AS DECIMAL(8,4)) AS percent FROM lineitem""")
def decimal_sink(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        to_decimal(F.col("l_extendedprice")).alias("price"),
        to_decimal(F.nullif("l_discount", F.lit(0.0)), 8).alias("percent"),
    )


@query("finite_prices", """
SELECT event_id, x AS value FROM (
  SELECT event_id, TRY_CAST(CASE event_id % 10 WHEN 0 THEN 'NaN' WHEN 1 THEN 'Infinity' WHEN 2 THEN 'abc' WHEN 3 THEN NULL
    ELSE CAST(event_id AS VARCHAR) || '.5' END AS DOUBLE) AS x FROM events) WHERE isfinite(x)""")
def finite_prices(spark, sf_dir):
    e = F.col("event_id")
    text = (
        F.when(e % 10 == 0, "NaN").when(e % 10 == 1, "Infinity").when(e % 10 == 2, "abc")
        .when(e % 10 == 3, F.lit(None)).otherwise(F.concat(e.cast("string"), F.lit(".5")))
    )
    return (
        read(spark, sf_dir, "events").select("event_id", to_finite(text).alias("value"))
        .filter(F.col("value").isNotNull())
    )


@query("valid_urls", """
SELECT page_id, u, regexp_matches(u, '^(https?://[^/?#]+|mailto:.)') AS valid FROM (
  SELECT page_id, unnest([url, regexp_replace(url, '^https?://[^/]*', ''), replace(url, '/fr/', '/a b/é/'),
    'see ' || url, 'mailto:p' || page_id || '@example.com', 'https://']) AS u FROM pages)""")
def valid_urls(spark, sf_dir):
    url = F.col("url")
    forms = F.array(
        url, F.regexp_replace(url, "^https?://[^/]*", ""), F.replace(url, F.lit("/fr/"), F.lit("/a b/é/")),
        F.concat(F.lit("see "), url), F.concat(F.lit("mailto:p"), "page_id", F.lit("@example.com")), F.lit("https://"),
    )
    rows = read(spark, sf_dir, "pages").select("page_id", F.explode(forms).alias("u"))
    return rows.withColumn("valid", is_valid_url(F.col("u")))


@query("publishability", """
SELECT day IS NULL AS no_day, program, broken, NOT (day IS NULL OR program IS NULL OR program = 'unknown' OR broken) AS publishable,
  concat_ws(',', CASE WHEN day IS NULL THEN 'EFFECTIVE_DATE_UNKNOWN' END,
    CASE WHEN program IS NULL OR program = 'unknown' THEN 'PROGRAM_UNKNOWN' END,
    CASE WHEN broken THEN 'PARSER_STRUCTURAL_ERROR' END) AS reasons, count(*) AS n
FROM (SELECT CASE WHEN l_linenumber > 2 THEN 'x' END AS day,
  CASE l_returnflag WHEN 'A' THEN 'ground' WHEN 'R' THEN 'unknown' END AS program, l_linestatus = 'F' AS broken FROM lineitem)
GROUP BY ALL""")
def publishable(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") > 2, "x").alias("day"),
        F.when(F.col("l_returnflag") == "A", "ground").when(F.col("l_returnflag") == "R", "unknown").alias("program"),
        (F.col("l_linestatus") == "F").alias("broken"),
    )
    counts = rows.groupBy("day", "program", "broken").agg(F.count(F.lit(1)).alias("n"))
    p = publishability(F.col("program"), F.col("day"), F.col("broken"))
    return counts.select(
        F.col("day").isNull().alias("no_day"), "program", "broken",
        p["is_publishable"].alias("publishable"), F.array_join(p["reasons"], ",").alias("reasons"), "n",
    )


@query("content_types", """
SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'text/html' ELSE 'application/pdf' END AS content_type,
  CASE lower(CASE s_suppkey % 3 WHEN 0 THEN 'UpS' WHEN 1 THEN 'fedex' ELSE 'dhl' END) WHEN 'ups' THEN 'UPS' WHEN 'fedex' THEN 'FedEx' END AS carrier,
  count(*) AS n FROM supplier GROUP BY ALL""")
def content_types(spark, sf_dir):
    from ratelake.functions.text import canonical_carrier

    k = F.col("s_suppkey")
    name = F.when(k % 3 == 0, "UpS").when(k % 3 == 1, "fedex").otherwise("dhl")
    return (
        read(spark, sf_dir, "supplier")
        .groupBy(
            content_type(F.when(k % 2 == 0, "html").otherwise("pdf")).alias("content_type"),
            canonical_carrier(name).alias("carrier"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


