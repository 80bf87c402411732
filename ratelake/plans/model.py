"""The given tables read as the rate-table model.

Each ``*_SQL`` text is a plain expression both engines understand, so Spark and
the check SQL start from the same inputs; what is computed from them is written
independently on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.functions.binding import let
from ratelake.functions.brackets import parse_percent_text, parse_range_text
from ratelake.session import spread

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PROGRAM_OF_SERIES = {name: name for name in EVENT_TYPES}
CARRIERS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

_MONTHS = "January,February,March,April,May,June,July,August,September,October,November,December"
MONTH_SQL = f"split_part('{_MONTHS}', ',', month(o_orderdate))"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- texts made of key columns ---------------------------------------------

DATE_TEXT_SQL = f"""CASE o_orderkey % 5
  WHEN 0 THEN concat({MONTH_SQL}, ' ', day(o_orderdate), ', ', year(o_orderdate))
  WHEN 1 THEN concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate))
  WHEN 2 THEN concat('Effective ', left({MONTH_SQL}, 3), '. ', day(o_orderdate), 'th ', year(o_orderdate))
  WHEN 3 THEN concat(year(o_orderdate), '-', month(o_orderdate), '-', day(o_orderdate))
  ELSE NULL END"""

RANGE_TEXT_SQL = """CASE p_partkey % 9
  WHEN 0 THEN concat('$', p_partkey % 40 * 10, '.00 - $', p_partkey % 40 * 10 + 9, '.99')
  WHEN 1 THEN concat(p_partkey % 40, '.5  to  ', p_partkey % 40 + 9, '.25 USD')
  WHEN 2 THEN concat('Less than $', p_partkey % 40 + 1, '.10')
  WHEN 3 THEN concat('$1,', 100 + p_partkey % 40, '.00 and above')
  WHEN 4 THEN concat('>= ', p_partkey % 40)
  WHEN 5 THEN concat('at least ', p_partkey % 40, '.00 but under ', p_partkey % 40 + 1)
  WHEN 6 THEN concat(p_partkey % 40, '.5', ' –', ' ', p_partkey % 40 + 2, '.75')
  WHEN 7 THEN concat(p_partkey % 40, ' Or  More')
  ELSE concat(p_partkey % 40, '+') END"""

PERCENT_TEXT_SQL = """CASE p_partkey % 6
  WHEN 0 THEN concat(p_partkey % 40, '.25%')
  WHEN 1 THEN concat('1,', 100 + p_partkey % 40, ' %')
  WHEN 2 THEN concat('-', p_partkey % 40, '.5abc')
  WHEN 3 THEN concat('.', 10 + p_partkey % 40)
  WHEN 4 THEN 'n/a'
  ELSE concat(' ', p_partkey % 40, 'e1 %') END"""


def _quoted(sql: str) -> str:
    return f"concat('\"', {sql}, '\"')"


def _program(name: str, brackets: str, title: str = "null", basis: str = '"diesel"') -> str:
    return (
        f"concat('{{\"program\":\"', {name}, '\",\"table_title\":{title},\"table_title_evidence\":null,"
        f"\"basis_hint\":{basis},', {brackets}, '\"table_evidence\":null}}')"
    )


def _bracket(range_sql: str, percent_sql: str) -> str:
    return (
        f"concat('{{\"range_text\":\"', {range_sql}, '\",\"percent_text\":\"', {percent_sql},"
        f" '\",\"row_evidence\":\"row\"}}')"
    )


_K, _C = "o_orderkey", "o_custkey"
_GROUND = _program(
    "'ground'",
    "concat('\"brackets\":[', "
    + ", ',', ".join([
        _bracket(f"concat('Less than $', {_K} % 40, '.50')", f"concat({_K} % 7, '.25%')"),
        _bracket(f"concat('$', {_K} % 40, '.50 - $', {_K} % 40 + 9, '.49')", f"concat({_C} % 9 + 5, '.50%')"),
        f"CASE WHEN {_K} % 6 = 0 THEN "
        + _bracket(f"concat({_K} % 40 + 9, '.50 or more')", "'n/a'")
        + " ELSE "
        + _bracket(f"concat('$', {_K} % 40 + 9, '.50 and above')", f"concat({_C} % 9 + 8, '%')")
        + " END",
    ])
    + ", '],')",
)
_AIR = _program(
    "'air'",
    f"CASE WHEN {_K} % 8 = 0 THEN '' ELSE concat('\"brackets\":[', "
    + _bracket(f"concat({_C} % 30, '+')", f"concat({_C} % 15, ' %')")
    + ", '],') END",
    title='"Air"',
    basis="null",
)
_THIRD = _program(f"CASE WHEN {_K} % 31 = 0 THEN 'sea' ELSE 'unknown' END", "'\"brackets\":[],'")

# Some documents repeat two keys; the first values are wrong.
REPEATED = '"carrier":"DHL","source_id":9,'
CANDIDATE_SQL = f"""concat(
 '{{', CASE WHEN {_K} % 61 = 0 THEN '{REPEATED}' ELSE '' END, '"artifact_type":"', CASE WHEN {_K} % 11 = 0 THEN 'doc' WHEN {_K} % 2 = 0 THEN 'html' ELSE 'pdf' END,
 '","carrier":', CASE WHEN {_K} % 13 = 0 THEN '"DHL"' WHEN {_K} % 53 = 0 THEN '7' WHEN {_K} % 2 = 0 THEN '"UPS"' ELSE '"FedEx"' END,
 ',"source_id":"', CASE WHEN {_K} % 17 = 0 THEN '' ELSE concat('src_', {_C} % 50) END, '"',
 CASE WHEN {_K} % 19 = 0 THEN '' ELSE concat(',"effective_date":', CASE WHEN {_K} % 5 = 4 THEN 'null' ELSE {_quoted(DATE_TEXT_SQL)} END) END,
 ',"effective_date_evidence":', CASE WHEN {_K} % 37 = 0 THEN {_quoted("repeat('e', 301)")} WHEN {_K} % 3 = 0 THEN 'null' ELSE '"seen"' END,
 CASE WHEN {_K} % 23 = 0 THEN '' WHEN {_K} % 29 = 0 THEN ',"programs":null'
  ELSE concat(',"programs":[', CASE {_K} % 4
    WHEN 0 THEN ''
    WHEN 1 THEN {_GROUND}
    WHEN 2 THEN concat({_GROUND}, ',', {_AIR})
    ELSE concat({_AIR}, ',', {_THIRD}, ',', {_GROUND}) END, ']') END,
 CASE WHEN {_K} % 3 = 0 THEN '' ELSE concat(',"links":[{{"href":"',
   CASE WHEN {_K} % 10 = 0 THEN '/docs/' ELSE 'https://example.com/t/' END, {_K}, CASE WHEN {_K} % 7 = 0 THEN '.pdf?v=1' ELSE '.pdf' END,
   '","link_text":null,"effective_date":', CASE WHEN {_K} % 4 = 0 THEN '"1/2/2026"' ELSE 'null' END, ',"evidence_snippet":"near ', {_K}, '"}}]') END,
 CASE WHEN {_K} % 41 = 0 THEN '' WHEN {_K} % 2 = 0 THEN ',"history_90d":null'
  ELSE concat(',"history_90d":{{"rows":[{{"week_of":"', CASE WHEN {_K} % 43 = 0 THEN '24' ELSE '2024-01-01' END,
    '","ground_percent_text":"5%","air_percent_text":null,"row_evidence":"r"}}]}}') END,
 CASE WHEN {_K} % 12 = 0 THEN ',"parse_warnings":[{{"code":"PARSER_STRUCTURAL_ERROR","message":"bad layout","severity":"error"}}]'
  WHEN {_K} % 47 = 0 THEN ',"parse_warnings":[{{"code":"X","message":"odd","severity":"fatal"}}]'
  WHEN {_K} % 14 = 0 THEN ',"parse_warnings":[{{"code":"NOTE","message":"faint print","severity":"info"}}]'
  WHEN {_K} % 2 = 0 THEN ',"parse_warnings":[]' ELSE '' END,
 CASE WHEN {_K} % 50 = 0 THEN '' ELSE '}}' END)"""

CONTEXT_SQL = {
    "carrier": f"CASE WHEN {_K} % 9 = 0 THEN 'fedex' WHEN {_K} % 2 = 0 THEN 'ups' ELSE 'fedex' END",
    "source_id": f"CASE WHEN {_K} % 7 = 0 THEN concat('src_', {_C} % 50 + 1) ELSE concat('src_', {_C} % 50) END",
    "run_id": f"concat('run_', {_K} % 6)",
    "source_url": f"concat('https://example.com/s/', {_C} % 50)",
    "content_type": f"CASE WHEN {_K} % 2 = 0 THEN 'text/html' ELSE 'application/pdf' END",
}


TASK_DOCUMENTS = 50_000  # candidate documents that one task takes
TASK_CAPTURES = 1_000  # and captures, of some tables each


def _tasks(rows: DataFrame, size: int) -> int:
    """At least one task per core and per ``size`` rows of a table."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // size))


def candidate_rows(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """One candidate document per order, with its capture context, in at least so many
    partitions (default: one per core and one per TASK_DOCUMENTS, since a document costs far
    more than its row)."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return spread(orders, partitions or _tasks(orders, TASK_DOCUMENTS)).select(
        "o_orderkey",
        *[F.expr(sql).alias(name) for name, sql in CONTEXT_SQL.items()],
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured_at"),
        F.expr(CANDIDATE_SQL).alias("raw"),
    )


# --- price series -------------------------------------------------------------

def price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last value of each day: series_id, period, value."""
    events = read(spark, sf_dir, "events")
    return events.groupBy(
        F.col("event_type").alias("series_id"), F.date_format("ts", "yyyy-MM-dd").alias("period")
    ).agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))


PRICES_CTE = """prices AS (
  SELECT event_type AS series_id, strftime(ts, '%Y-%m-%d') AS period, value FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type, strftime(ts, '%Y-%m-%d') ORDER BY ts DESC, event_id DESC) = 1)"""


# --- published snapshots --------------------------------------------------------

def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capture per supplier: its nation is the source, its region the carrier;
    one table per event type with ten price bands."""
    supplier = read(spark, sf_dir, "supplier")
    supplier = spread(supplier, _tasks(supplier, TASK_CAPTURES))
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    k = F.col("s_suppkey")

    def bracket(i, j):
        low = (j * 10).cast("string")
        text = (
            F.when(j == 0, "Less than $9.99")
            .when(j == 9, "$90.00 and above")
            .otherwise(F.concat(F.lit("$"), low, F.lit(".00 - $"), (j * 10 + 9).cast("string"), F.lit(".99")))
        )
        whole = ((k + i + j) % 20 + 5).cast("string")
        cents = F.lpad(((k * 7 + j) % 100).cast("string"), 2, "0")
        percent = F.when((k + j) % 11 == 0, "n/a").otherwise(F.concat(whole, F.lit("."), cents, F.lit("%")))
        texts = F.struct(text.alias("range_text"), percent.alias("percent_text"))
        return let(texts, lambda t: let(parse_range_text(t["range_text"]), lambda r: F.struct(
            r["bracket_id"].alias("bracket_id"), t["range_text"].alias("index_range"),
            r["low"].alias("min_index"), r["high"].alias("max_index"),
            parse_percent_text(t["percent_text"]).alias("surcharge_percent"),
            t["percent_text"].alias("surcharge_text"),
        )))

    def table(i):
        day = F.date_add(F.lit("2023-12-20").cast("date"), ((k * 5 + i * 3) % 45).cast("int")).cast("string")
        return F.struct(
            F.element_at(F.array(*[F.lit(e) for e in EVENT_TYPES]), i + 1).alias("program"),
            F.when((k + i) % 13 != 0, day).alias("effective_date"),
            F.transform(F.sequence(F.lit(0), F.lit(9)), lambda j: bracket(i, j)).alias("brackets"),
        )

    rows = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return rows.select(
        F.col("n_name").alias("source_id"),
        F.col("r_name").alias("carrier"),
        F.concat(F.lit("run_"), k % 7).alias("run_id"),
        k.alias("captured_at"),
        F.struct(
            F.col("r_name").alias("carrier"),
            F.lit("2024-01-01").alias("effective_date"),
            F.transform(F.sequence(F.lit(0), F.lit(4)), table).alias("tables"),
        ).alias("snapshot"),
    )


SNAPSHOTS_CTE = """snaps AS (
  SELECT n_name AS source_id, r_name AS carrier, 'run_' || (s_suppkey % 7) AS run_id, s_suppkey AS captured_at
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
snap_tables AS (
  SELECT snaps.*, CAST(i AS INTEGER) AS table_index,
    (['click','error','purchase','signup','view'])[i + 1] AS program,
    CASE WHEN (captured_at + i) % 13 <> 0
      THEN CAST(DATE '2023-12-20' + CAST((captured_at * 5 + i * 3) % 45 AS INTEGER) AS VARCHAR) END AS own_date
  FROM snaps, range(5) t(i)),
snap_brackets AS (
  SELECT snap_tables.*, CAST(j AS INTEGER) AS bracket_index,
    CASE WHEN j = 0 THEN 'lt_9.99' WHEN j = 9 THEN '90.00_plus'
      ELSE (j * 10) || '.00_' || (j * 10 + 9) || '.99' END AS bracket_id,
    CASE WHEN j = 0 THEN 'Less than $9.99' WHEN j = 9 THEN '$90.00 and above'
      ELSE '$' || (j * 10) || '.00 - $' || (j * 10 + 9) || '.99' END AS index_range,
    CASE WHEN j > 0 THEN CAST(j * 10 AS DOUBLE) END AS min_index,
    CASE WHEN j = 0 THEN 9.99::DOUBLE WHEN j < 9 THEN CAST(j * 10 + 9 || '.99' AS DOUBLE) END AS max_index,
    CASE WHEN (captured_at + j) % 11 <> 0
      THEN CAST(((captured_at + table_index + j) % 20 + 5) || '.' || lpad(CAST((captured_at * 7 + j) % 100 AS VARCHAR), 2, '0') AS DOUBLE)
      END AS surcharge_percent
  FROM snap_tables, range(10) t(j))"""

LATEST_CTE = """latest AS (
  SELECT * FROM snaps QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY captured_at DESC, run_id) = 1),
latest_tables AS (
  SELECT t.*, coalesce(own_date, '2024-01-01') AS effective_date
  FROM snap_tables t SEMI JOIN latest USING (source_id, run_id, captured_at))"""


# --- versions of flat tables -----------------------------------------------------

VERSION_SQL = {
    "carrier": "l_linestatus",
    "source_id": "concat('s_', l_suppkey % 10)",
    "run_id": "concat('run_', year(l_shipdate) % 4)",
    "captured_at": "concat(year(l_shipdate), '-01-01')",
    "program": "CASE l_returnflag WHEN 'A' THEN 'ground' WHEN 'R' THEN 'unknown' END",
    "table_index": "l_linenumber",
    "effective_date": "CASE WHEN l_linenumber = 1 THEN NULL ELSE concat(year(l_shipdate), '-02-0', l_linenumber) END",
    "bracket_id": "concat('b', l_partkey % 20)",
    "index_range": "concat('$', l_partkey % 20, ' - $', l_orderkey % 3)",
    "surcharge_percent": "CASE WHEN l_quantity = 7 THEN NULL ELSE l_quantity END",
}
# Some programs and brackets are absent in some years.
VERSION_FILTER_SQL = (
    "(year(l_shipdate) * 7 + l_partkey % 20) % 10 <> 0 "
    "AND NOT (l_returnflag = 'R' AND (year(l_shipdate) + l_suppkey % 10) % 5 = 0)"
)
VERSIONS_CTE = (
    "versions AS (SELECT l_orderkey, l_partkey, l_suppkey, "
    + ", ".join(f"{sql} AS {name}" for name, sql in VERSION_SQL.items())
    + f" FROM lineitem WHERE {VERSION_FILTER_SQL})"
)


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brackets of yearly table versions, one per order line."""
    return (
        read(spark, sf_dir, "lineitem")
        .filter(VERSION_FILTER_SQL)
        .select(
            *[F.expr(sql).alias(name) for name, sql in VERSION_SQL.items()],
            F.struct("l_orderkey", "l_partkey", "l_suppkey").alias("bracket_index"),
        )
    )


# --- two runs to compare -----------------------------------------------------------

SIDE_SQL = {
    "carrier": "l_linestatus",
    "source_id": "concat('src_', l_suppkey)",
    "captured_at": "concat(year(l_shipdate), '-01-01')",
    "program": "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END",
    "table_index": "l_linenumber",
    "bracket_id": "concat('b', l_linenumber, '_', l_partkey % 3)",
}
BASELINE_FILTER_SQL = "l_suppkey % 41 <> 7"
CANDIDATE_FILTER_SQL = (
    "l_linenumber < 7 AND l_suppkey % 37 <> 5 AND NOT (l_returnflag = 'R' AND l_suppkey % 10 = 3)"
)
BASELINE_VALUE_SQL = "CASE WHEN l_quantity = 9 THEN NULL ELSE round(l_discount * 100) END"
CANDIDATE_VALUE_SQL = (
    f"({BASELINE_VALUE_SQL}) + CASE WHEN l_suppkey % 9 = 0 THEN CAST(0.01 AS DOUBLE) "
    "WHEN l_suppkey % 8 = 0 THEN CAST(0.05 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
)
BASELINE_DATE_SQL = "CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE concat(year(l_shipdate), '-03-01') END"
CANDIDATE_DATE_SQL = (
    f"CASE WHEN l_suppkey % 11 = 0 THEN concat(year(l_shipdate), '-03-02') ELSE {BASELINE_DATE_SQL} END"
)


def _side(spark: SparkSession, sf_dir: str, where: str, value: str, date: str, path: str) -> DataFrame:
    return (
        read(spark, sf_dir, "lineitem")
        .filter(where)
        .select(
            *[F.expr(sql).alias(name) for name, sql in SIDE_SQL.items()],
            F.expr(value).alias("surcharge_percent"),
            F.expr(date).alias("effective_date"),
            F.concat(F.lit(f"{path}/"), F.expr(SIDE_SQL["source_id"])).alias("path"),
            F.struct("l_orderkey", "l_partkey", "l_suppkey").alias("bracket_index"),
        )
    )


def run_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Brackets of a baseline and a candidate run."""
    return (
        _side(spark, sf_dir, BASELINE_FILTER_SQL, BASELINE_VALUE_SQL, BASELINE_DATE_SQL, "base"),
        _side(spark, sf_dir, CANDIDATE_FILTER_SQL, CANDIDATE_VALUE_SQL, CANDIDATE_DATE_SQL, "cand"),
    )


def side_snapshots(side: DataFrame) -> DataFrame:
    """Snapshot rows of a run, one per key. Equal rows are merged by hash first, since the
    largest of texts is found by sorting all that come; their count is asked for, as the
    optimizer takes out a plain ``distinct`` below a maximum."""
    key = ["carrier", "source_id", "captured_at"]
    merged = side.groupBy(*key, "effective_date", "path").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 0")
    return merged.groupBy(*key).agg(
        F.max("effective_date").alias("effective_date"), F.max("path").alias("path")
    )


def side_deltas(side: DataFrame) -> DataFrame:
    """A delta feed of a run: each bracket row as one change by 1."""
    from ratelake.functions.keys import group_key

    return side.select(
        group_key(F.col("carrier"), F.col("program"), F.col("effective_date")).alias("group_key"),
        F.concat_ws("/", "source_id", "bracket_id").alias("bracket_id"),
        (F.col("surcharge_percent") - 1).alias("old_value"),
        F.col("surcharge_percent").alias("new_value"),
        F.struct("table_index", "bracket_index").alias("position"),
    )


def _side_cte(name: str, where: str, value: str, date: str, path: str) -> str:
    columns = ", ".join(f"{sql} AS {column}" for column, sql in SIDE_SQL.items())
    return (
        f"{name} AS (SELECT {columns}, {value} AS surcharge_percent, {date} AS effective_date, "
        f"'{path}/src_' || l_suppkey AS path, l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE {where})"
    )


SIDES_CTE = ",\n".join([
    _side_cte("base", BASELINE_FILTER_SQL, BASELINE_VALUE_SQL, BASELINE_DATE_SQL, "base"),
    _side_cte("cand", CANDIDATE_FILTER_SQL, CANDIDATE_VALUE_SQL, CANDIDATE_DATE_SQL, "cand"),
])


# --- source registry -----------------------------------------------------------------

REGISTRY_SQL = {
    "id": "concat('src_', s_suppkey)",
    "carrier": "CASE WHEN s_suppkey % 9 = 0 THEN 'dhl' WHEN s_suppkey % 2 = 0 THEN 'ups' ELSE 'FedEx' END",
    "mode": "CASE WHEN s_suppkey % 4 = 0 THEN 'DISCOVERY' ELSE 'DIRECT' END",
    "url": "CASE WHEN s_suppkey % 5 <> 0 THEN concat('https://example.com/', s_suppkey) END",
    "parser_id": "concat('parser_', s_suppkey % 3)",
    "artifact_type": "CASE WHEN s_suppkey % 2 = 0 THEN 'html' ELSE 'pdf' END",
    "diff_enabled": "s_suppkey % 3 <> 0",
    "child_source_id": "CASE WHEN s_suppkey % 4 = 0 AND s_suppkey % 12 <> 0 THEN concat('src_', s_suppkey + 3) END",
    "discovered_only": "CASE WHEN s_suppkey % 7 = 0 THEN true END",
}
REGISTRY_CTE = (
    "registry AS (SELECT s_suppkey, "
    + ", ".join(f"{sql} AS {name}" for name, sql in REGISTRY_SQL.items())
    + " FROM supplier)"
)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(
        *[F.expr(sql).alias(name) for name, sql in REGISTRY_SQL.items()]
    )
