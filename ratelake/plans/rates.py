"""Queries for price series, rate tables, their application and the report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelake.functions.brackets import lookup_bracket
from ratelake.operators import apply as A
from ratelake.operators.keyed import first_per_key
from ratelake.operators.normalize import flatten_brackets, flatten_tables
from ratelake.operators.ordered import previous_row
from ratelake.operators.ranges import range_lookup
from ratelake.operators.report import latest_week, report_lines, upcoming_tables
from ratelake.operators.series import ingest_series, response_rows, series_slice, with_ingest_defaults
from ratelake.plans import REGISTRY
from ratelake.plans.model import (
    CARRIERS, LATEST_CTE, PRICES_CTE, PROGRAM_OF_SERIES, SNAPSHOTS_CTE, price_series, read, snapshots,
)
from ratelake.session import stored_once

query = REGISTRY.query


@query("latest_price", f"""WITH {PRICES_CTE}
SELECT series_id, period, value FROM prices QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY period DESC) = 1""")
def latest_price(spark, sf_dir):
    return A.latest_price(price_series(spark, sf_dir))


@query("series_program_cross", f"""WITH {PRICES_CTE}
SELECT series_id, period, value, series_id AS program, carrier
FROM prices, (VALUES {", ".join(f"('{c}')" for c in CARRIERS)}) c(carrier)""")
def series_program_cross(spark, sf_dir):
    return A.series_program_cross(price_series(spark, sf_dir), PROGRAM_OF_SERIES, CARRIERS)


@query("latest_snapshot", f"WITH {SNAPSHOTS_CTE}, {LATEST_CTE} SELECT source_id, carrier, run_id, captured_at FROM latest")
def latest_snapshot(spark, sf_dir):
    return A.latest_snapshot(snapshots(spark, sf_dir)).select("source_id", "carrier", "run_id", "captured_at")


@query("flatten_tables", f"""WITH {SNAPSHOTS_CTE}
SELECT source_id, run_id, captured_at, table_index, program, coalesce(own_date, '2024-01-01') AS effective_date FROM snap_tables""")
def flat_tables(spark, sf_dir):
    flat = flatten_tables(snapshots(spark, sf_dir))
    return flat.select("source_id", "run_id", "captured_at", "table_index", "program", "effective_date")


@query("flatten_brackets", f"""WITH {SNAPSHOTS_CTE}
SELECT source_id, run_id, captured_at, table_index, bracket_index, bracket_id, index_range, min_index, max_index, surcharge_percent FROM snap_brackets""")
def flat_brackets(spark, sf_dir):
    flat = flatten_brackets(flatten_tables(snapshots(spark, sf_dir)))
    return flat.select(
        "source_id", "run_id", "captured_at", "table_index", "bracket_index", "bracket_id", "index_range",
        "min_index", "max_index", "surcharge_percent",
    )


@query("bracket_counts", f"""WITH {SNAPSHOTS_CTE}
SELECT source_id, captured_at, 5 AS table_count, CAST(count(*) AS BIGINT) AS bracket_count FROM snap_brackets GROUP BY ALL""")
def bracket_counts(spark, sf_dir):
    t = F.col("snapshot.tables")
    total = F.aggregate(t, F.lit(0).cast("bigint"), lambda acc, x: acc + F.size(x["brackets"]))
    return snapshots(spark, sf_dir).select(
        "source_id", "captured_at", F.size(t).alias("table_count"), total.alias("bracket_count")
    )


@query("program_sets", f"WITH {SNAPSHOTS_CTE} SELECT DISTINCT carrier, source_id, program FROM snap_tables")
def program_sets(spark, sf_dir):
    return flatten_tables(snapshots(spark, sf_dir)).select("carrier", "source_id", "program").distinct()


@query("bracket_lookup", f"""WITH {SNAPSHOTS_CTE}
SELECT source_id, captured_at, table_index, price, min(bracket_index) AS pos, arg_min(bracket_id, bracket_index) AS bracket_id FROM (
  SELECT *, (captured_at * 37 % 12000) / 100.0::DOUBLE AS price FROM snap_brackets)
WHERE (min_index IS NULL OR price >= min_index) AND (max_index IS NULL OR price < max_index + 1e-9::DOUBLE) GROUP BY ALL""")
def bracket_lookup(spark, sf_dir):
    tables = flatten_tables(snapshots(spark, sf_dir)).withColumn(
        "price", (F.col("captured_at") * 37 % 12000).cast("double") / 100
    )
    hit = tables.withColumn("_b", lookup_bracket(F.col("brackets"), F.col("price"))).filter("_b IS NOT NULL")
    position = F.array_position(F.transform("brackets", lambda b: b["bracket_id"]), F.col("_b.bracket_id"))
    return hit.select(
        "source_id", "captured_at", "table_index", "price",
        (position - 1).cast("int").alias("pos"), F.col("_b.bracket_id").alias("bracket_id"),
    )


_FLAT_BRACKETS_SQL = {
    "t": "p_partkey % 7",
    "low": "CASE WHEN p_partkey % 9 = 2 THEN NULL WHEN p_partkey % 397 = 5 THEN NULL ELSE CAST(p_partkey * 31 % 100000 AS DOUBLE) / 1000 END",
    "high": "CASE WHEN p_partkey % 9 = 3 THEN NULL WHEN p_partkey % 397 = 5 THEN NULL ELSE CAST(p_partkey * 31 % 100000 + p_partkey % 13 * 40 AS DOUBLE) / 1000 END",
}


@query("bracket_lookup_range_join", f"""
WITH b AS (SELECT p_partkey AS pos, {", ".join(f"{s} AS {n}" for n, s in _FLAT_BRACKETS_SQL.items())} FROM part),
f AS (SELECT DISTINCT l_suppkey % 7 AS t, l_extendedprice / 1000 AS v FROM lineitem)
SELECT f.t, f.v, min(b.pos) AS pos FROM f JOIN b ON f.t = b.t
  AND (b.low IS NULL OR f.v >= b.low) AND (b.high IS NULL OR f.v < b.high + 1e-9::DOUBLE) GROUP BY ALL""")
def bracket_lookup_range_join(spark, sf_dir):
    brackets = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pos"), *[F.expr(s).alias(n) for n, s in _FLAT_BRACKETS_SQL.items()]
    )
    facts = read(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 7).alias("t"), (F.col("l_extendedprice") / 1000).alias("v")
    )
    return range_lookup(facts, brackets, ["t"], "v", "low", "high", "pos")


_DEMAND_CTE = f"""demand AS (
  SELECT p.*, c.carrier, p.series_id AS program, CAST(p.period AS DATE) AS day
  FROM prices p, (VALUES {", ".join(f"('{c}')" for c in CARRIERS)}) c(carrier)),
candidates AS (
  SELECT * FROM (SELECT carrier, program, CAST(effective_date AS DATE) AS day, effective_date AS table_effective_date,
    source_id, table_index, run_id, captured_at FROM latest_tables)
  QUALIFY row_number() OVER (PARTITION BY carrier, program, day ORDER BY source_id, table_index) = 1),
in_force AS (
  SELECT d.*, c.table_effective_date, c.source_id, c.table_index, c.run_id, c.captured_at
  FROM demand d ASOF JOIN candidates c ON d.carrier = c.carrier AND d.program = c.program AND d.day >= c.day)"""
_FORCE = f"WITH {PRICES_CTE}, {SNAPSHOTS_CTE}, {LATEST_CTE}, {_DEMAND_CTE}"
_APPLIED_CTE = """applied AS (
  SELECT f.carrier, f.program, f.period AS week_ending_date, f.table_effective_date, b.bracket_id, b.index_range AS bracket_range,
    coalesce(CAST(b.surcharge_percent AS DECIMAL(8,4)), 0::DECIMAL(8,4)) AS applied_percent, b.surcharge_percent IS NULL AS percent_missing,
    CAST(f.value AS DECIMAL(12,4)) AS fuel_price, f.series_id AS fuel_index, f.run_id AS source_run_id
  FROM in_force f JOIN snap_brackets b ON f.source_id = b.source_id AND f.captured_at = b.captured_at AND f.table_index = b.table_index
    AND (b.min_index IS NULL OR f.value >= b.min_index) AND (b.max_index IS NULL OR f.value < b.max_index + 1e-9::DOUBLE)),
reasoned AS (
  SELECT *, CASE WHEN lag(table_effective_date) OVER w IS NULL THEN 'new'
    WHEN lag(table_effective_date) OVER w <> table_effective_date AND lag(bracket_id) OVER w <> bracket_id THEN 'both'
    WHEN lag(table_effective_date) OVER w <> table_effective_date THEN 'table_change'
    WHEN lag(bracket_id) OVER w <> bracket_id THEN 'fuel_tier_change' ELSE 'no_change' END AS reason,
    lag(applied_percent) OVER w AS prior_percent, lag(week_ending_date) OVER w AS prior_week
  FROM applied WINDOW w AS (PARTITION BY carrier, program ORDER BY week_ending_date))"""
_APPLIED = f"{_FORCE}, {_APPLIED_CTE}"


@query("asof_table", f"""{_FORCE}
SELECT carrier, program, period, value, table_effective_date, source_id AS table_source_id, table_index FROM in_force""")
def asof_table(spark, sf_dir):
    demand = A.series_program_cross(price_series(spark, sf_dir), PROGRAM_OF_SERIES, CARRIERS)
    found = A.tables_in_force(demand, A.rate_tables(snapshots(spark, sf_dir)))
    return found.select(
        "carrier", "program", "period", "value", "table_effective_date", "table_source_id", "table_index"
    )


def _applied(spark, sf_dir):
    return A.apply_rates(
        price_series(spark, sf_dir), A.rate_tables(snapshots(spark, sf_dir)), PROGRAM_OF_SERIES, CARRIERS
    )


@query("apply_rates", f"""{_APPLIED} SELECT * EXCLUDE (prior_percent, prior_week) FROM reasoned""")
def apply_rates(spark, sf_dir):
    return _applied(spark, sf_dir)


@query("apply_latest_rates", f"""{_APPLIED} SELECT * EXCLUDE (prior_percent, prior_week) FROM reasoned
SEMI JOIN (SELECT series_id AS fuel_index, max(period) AS week_ending_date FROM prices GROUP BY 1) USING (fuel_index, week_ending_date)""")
def apply_latest_rates(spark, sf_dir):
    """The newest price of each series against the stored earlier weeks."""
    prices = stored_once(price_series(spark, sf_dir), "prices")
    tables = stored_once(A.rate_tables(snapshots(spark, sf_dir)), "tables")
    stored = stored_once(A.apply_rates(prices, tables, PROGRAM_OF_SERIES, CARRIERS), "applied")
    return A.apply_rates(A.latest_price(prices), tables, PROGRAM_OF_SERIES, CARRIERS, history=stored)


@query("prior_applied", f"""{_APPLIED} SELECT carrier, program, week_ending_date, prior_week, prior_percent FROM reasoned""")
def prior_applied(spark, sf_dir):
    rows = _applied(spark, sf_dir).select("carrier", "program", "week_ending_date", "applied_percent")
    prior = previous_row(rows, ["carrier", "program"], "week_ending_date", ["week_ending_date", "applied_percent"])
    return prior.select(
        "carrier", "program", "week_ending_date",
        F.col("prior_week_ending_date").alias("prior_week"), F.col("prior_applied_percent").alias("prior_percent"),
    )


@query("change_reason", f"""{_APPLIED} SELECT carrier, program, reason, count(*) AS n FROM reasoned GROUP BY ALL""")
def change_reason(spark, sf_dir):
    return _applied(spark, sf_dir).groupBy("carrier", "program", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("latest_week", f"""{_APPLIED} SELECT max(week_ending_date) AS week FROM reasoned""")
def newest_week(spark, sf_dir):
    return latest_week(_applied(spark, sf_dir))


_UPCOMING_CTE = """upcoming AS (
  SELECT carrier, program, own_date AS effective_date, source_id, table_index FROM snap_tables
  WHERE own_date > (SELECT max(week_ending_date) FROM reasoned)
  QUALIFY row_number() OVER (PARTITION BY source_id, table_index ORDER BY captured_at DESC, run_id) = 1)"""


@query("upcoming_tables", f"{_APPLIED}, {_UPCOMING_CTE} SELECT * FROM upcoming")
def upcoming(spark, sf_dir):
    return upcoming_tables(snapshots(spark, sf_dir), latest_week(_applied(spark, sf_dir)))


@query("report_lines", f"""{_APPLIED}, {_UPCOMING_CTE},
week AS (SELECT max(week_ending_date) AS week FROM reasoned),
now_rows AS (SELECT * FROM reasoned WHERE week_ending_date = (SELECT week FROM week))
SELECT 0 AS section, '' AS sort_key, CAST(i - 1 AS INTEGER) AS line_no, lines[i] AS line
  FROM (SELECT ['# Weekly Carrier Pricing Events (' || week || ')', '', '## Events', ''] AS lines FROM week), range(1, 5) t(i)
UNION ALL
SELECT 1, carrier || '|' || program, CAST(i - 1 AS INTEGER), lines[i] FROM (
  SELECT carrier, program, [
    '- FSC | ' || carrier || ' | ' || program || ' | Week: ' || week_ending_date || ' | cause: ' || reason,
    '  - old_charge: ' || coalesce(printf('%.2f', prior_percent::DOUBLE) || '%', 'n/a') || ' | new_charge: ' || printf('%.2f', applied_percent::DOUBLE)
      || '% | bracket: ' || coalesce(bracket_range, bracket_id, 'n/a') || ' | table_eff: ' || table_effective_date,
    '  - fuel: ' || fuel_index || ' $' || printf('%.3f', fuel_price::DOUBLE), ''] AS lines FROM now_rows), range(1, 5) t(i)
UNION ALL
SELECT 2, '', CAST(i - 1 AS INTEGER), lines[i] FROM (SELECT ['## Upcoming Changes', ''] AS lines WHERE EXISTS (FROM upcoming)), range(1, 3) t(i)
UNION ALL
SELECT 3, source_id || '|' || lpad(CAST(table_index AS VARCHAR), 8, '0'), 0,
  '- ' || carrier || ' | ' || program || ' | effective: ' || effective_date || ' | source: ' || source_id FROM upcoming""")
def report(spark, sf_dir):
    applied = stored_once(_applied(spark, sf_dir), "applied")
    return report_lines(applied, upcoming_tables(snapshots(spark, sf_dir), latest_week(applied)))


@query("series_slice", f"""WITH {PRICES_CTE}
SELECT * FROM prices WHERE period BETWEEN '2024-01-03' AND '2024-01-28'
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY period DESC) <= 10""")
def sliced(spark, sf_dir):
    return series_slice(price_series(spark, sf_dir), "2024-01-03", "2024-01-28", 10)


_CENTS_SQL = "CAST(round(value * 100) AS BIGINT)"
_UNITS_SQL = "CASE event_id % 3 WHEN 0 THEN '\"$/GAL\"' WHEN 1 THEN '5' ELSE 'null' END"
RESPONSE_SQL = f"""CASE WHEN event_id % 100 = 0 THEN '{{"error":"none"}}' ELSE concat(
 '{{"response":{{"total":1,"data":[{{"period":"', day, '","value":"', {_CENTS_SQL}, '","units":', {_UNITS_SQL},
 CASE WHEN event_id % 2 = 0 THEN ',"series-description":"Weekly"' ELSE '' END,
 '}},{{"period":"', day, 'b","value":', {_CENTS_SQL}, '}}]}}}}') END"""


def _responses(spark, sf_dir):
    """One landed response per event: two rows each, repeated keys, some broken."""
    events = read(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return events.select(F.col("event_type").alias("series_id"), "event_id", F.expr(RESPONSE_SQL).alias("raw"))


_RESPONSE_ROWS = f"""rows AS (
  SELECT event_type AS series_id, event_id, strftime(ts, '%Y-%m-%d') AS period, {_CENTS_SQL}::DOUBLE AS value,
    CASE WHEN event_id % 3 = 0 THEN '$/GAL' END AS units, CASE WHEN event_id % 2 = 0 THEN 'Weekly' END AS description
  FROM events WHERE event_id % 100 <> 0
  UNION ALL
  SELECT event_type, event_id, strftime(ts, '%Y-%m-%d') || 'b', {_CENTS_SQL}::DOUBLE, NULL, NULL FROM events WHERE event_id % 100 <> 0)"""


@query("response_rows", f"WITH {_RESPONSE_ROWS} SELECT * FROM rows")
def responses(spark, sf_dir):
    return response_rows(_responses(spark, sf_dir), "raw")


@query("ingest_defaults", f"""WITH {_RESPONSE_ROWS}
SELECT series_id, event_id, period, value, coalesce(units, '') AS units, coalesce(description, series_id) AS description FROM rows""")
def ingest_defaults(spark, sf_dir):
    return with_ingest_defaults(response_rows(_responses(spark, sf_dir), "raw"))


@query("ingest_series", f"""WITH {_RESPONSE_ROWS}, {PRICES_CTE}
SELECT series_id, period, CAST(value AS DECIMAL(12,4)) AS value FROM rows
WHERE (series_id, period) NOT IN (SELECT (series_id, period) FROM prices WHERE period < '2024-01-15')
QUALIFY row_number() OVER (PARTITION BY series_id, period ORDER BY value) = 1""")
def ingested(spark, sf_dir):
    stored = price_series(spark, sf_dir).filter(F.col("period") < "2024-01-15")
    fresh = ingest_series(stored, response_rows(_responses(spark, sf_dir), "raw"))
    return fresh.select("series_id", "period", "value")


@query("first_per_key", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) = 1""")
def first_rows(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem")
    best = first_per_key(
        rows, ["l_suppkey"],
        [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")],
    )
    return best.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
