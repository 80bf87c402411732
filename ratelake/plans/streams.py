"""Queries that run a stream over a given table to its end and return the stored result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelake.operators.diff import ID
from ratelake.plans import REGISTRY
from ratelake.plans.duck import NORMAL_CTE
from ratelake.plans.model import (
    CANDIDATE_SQL, CONTEXT_SQL, VERSION_FILTER_SQL, VERSION_SQL, VERSIONS_CTE, read,
)
from ratelake.plans.runs import _ID, _MERGED_CTE, _delta_rows, _diff_sql
from ratelake.session import shared_dir
from ratelake.streaming.jobs import stream_dedup, stream_delta, stream_normalize

query = REGISTRY.query


def _stream(spark, sf_dir, name):
    """The table as a stream of its files."""
    schema = read(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query("stream_normalize", f"""WITH {NORMAL_CTE}
SELECT o_orderkey, true AS valid, effective_date, CAST(n_programs AS INTEGER) AS table_count FROM dated
UNION ALL SELECT o_orderkey, false, NULL, 0 FROM gated WHERE len(issues) > 0""")
def normalized(spark, sf_dir):
    captures = _stream(spark, sf_dir, "orders").select(
        "o_orderkey",
        *[F.expr(sql).alias(name) for name, sql in CONTEXT_SQL.items()],
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured_at"),
        F.expr(CANDIDATE_SQL).alias("raw"),
    )
    base = shared_dir(spark, "stream-normalize")
    job = stream_normalize(captures, "raw", f"{base}/snapshots", f"{base}/checkpoint")
    job.awaitTermination()
    done = spark.read.parquet(f"{base}/snapshots")
    return done.select(
        "o_orderkey", "valid", "report.effective_date", F.coalesce("report.table_count", F.lit(0)).alias("table_count")
    )


def _land(rows, path, part, parts):
    """``rows`` in as many files as ``parts``, written one after the other, so that a
    stream of one file per batch sees them in this order."""
    for k in range(parts):
        rows.filter(part == k).coalesce(1).write.mode("append").parquet(path)


@query("stream_dedup", """
SELECT DISTINCT event_type AS series_id, user_id, strftime(ts, '%Y-%m-%d') AS period FROM events""")
def deduplicated(spark, sf_dir):
    """Batches arrive newest first, so most keys of later batches are late ones."""
    rows = read(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_id"), "user_id",
        F.date_format("ts", "yyyy-MM-dd").alias("period"),
        F.col("ts").cast("timestamp").alias("seen_at"),
    )
    base = shared_dir(spark, "stream-dedup")
    _land(rows, f"{base}/in", F.lit(3) - F.pmod(F.dayofyear("seen_at"), F.lit(4)), 4)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    keys = ["series_id", "user_id", "period"]
    stream_dedup(
        stream, keys, ["seen_at"], f"{base}/rows", f"{base}/checkpoint", ["period"]
    ).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/rows").select(*keys)


@query("stream_delta", f"""WITH {VERSIONS_CTE}, {_MERGED_CTE},
ids AS (SELECT DISTINCT {_ID} FROM versions),
dates AS (SELECT {_ID}, program, arg_min(effective_date, table_index) FILTER (effective_date IS NOT NULL) AS effective_date FROM versions GROUP BY ALL),
{_diff_sql('ids', 'merged', 'dates', "b.source_id = 's_3'")}""")
def deltas(spark, sf_dir):
    """Snapshots arrive in the order of their capture, in several batches; the last
    batch delivers the first one's again."""
    names = [n for n in VERSION_SQL if n not in ("bracket_id", "index_range", "surcharge_percent")]
    bracket = F.struct(
        F.expr(VERSION_SQL["bracket_id"]).alias("bracket_id"),
        F.expr(VERSION_SQL["index_range"]).alias("index_range"),
        F.expr(VERSION_SQL["surcharge_percent"]).alias("surcharge_percent"),
        F.struct("l_orderkey", "l_partkey", "l_suppkey").alias("bracket_index"),
    )
    lines = read(spark, sf_dir, "lineitem").filter(VERSION_FILTER_SQL).select(
        *[F.expr(VERSION_SQL[n]).alias(n) for n in names], bracket.alias("bracket")
    )
    table = ["program", "table_index", "effective_date"]
    snapshots = (
        lines.groupBy(*ID, *table).agg(F.collect_list("bracket").alias("brackets"))
        .groupBy(*ID).agg(F.collect_list(F.struct(*table, "brackets")).alias("tables"))
        .withColumn("structural_error", F.col("source_id") == "s_3")
    )
    base = shared_dir(spark, "stream-delta")
    snapshots.write.parquet(f"{base}/all")
    ready = spark.read.parquet(f"{base}/all")
    second = F.unix_timestamp(F.col("captured_at").cast("timestamp"))
    quarters = ready.agg(F.percentile_approx(second, [0.25, 0.5, 0.75])).first()[0]
    part = sum(((second > t).cast("int") for t in quarters or []), F.lit(0))
    # Each landing is a batch of its own, written and read by as many tasks as it has.
    for k in (0, 1, 2, 3, 0):
        ready.filter(part == k).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(ready.schema).parquet(f"{base}/in")
        stream_delta(stream, f"{base}/tables", f"{base}/deltas", f"{base}/checkpoint").awaitTermination()
    return _delta_rows(spark.read.parquet(f"{base}/deltas"))
