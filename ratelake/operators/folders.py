"""Run folders: what two of them differ in, from their paths alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.operators.normalize import flatten_brackets, flatten_tables
from ratelake.operators.parity import FEED, KEY, compare_runs
from ratelake.session import stored_once
from ratelake.sources.readers import read_run_deltas, read_run_snapshots


def run_tables(spark: SparkSession, run_dir: str, strict: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Snapshots (KEY, effective_date, path), tables, brackets and delta records of a run.

    The documents are read and checked once and stored, since all levels need them.
    """
    docs = stored_once(read_run_snapshots(spark, run_dir, strict), "run-snapshots")
    snapshots = docs.select(*KEY, "effective_date", F.col("file_path").alias("path"))
    tables = flatten_tables(docs.select(*KEY, F.struct("effective_date", "tables").alias("snapshot")))
    brackets = flatten_brackets(tables)
    return snapshots, tables, brackets, read_run_deltas(spark, run_dir, strict)


def _numbered_feed(rows: DataFrame) -> DataFrame:
    """Rows of a feed with their place among all of its lines as one number. The places of
    the blocks of all files are summed up, one row per block, as a line's is in its file."""
    at = ["file_path", "block"]
    rows = rows.select(*FEED, "position.file_path", "position.place.*")
    blocks = rows.groupBy(*at).agg(F.min("line").alias("_first"), (F.max("line") - F.min("line") + 1).alias("_n"))
    earlier = Window.orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.select(*at, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_from"))
    return rows.join(stored_once(begins, "feed-blocks"), at).select(*FEED, (F.col("_from") + F.col("line")).alias("position"))


def _stored_feed(spark: SparkSession, run_dir: str, strict: bool) -> DataFrame:
    """What parity compares of the delta records of a run, read and checked once. The line
    that makes the read fail is looked for only then."""
    rows = read_run_deltas(spark, run_dir, strict, named=False)
    try:
        rows = stored_once(rows.select(*FEED, "position"), "run-deltas")
    except Exception:
        if strict:
            read_run_deltas(spark, run_dir).write.format("noop").mode("overwrite").save()
        raise
    return _numbered_feed(rows)


def compare_run_folders(spark: SparkSession, baseline: str, candidate: str, strict: bool = True) -> DataFrame:
    """All mismatches of two run folders. Strict: a document or delta record that breaks
    the rules fails the job."""
    a, b = run_tables(spark, baseline, strict), run_tables(spark, candidate, strict)
    deltas = tuple(_stored_feed(spark, run, strict) for run in (baseline, candidate))
    return compare_runs((a[0], b[0]), (a[1], b[1]), (a[2], b[2]), deltas)
