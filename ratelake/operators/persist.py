"""Whole runs loaded into the flat tables: one load, one commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake import fixed, schemas
from ratelake.functions.numbers import to_decimal
from ratelake.operators.keyed import any_null, first_per_key
from ratelake.operators.normalize import flatten_brackets, flatten_tables
from ratelake.session import stored_once
from ratelake.sources import loads
from ratelake.sources.readers import (
    column_names, decoded_path, failing, manifest_children, manifest_runs, manifest_sources, read_artifacts, read_manifests,
)

CHILDREN = ["rate_tables", "rate_brackets"]
PARENTS = [t for t in schemas.RUN_TABLES if t not in CHILDREN]


def _names(table: str) -> list[str]:
    return column_names(schemas.RUN_TABLES[table])


def _distinct(rows: DataFrame, table: str, order: list[Column]) -> DataFrame:
    """One row per key of the table, the first under ``order``; null keys never conflict."""
    keys = schemas.KEYS[table]
    null_key = any_null(keys)
    first = first_per_key(rows.filter(~null_key), keys, order)
    return first.unionByName(rows.filter(null_key)).select(*_names(table))


def _captures(sources: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Captures with a parsed document, in the order of the manifest: a source, then its
    child artifacts."""
    columns = ["run_id", "base", "source_id", "captured_text", "parsed_path", "position"]
    own = sources.select(*columns, F.lit(-1).alias("child_position"))
    below = artifacts.select(*columns, "child_position")
    named = (F.col("parsed_path") != "") & (F.col("captured_text") != "")
    at = F.struct("position", "child_position")
    rows = own.unionByName(below).filter(named).withColumn("at", at).drop("position", "child_position")
    path = F.regexp_replace("parsed_path", "^(\\./)+", "")
    full = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(decoded_path(F.col("base")), F.lit("/"), path))
    return rows.withColumn("document_path", full)


def run_tables(spark: SparkSession, run_dir: str, now: Column) -> dict[str, DataFrame]:
    """Rows of all six tables that the run folder at ``run_dir`` brings, or the run folders
    right below it. ``now`` stands in for times that are missing.

    A capture whose time cannot be read, or whose document is missing or no JSON, fails the
    job. Of captures with one key, the first in manifest order gives the snapshot row and
    the last one the tables, as if loaded one after the other.
    """
    manifests = stored_once(read_manifests(spark, run_dir), "manifests")
    sources = manifest_sources(manifests)
    artifacts = manifest_children(sources, now)
    captures = _captures(sources, artifacts)

    parsed = F.from_json("value", f"{schemas.SNAPSHOT}, _broken STRING", {"columnNameOfCorruptRecord": "_broken"})
    area = read_artifacts(spark, run_dir, "snapshots", fixed.SNAPSHOT_FILE).unionByName(
        read_artifacts(spark, f"{run_dir}/*", "snapshots", fixed.SNAPSHOT_FILE)
    )
    documents = area.select("document_path", "value", parsed.alias("doc"))
    joined = captures.join(documents, "document_path", "left").withColumn("captured_at", F.col("captured_text").try_cast("timestamp"))
    checked = failing(
        joined, F.col("captured_at").isNull(),
        F.concat(F.lit("Invalid captured_at for snapshot "), "source_id", F.lit(": "), "captured_text"),
    )
    checked = failing(
        checked, F.col("doc").isNull() | F.col("doc._broken").isNotNull(),
        F.concat(F.lit("No snapshot document at "), "document_path"),
    )
    key = schemas.SNAPSHOT_KEY
    snapshots = stored_once(checked.select(*key, "at", "value", F.col("doc").dropFields("_broken").alias("doc")), "persist")
    rows = snapshots.select(
        *key, "doc.carrier", "doc.source_url", "doc.content_type", "doc.effective_date", "doc.parser_diagnostics",
        F.col("value").alias("parsed_json"), "at",
    )
    last = first_per_key(snapshots, key, [F.col("at").desc()])
    # A table keeps its own date here, without the snapshot's in its place.
    own = last.select(*key, F.struct(F.lit(None).cast("string").alias("effective_date"), "doc.tables").alias("snapshot"))
    tables = flatten_tables(own)
    brackets = flatten_brackets(tables)
    numbers = ["min_index", "max_index", "surcharge_percent"]
    place = [F.col("position").asc(), F.xxhash64("status", "parsed_path").asc()]
    return {
        "runs": _distinct(manifest_runs(manifests, now), "runs", [F.col("started_at").asc(), F.col("run_dir").asc()]),
        "run_sources": _distinct(sources, "run_sources", place),
        "child_artifacts": _distinct(artifacts, "child_artifacts", [F.col("position"), F.col("child_position")]),
        "snapshots": _distinct(rows, "snapshots", [F.col("at").asc()]),
        "rate_tables": tables.select(*_names("rate_tables")),
        "rate_brackets": brackets.select(
            *[to_decimal(F.col(n), 12, 4).alias(n) if n in numbers else F.col(n) for n in _names("rate_brackets")]
        ),
    }


def persist_runs(spark: SparkSession, run_dir: str, root: str, load_id: str, now: Column) -> bool:
    """Load the run folder at ``run_dir``, or all run folders right below it, into the
    tables at ``root``. False if the load was committed before; then nothing changes.

    All tables appear with one commit, or none does: a job that dies leaves nothing a
    reader sees, and is run again under the same id.
    """
    if loads.is_committed(spark, root, load_id):
        return False
    return loads.write_load(spark, run_tables(spark, run_dir, now), root, load_id)


def read_run_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as all committed loads leave it. Runs, sources, artifacts and snapshots are
    those that came first; tables and brackets those of the latest parse of a snapshot."""
    visible = loads.visible_loads(spark, root)
    rows = loads.loaded_rows(spark, root, table, schemas.RUN_TABLES[table], visible)
    if table in PARENTS:
        return loads.parents(rows, schemas.KEYS[table]).drop("load_id")
    parsed = loads.loaded_rows(spark, root, "snapshots", schemas.RUN_TABLES["snapshots"], visible)
    return loads.children(rows, parsed, schemas.SNAPSHOT_KEY).drop("load_id")


def compact_runs(spark: SparkSession, root: str, load_id: str, names: list[str] | None = None) -> list[str]:
    """Merge loads of these tables into one; their names. Readers see the same before,
    during and after."""
    return loads.compact(
        spark, root, load_id, {t: (schemas.RUN_TABLES[t], schemas.KEYS[t]) for t in PARENTS},
        {t: schemas.RUN_TABLES[t] for t in CHILDREN}, "snapshots", names,
    )
