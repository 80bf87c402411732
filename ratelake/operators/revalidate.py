"""Re-validation of captures, as a table or as a run folder: normalise, find priors, diff."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake import fixed, schemas
from ratelake.operators.diff import ID, snapshot_diff, snapshot_pairs
from ratelake.operators.keyed import first_per_key
from ratelake.operators.normalize import CONTEXT, flatten_brackets, flatten_tables, normalize
from ratelake.operators.registry import diffable_sources, registry_missing, resolve_source_url
from ratelake.session import stored_once
from ratelake.sources.readers import decoded_path, read_artifacts, with_path_keys
from ratelake.sources.writers import write_artifacts, write_deltas


def normalized_snapshots(df: DataFrame, raw: str, path: str, order: list[Column]) -> DataFrame:
    """Normalise and store the snapshots at ``path``; the last capture of an id wins.

    Later steps read the snapshots several times, so they are written once to
    the shared folder rather than computed again.
    """
    done = normalize(df, raw).select(*[c for c in df.columns if c != raw], "snapshot")
    done.write.mode("overwrite").parquet(path)
    return first_per_key(df.sparkSession.read.parquet(path), ID, order)


def revalidate(
    df: DataFrame, raw: str, path: str, order: list[Column], bucket: Column | None = None
) -> DataFrame:
    """Delta records of all captures in ``df`` (context columns, run_id and ``raw``)."""
    stored = normalized_snapshots(df, raw, path, order).select(*ID, "snapshot")
    flags = stored.select(*ID, F.col("snapshot.parser_diagnostics.structural_error").alias("structural_error"))
    pairs = snapshot_pairs(stored.select(*ID), bucket).join(flags, ID)
    tables = flatten_tables(stored)
    brackets = flatten_brackets(tables)
    return snapshot_diff(
        pairs,
        tables.select(*ID, "program", "table_index", "effective_date"),
        brackets.select(
            *ID, "program", "table_index", "bracket_index", "bracket_id", "index_range", "surcharge_percent"
        ),
    )


CAPTURE = ["carrier", "source_id", "captured_at"]


@dataclass(frozen=True)
class Revalidated:
    """What a run folder comes to.

    snapshots  CAPTURE, run_id, snapshot, report: of every capture without an error
    deltas     delta records of the sources that are diffed
    errors     CAPTURE, error: captures that could not be checked
    """

    snapshots: DataFrame
    deltas: DataFrame
    errors: DataFrame


def _captures(spark: SparkSession, run_dir: str, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(captures with raw text and context, errors) of a run folder, joined by path keys."""
    found = with_path_keys(read_artifacts(spark, run_dir, "llm", fixed.RESPONSE_FILE), "llm")
    responses = found.select(*CAPTURE, F.col("value").alias("raw"))
    metas = with_path_keys(read_artifacts(spark, run_dir, "snapshots", fixed.META_FILE), "snapshots").select(
        *CAPTURE, F.from_json("value", schemas.CAPTURE_META)["final_url"].alias("final_url"), F.lit(True).alias("has_meta")
    )
    unknown = responses.join(registry_missing(responses, registry), "source_id", "left_semi").select(
        *CAPTURE, F.concat(F.lit("Source "), "source_id", F.lit(" not found in registry")).alias("error")
    )
    resolved = resolve_source_url(responses.join(metas, CAPTURE, "left"), registry)
    no_meta = F.concat(F.lit("Missing capture metadata for "), "source_id", F.lit(" at "), "captured_at")
    checked = resolved.withColumn("error", F.when(F.col("has_meta").isNull(), no_meta).otherwise(F.col("error")))
    errors = unknown.unionByName(checked.filter(F.col("error").isNotNull()).select(*CAPTURE, "error"))
    return checked.filter(F.col("error").isNull()).select(*CONTEXT, "raw"), errors


def _earlier_snapshots(spark: SparkSession, out_dir: str, run_id: str, sources: DataFrame) -> DataFrame:
    """Snapshots that other runs below ``out_dir`` hold of these sources: ID and document.
    The run is the folder's name, carrier and source are those of the path, the time is the
    document's own; documents without a time in their text are none."""
    files = with_path_keys(read_artifacts(spark, f"{out_dir}/*", "snapshots", fixed.SNAPSHOT_FILE), "snapshots")
    run = F.element_at(F.split(F.substring_index(decoded_path(F.col("file_path")), "/snapshots/", 1), "/"), -1)
    others = files.withColumn("run_id", run).filter(F.col("run_id") != run_id).join(
        sources.select("carrier", "source_id").distinct(), ["carrier", "source_id"], "left_semi"
    )
    document = F.from_json("value", schemas.SNAPSHOT)
    rows = others.select("carrier", "source_id", "run_id", "file_path", document.alias("snapshot"))
    rows = rows.withColumn("captured_at", F.col("snapshot.captured_at")).filter(F.col("captured_at").isNotNull())
    return first_per_key(rows, ID, [F.col("file_path").desc()]).select(*ID, "snapshot")


def revalidate_run_folder(spark: SparkSession, run_dir: str, out_dir: str, registry: DataFrame) -> Revalidated:
    """Check the stored responses of the run folder at ``run_dir`` again.

    Responses (``llm/…/extraction_response.json``), capture metadata
    (``snapshots/…/meta.json``) and the registry meet on the keys in the paths. A source
    that the registry lacks, a capture without metadata, and one without any URL give
    an error row each, and the run goes on. Sources with ``diff_enabled`` are diffed with
    the latest earlier snapshot that another run below ``out_dir`` holds. Paths that are
    too short are skipped.
    """
    run_id = run_dir.rstrip("/").rsplit("/", 1)[-1]
    captures, errors = _captures(spark, run_dir, registry)
    done = normalize(captures, "raw").select(*CAPTURE, F.lit(run_id).alias("run_id"), "snapshot", "report")
    done = stored_once(done, "revalidated")
    diffed = done.join(diffable_sources(registry).select(F.col("id").alias("source_id")), "source_id", "left_semi")
    own = diffed.select(*ID, "snapshot")
    # Of one run no capture is prior to another, so both sides can be walked as one.
    others = stored_once(_earlier_snapshots(spark, out_dir, run_id, own), "earlier")
    known = own.select(*ID).unionByName(others.select(*ID))
    pairs = snapshot_pairs(known).filter(F.col("run_id") == run_id)
    flag = F.col("snapshot.parser_diagnostics.structural_error").alias("structural_error")
    pairs = pairs.join(own.select(*ID, flag), ID)
    needed = pairs.select("carrier", "source_id", F.col("prior_run_id").alias("run_id"), F.col("prior_captured_at").alias("captured_at"))
    used = own.unionByName(others.join(needed.distinct(), ID, "left_semi"))
    tables = flatten_tables(used)
    columns = ["program", "table_index", "bracket_index", "bracket_id", "index_range", "surcharge_percent"]
    deltas = snapshot_diff(
        pairs, tables.select(*ID, "program", "table_index", "effective_date"), flatten_brackets(tables).select(*ID, *columns)
    )
    return Revalidated(done, deltas, errors)


def write_revalidated(result: Revalidated, run_dir: str) -> None:
    """Snapshots, reports and delta records into the areas of a run folder (a new one: the
    results read the old one's files)."""
    def documents(column: str, name: str) -> DataFrame:
        text = F.to_json(column, {"ignoreNullFields": "false"}).alias("value")
        return result.snapshots.select(*CAPTURE, F.lit(name).alias("file"), text)

    write_artifacts(documents("snapshot", fixed.SNAPSHOT_FILE), "value", f"{run_dir}/snapshots")
    write_artifacts(documents("report", fixed.REPORT_FILE), "value", f"{run_dir}/llm")
    write_deltas(result.deltas.drop("run_id"), f"{run_dir}/changes")
