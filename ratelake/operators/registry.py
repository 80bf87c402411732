"""Source registry, run bookkeeping and captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import fixed
from ratelake.functions.text import canonical_carrier, content_type, sha256_hex
from ratelake.operators.gate import with_json


def runnable_sources(registry: DataFrame) -> DataFrame:
    """Sources a run visits itself; sources only reached by discovery are left out."""
    return registry.filter(~F.coalesce("discovered_only", F.lit(False)))


def diffable_sources(registry: DataFrame) -> DataFrame:
    return registry.filter(F.coalesce("diff_enabled", F.lit(False)))


def registry_join(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows with the registry columns of their source (prefixed ``reg_``).

    No hint: the planner broadcasts the registry only while its size allows.
    """
    reg = registry.select(
        F.col("id").alias("source_id"), *[F.col(c).alias(f"reg_{c}") for c in registry.columns if c != "id"]
    )
    return rows.join(reg, "source_id")


def registry_missing(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Source ids the registry does not know."""
    known = registry.select(F.col("id").alias("source_id"))
    return rows.select("source_id").distinct().join(known, "source_id", "left_anti")


def resolve_source_url(captures: DataFrame, registry: DataFrame) -> DataFrame:
    """``source_url`` = final URL of the capture, else the registered URL; an
    ``error`` text where both are missing."""
    joined = captures.join(
        registry.select(F.col("id").alias("source_id"), F.col("url").alias("_url"), "artifact_type"), "source_id"
    )
    url = F.coalesce(F.nullif("final_url", F.lit("")), F.nullif("_url", F.lit("")))
    return (
        joined.withColumn("source_url", url)
        .withColumn("content_type", content_type(F.col("artifact_type")))
        .withColumn(
            "error",
            F.when(
                url.isNull(),
                F.concat(F.lit("Missing source URL for "), "source_id", F.lit(" at "), "captured_at"),
            ),
        )
        .drop("_url")
    )


def provenance_join(children: DataFrame, captures: DataFrame, registry: DataFrame) -> DataFrame:
    """Child captures with source, time and content hash of the capture that led there.

    children  child_source_id, parent_captured_at, …
    captures  source_id, captured_at, content_hash_sha256
    registry  id, child_source_id
    """
    parents = registry.filter(F.col("child_source_id").isNotNull()).select(
        F.col("id").alias("parent_source_id"), "child_source_id"
    )
    found = captures.select(
        F.col("source_id").alias("parent_source_id"),
        F.col("captured_at").alias("parent_captured_at"),
        F.col("content_hash_sha256").alias("parent_content_hash"),
    )
    return children.join(parents, "child_source_id").join(
        found, ["parent_source_id", "parent_captured_at"]
    )


def capture_meta(rows: DataFrame, content: str) -> DataFrame:
    """Meta columns of landed artifacts; ``content`` is the text or the bytes."""
    return rows.withColumn("content_hash_sha256", sha256_hex(F.col(content))).withColumn(
        "timings",
        F.struct(
            F.col("navigation_ms").cast("bigint").alias("navigation_ms"),
            F.col("settle_ms").cast("bigint").alias("settle_ms"),
            F.col("total_ms").cast("bigint").alias("total_ms"),
        ),
    )


def extraction_request(
    carrier: Column, source_id: Column, artifact_type: Column, text: Column, outline: Column
) -> Column:
    """Request text of one artifact; the outline part only where there is one."""
    body = F.format_string(
        "Extract FSC table data from this artifact.\n\ncarrier: %s\nsource_id: %s\nartifact_type: %s"
        "\n\nARTIFACT_TEXT:\n<<<\n%s\n>>>",
        carrier, source_id, artifact_type, text,
    )
    part = F.format_string("\n\nDOM_MAP (if present):\n<<<\n%s\n>>>", outline)
    return F.concat(body, F.when(F.coalesce(outline, F.lit("")) != "", part).otherwise(""))


def extraction_requests(
    rows: DataFrame, model: str, provider: str, system_prompt: str, created_at: Column
) -> DataFrame:
    """Add the request record of every artifact as JSON text."""
    record = F.struct(
        F.lit(model).alias("model"),
        F.lit(provider).alias("provider"),
        created_at.alias("created_at"),
        F.lit(system_prompt).alias("system_prompt"),
        extraction_request(
            canonical_carrier(F.col("carrier")), F.col("source_id"), F.col("artifact_type"),
            F.col("artifact_text"), F.col("outline"),
        ).alias("user_prompt"),
    )
    return rows.withColumn("request", F.to_json(record))


def parse_responses(rows: DataFrame, raw: str) -> DataFrame:
    """Add ``response`` (VARIANT) and ``error`` for text that is not JSON."""
    return with_json(rows, raw, "response").withColumn(
        "error", F.when(F.col("response").isNull(), "Failed to parse LLM JSON output")
    )


def invoke_provider(rows: DataFrame, invoke, schema: str) -> DataFrame:
    """Send batches of request rows through ``invoke(pandas.DataFrame)``.

    ``invoke`` is the user's extraction provider; it runs once per Arrow batch
    inside the tasks and returns a frame of ``schema``.
    """

    def run(batches):
        for batch in batches:
            yield invoke(batch)

    return rows.mapInPandas(run, schema)


def run_status(sources: DataFrame, registry: DataFrame) -> DataFrame:
    """Status and error text of each visited source; one failure stops no other.

    sources   run_id, source_id, carrier, mode, url, child_source_id, response_ok
    """
    known = registry.select(F.col("id").alias("child_source_id"), F.lit(True).alias("_child_known"))
    joined = sources.join(known.distinct(), "child_source_id", "left")
    discovery = F.col("mode") == "DISCOVERY"
    error = F.coalesce(
        F.when(
            F.coalesce("url", F.lit("")) == "",
            F.format_string("Source %s is missing a URL", "source_id"),
        ),
        F.when(
            canonical_carrier(F.col("carrier")).isNull(),
            F.format_string("Unsupported carrier: %s", "carrier"),
        ),
        F.when(~F.col("response_ok"), "Failed to parse LLM JSON output"),
        F.when(
            discovery & (F.coalesce("child_source_id", F.lit("")) == ""),
            F.format_string("Discovery source %s missing child_source_id", "source_id"),
        ),
        F.when(
            discovery & F.col("_child_known").isNull(),
            F.format_string("Child source %s not found in registry", "child_source_id"),
        ),
    )
    return (
        joined.withColumn("error", error)
        .withColumn("status", F.when(F.col("error").isNull(), "success").otherwise("error"))
        .drop("_child_known")
    )


def run_manifest(runs: DataFrame, sources: DataFrame) -> DataFrame:
    """Manifest lines: one JSON line per run (``source_id`` NULL) with its source
    counts, then one per source.

    A run is never gathered into one row, so its size has no limit.
    """
    counts = sources.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_sources"),
        F.count_if(F.col("status") == "error").alias("n_errors"),
        F.coalesce(F.sum(F.size("child_artifacts")), F.lit(0)).alias("n_children"),
    )
    head = runs.join(counts, "run_id", "left").select(
        "run_id",
        F.lit(None).cast("string").alias("source_id"),
        F.to_json(
            F.struct(
                F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
                *[c for c in runs.columns],
                *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_sources", "n_errors", "n_children")],
            )
        ).alias("line"),
    )
    fields = [c for c in sources.columns if c != "run_id"]
    body = sources.select("run_id", "source_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("line"))
    return head.unionByName(body)
