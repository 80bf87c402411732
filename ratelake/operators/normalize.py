"""Candidates → snapshots and validation reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import fixed, schemas
from ratelake.functions.binding import let, with_once
from ratelake.functions.brackets import (
    parse_percent_text,
    parse_range_text,
    percent_warning,
    range_warning,
)
from ratelake.functions.dates import date_warning, parse_date_text, warning
from ratelake.operators.gate import gate

_WARNINGS = f"array<{schemas.WARNING}>"
CONTEXT = ["carrier", "source_id", "captured_at", "source_url", "content_type"]


def scope_warnings(candidate: Column, carrier: Column, source_id: Column) -> Column:
    """Carrier (case-insensitive) and source_id (exact) must match the context."""

    def mismatch(what: str, got: Column, wanted: Column) -> Column:
        return warning(
            "SCOPE_AMBIGUOUS",
            F.concat(F.lit(f"Candidate {what} "), got, F.lit(" did not match "), wanted),
        )

    return F.array_compact(
        F.array(
            F.when(
                F.lower(candidate["carrier"]) != F.lower(carrier),
                mismatch("carrier", candidate["carrier"], carrier),
            ),
            F.when(
                candidate["source_id"] != source_id,
                mismatch("source_id", candidate["source_id"], source_id),
            ),
        )
    )


def read_brackets(programs: Column) -> Column:
    """Programs with their brackets read once: (range_text, percent_text, range, percent)."""

    def bracket(b: Column) -> Column:
        return F.struct(
            b["range_text"].alias("range_text"), b["percent_text"].alias("percent_text"),
            parse_range_text(b["range_text"]).alias("range"), parse_percent_text(b["percent_text"]).alias("percent"),
        )

    return F.transform(
        programs, lambda p: F.struct(p["program"].alias("program"), F.transform(p["brackets"], bracket).alias("brackets"))
    )


def bracket_warnings(programs: Column) -> Column:
    """Of read brackets in order: the range first, then the percent."""

    def of_bracket(b: Column) -> Column:
        return F.array_compact(
            F.array(
                F.when(~b["range"]["parsed"], range_warning(b["range_text"])),
                F.when(b["percent"].isNull(), percent_warning(b["percent_text"])),
            )
        )

    return F.flatten(
        F.transform(programs, lambda p: F.flatten(F.transform(p["brackets"], of_bracket)))
    )


def has_structural_warning(warnings: Column) -> Column:
    return F.exists(warnings, lambda w: w["code"] == fixed.STRUCTURAL_CODE)


def structural_error(warnings: Column, programs: Column) -> Column:
    return has_structural_warning(warnings) | (F.size(programs) == 0)


def warning_messages(warnings: Column) -> Column:
    return F.transform(
        warnings, lambda w: F.trim(F.concat(w["code"], F.lit(": "), w["message"]))
    )


def normal_tables(programs: Column, effective_date: Column) -> Column:
    """Tables of read brackets."""

    def bracket(b: Column) -> Column:
        return F.struct(
            b["range"]["bracket_id"].alias("bracket_id"),
            b["range_text"].alias("index_range"),
            b["range"]["low"].alias("min_index"),
            b["range"]["high"].alias("max_index"),
            b["percent"].alias("surcharge_percent"),
            b["percent_text"].alias("surcharge_text"),
        )

    return F.transform(
        programs,
        lambda p: F.struct(
            p["program"].alias("program"),
            effective_date.alias("effective_date"),
            F.transform(p["brackets"], bracket).alias("brackets"),
        ),
    )


def typed_candidate(doc: Column) -> Column:
    """A gated VARIANT as a typed candidate, missing lists read as empty ones."""

    def complete(c: Column) -> Column:
        programs = F.transform(
            F.coalesce(c["programs"], F.array()),
            lambda p: p.withField("brackets", F.coalesce(p["brackets"], F.array())),
        )
        return (
            c.withField("programs", programs)
            .withField("links", F.coalesce(c["links"], F.array()))
            .withField("parse_warnings", F.coalesce(c["parse_warnings"], F.array()))
        )

    return let(F.try_variant_get(doc, "$", f"struct<{schemas.CANDIDATE}>"), complete)


def candidates(df: DataFrame, raw: str) -> DataFrame:
    """Gate the JSON text in ``raw``; adds ``valid``, ``issues`` and the typed
    ``candidate`` (NULL when invalid)."""
    gated = gate(df, raw).withColumn("valid", F.size("issues") == 0)
    return with_once(gated, "candidate", F.when(F.col("valid"), typed_candidate(F.col("doc")))).drop("doc")


def normalize(df: DataFrame, raw: str) -> DataFrame:
    """Add ``snapshot`` and ``report`` structs for every candidate text in ``raw``.

    ``df`` carries the context columns carrier, source_id, captured_at,
    source_url and content_type. No shuffle.
    """
    c = F.col("candidate")
    empty_warnings = F.array().cast(_WARNINGS)
    staged = (
        with_once(candidates(df, raw), "_read", F.struct(
            read_brackets(c["programs"]).alias("programs"), parse_date_text(c["effective_date"]).alias("date")
        ))
        .withColumn("_date", F.col("_read.date"))
        .withColumn("_has_flag", has_structural_warning(c["parse_warnings"]))
        .withColumn(
            "_found",
            F.when(
                F.col("valid"),
                F.concat(
                    scope_warnings(c, F.col("carrier"), F.col("source_id")),
                    F.array_compact(F.array(date_warning(c["effective_date"], F.col("_date")))),
                    bracket_warnings(F.col("_read.programs")),
                    F.when(
                        F.size(c["programs"]) == 0,
                        F.array(warning("TABLE_NOT_FOUND", F.lit(fixed.NO_PROGRAMS_MESSAGE), "error")),
                    ).otherwise(empty_warnings),
                ),
            ).otherwise(empty_warnings),
        )
    )
    structural = ~F.col("valid") | F.col("_has_flag") | (F.size(c["programs"]) == 0)
    schema_messages = F.concat(
        F.transform(
            "issues",
            lambda e: F.concat(F.lit("SCHEMA_ERROR: "), e["path"], F.lit(" "), e["message"]),
        ),
        F.array(F.lit(fixed.GATE_FAILED_MESSAGE)),
    )
    messages = F.concat(
        warning_messages(c["parse_warnings"]),
        warning_messages(F.col("_found")),
        F.when(structural & ~F.col("_has_flag"), F.array(F.lit(fixed.STRUCTURE_FAILED_MESSAGE)))
        .otherwise(F.array().cast("array<string>")),
    )
    tables = F.when(F.col("valid"), normal_tables(F.col("_read.programs"), F.col("_date"))).otherwise(
        F.array().cast(f"array<{schemas.TABLE}>")
    )
    snapshot = F.struct(
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
        *[F.col(name) for name in CONTEXT],
        F.col("_date").alias("effective_date"),
        tables.alias("tables"),
        F.struct(
            structural.alias("structural_error"),
            F.when(F.col("valid"), messages).otherwise(schema_messages).alias("messages"),
        ).alias("parser_diagnostics"),
    )
    report = F.struct(
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
        F.col("valid").alias("candidate_valid"),
        F.col("issues").alias("errors"),
        F.coalesce(c["parse_warnings"], empty_warnings).alias("candidate_warnings"),
        F.col("_found").alias("normalization_warnings"),
        structural.alias("structural_error"),
        F.coalesce(F.size(c["programs"]), F.lit(0)).alias("table_count"),
        F.col("_date").alias("effective_date"),
    )
    return (
        staged.withColumn("snapshot", snapshot)
        .withColumn("report", report)
        .drop("_date", "_has_flag", "_found", "_read")
    )


def positions(df: DataFrame, array: Column, others: list, names: tuple[str, str]) -> DataFrame:
    """One row per array element with its position.

    An outer explode with a filter on its output: for a plain one the optimizer
    adds a size check below, which computes the array expression twice.
    """
    rows = df.select(*others, F.posexplode_outer(array).alias(*names))
    return rows.filter(F.col(names[0]).isNotNull())


def flatten_tables(snapshots: DataFrame, snapshot: str = "snapshot") -> DataFrame:
    """One row per table with its position, brackets still nested.

    ``effective_date`` is the table's own, else the snapshot's.
    """
    s = F.col(snapshot)
    others = [c for c in snapshots.columns if c != snapshot]
    return (
        positions(
            snapshots, s["tables"], [*others, s["effective_date"].alias("_date")], ("table_index", "_t")
        )
        .withColumn("program", F.col("_t.program"))
        .withColumn(
            "effective_date", F.coalesce(F.col("_t.effective_date"), F.col("_date"))
        )
        .withColumn("bracket_count", F.size("_t.brackets"))
        .withColumn("brackets", F.col("_t.brackets"))
        .drop("_date", "_t")
    )


def flatten_brackets(tables: DataFrame) -> DataFrame:
    """One row per bracket with its position inside the table."""
    others = [c for c in tables.columns if c not in ("brackets", "bracket_count")]
    rows = positions(tables, F.col("brackets"), others, ("bracket_index", "_b"))
    return rows.select(*others, "bracket_index", "_b.*")
