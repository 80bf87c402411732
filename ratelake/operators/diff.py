"""Change feed between a snapshot and the version before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import fixed
from ratelake.functions.dates import parse_timestamp
from ratelake.functions.keys import group_key
from ratelake.operators.ordered import prior_of_other_owner

ID = ["carrier", "source_id", "run_id", "captured_at"]


def snapshot_pairs(snapshots: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Every snapshot id with ``prior_captured_at`` and ``prior_run_id``: the
    latest strictly earlier snapshot of the same carrier and source that another
    run took (NULL for a first one).

    Times held as text are compared as instants, whatever their offsets; a text that
    is no time has no prior and is none. A source's history is walked in pieces, by
    default a month each; another ``bucket`` is an expression over the instant ``_at``.
    """
    source = ["carrier", "source_id"]
    text = snapshots.schema["captured_at"].dataType.simpleString() == "string"
    at = parse_timestamp(F.col("captured_at")) if text else F.col("captured_at")
    ids = snapshots.select(*ID).distinct().withColumn("_at", at)
    cut = F.trunc(F.col("_at").cast("date"), "month") if bucket is None else bucket
    found = prior_of_other_owner(ids, source, "_at", "run_id", cut)
    times = ids.groupBy(*source, F.col("_at").alias("prior__at"), F.col("run_id").alias("prior_run_id")).agg(
        F.min("captured_at").alias("prior_captured_at")
    )
    named = found.join(times, [*source, "prior__at", "prior_run_id"], "left")
    paired = ids.join(named, [*source, "_at", "run_id"], "left")
    return paired.select(*ID, "prior_captured_at", F.when(F.col("prior_captured_at").isNotNull(), F.col("prior_run_id")).alias("prior_run_id"))


def publishability(program: Column, effective_date: Column, structural_error: Column) -> Column:
    reasons = F.array_compact(
        F.array(
            F.when(F.coalesce(effective_date, F.lit("")) == "", "EFFECTIVE_DATE_UNKNOWN"),
            F.when(program.isNull() | (program == "unknown"), "PROGRAM_UNKNOWN"),
            F.when(structural_error, fixed.STRUCTURAL_CODE),
        )
    )
    return F.struct((F.size(reasons) == 0).alias("is_publishable"), reasons.alias("reasons"))


def merge_programs(brackets: DataFrame, id_columns: list[str]) -> DataFrame:
    """Brackets of equally named tables merged: the last one of an id wins."""
    keys = [*id_columns, "program", "bracket_id"]
    last = F.max_by(
        F.struct("index_range", "surcharge_percent"), F.struct("table_index", "bracket_index")
    )
    return brackets.groupBy(*keys).agg(last.alias("_v")).select(*keys, "_v.*")


def program_dates(tables: DataFrame, id_columns: list[str]) -> DataFrame:
    """First known effective date of each program, in table order."""
    known = F.when(F.col("effective_date").isNotNull(), F.col("table_index"))
    return tables.groupBy(*id_columns, "program").agg(
        F.min_by("effective_date", known).alias("effective_date")
    )


def _both_sides(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of each snapshot, and again, marked old, under every snapshot they precede."""
    rest = [c for c in rows.columns if c not in ID]
    old = pairs.filter(F.col("prior_captured_at").isNotNull()).select(
        "carrier",
        "source_id",
        F.col("prior_run_id").alias("run_id"),
        F.col("prior_captured_at").alias("captured_at"),
        F.col("run_id").alias("_run"),
        F.col("captured_at").alias("_at"),
    )
    before = rows.join(old, ID).select(
        "carrier",
        "source_id",
        F.col("_run").alias("run_id"),
        F.col("_at").alias("captured_at"),
        *rest,
        F.lit(False).alias("_now"),
    )
    return rows.select(*ID, *rest, F.lit(True).alias("_now")).unionByName(before)


def snapshot_diff(pairs: DataFrame, tables: DataFrame, brackets: DataFrame) -> DataFrame:
    """Delta records.

    pairs     ID, prior_run_id, prior_captured_at, structural_error
    tables    ID, program, table_index, effective_date
    brackets  ID, program, table_index, bracket_index, bracket_id, index_range,
              surcharge_percent

    Old and new values meet in one grouping by (snapshot, program, bracket) that
    is pre-aggregated before the shuffle; last-wins merging happens in the same
    step. A program only the old version has gives no rows.
    """
    value = F.struct("index_range", "surcharge_percent")
    at = F.struct("table_index", "bracket_index")
    now = F.col("_now")
    merged = (
        _both_sides(brackets, pairs)
        .groupBy(*ID, "program", "bracket_id")
        .agg(
            F.max_by(value, F.when(now, at)).alias("_new"),
            F.max_by(value, F.when(~now, at)).alias("_old"),
        )
        .withColumn("old_value", F.col("_old.surcharge_percent"))
        .withColumn("new_value", F.col("_new.surcharge_percent"))
        .filter(~F.col("old_value").eqNullSafe(F.col("new_value")))
    )
    dated = F.col("effective_date").isNotNull()
    programs = (
        _both_sides(tables, pairs)
        .groupBy(*ID, "program")
        .agg(
            F.max("_now").alias("_current"),
            F.coalesce(
                F.min_by("effective_date", F.when(now & dated, F.col("table_index"))),
                F.min_by("effective_date", F.when(~now & dated, F.col("table_index"))),
            ).alias("effective_date"),
        )
        .filter("_current")
        .drop("_current")
        # One row per program: the changed brackets then need a single join.
        .join(pairs.select(*ID, "prior_captured_at", "structural_error"), ID)
    )
    joined = _null_safe_join(merged, programs, ID, "program")
    program, day, broken = F.col("program"), F.col("effective_date"), F.col("structural_error")
    return joined.select(
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
        *ID,
        "prior_captured_at",
        "program",
        "effective_date",
        "bracket_id",
        F.coalesce("_new.index_range", "_old.index_range").alias("index_range"),
        "old_value",
        "new_value",
        group_key(F.col("carrier"), program, day).alias("group_key"),
        publishability(program, day, broken).alias("publishability"),
        broken.alias("parser_structural_error"),
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], nullable: str) -> DataFrame:
    """Inner join on ``keys`` and the null-safe ``nullable``; right adds its other columns."""
    r = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in [*keys, nullable]],
        *[c for c in right.columns if c not in [*keys, nullable]],
    )
    on = [F.col(k) == F.col(f"_r_{k}") for k in keys]
    on.append(F.col(nullable).eqNullSafe(F.col(f"_r_{nullable}")))
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return left.join(r, condition).drop(*[f"_r_{k}" for k in [*keys, nullable]])
