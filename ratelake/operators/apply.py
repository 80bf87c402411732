"""The rate that applies to each price, and why it changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import fixed
from ratelake.functions.brackets import lookup_bracket
from ratelake.functions.dates import valid_date
from ratelake.functions.numbers import is_finite, to_decimal, to_finite
from ratelake.operators.keyed import absent_rows, first_per_key
from ratelake.operators.normalize import flatten_tables
from ratelake.operators.ordered import asof_join, previous_row
from ratelake.schemas import KEYS


def latest_price(prices: DataFrame, series: list[str] | None = None) -> DataFrame:
    """The newest row of each series; a newest value that is no number drops out."""
    wanted = prices if series is None else prices.filter(F.col("series_id").isin(series))
    newest = first_per_key(wanted, ["series_id"], [F.col("period").desc(), F.col("value").desc()])
    return finite_prices(newest)


def finite_prices(prices: DataFrame) -> DataFrame:
    return prices.withColumn("value", to_finite(F.col("value"))).filter(F.col("value").isNotNull())


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Newest snapshot of every source over all runs; ids must be unique.

    The newest is picked on ids alone, and only the picked rows' payload moves.
    """
    ids = snapshots.select("source_id", "captured_at", "run_id")
    newest = first_per_key(ids, ["source_id"], [F.col("captured_at").desc(), F.col("run_id").asc()])
    return snapshots.join(newest, ["source_id", "captured_at", "run_id"], "left_semi")


def rate_tables(snapshots: DataFrame, snapshot: str = "snapshot") -> DataFrame:
    """Tables of the newest snapshots; a table without program takes the carrier's name."""
    flat = flatten_tables(latest_snapshot(snapshots), snapshot)
    return flat.withColumn("program", F.coalesce("program", "carrier"))


def program_of(series: Column, mapping: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for name, program in mapping.items():
        out = F.when(series == name, program).otherwise(out)
    return out


def series_program_cross(
    prices: DataFrame, mapping: dict[str, str], carriers: list[str]
) -> DataFrame:
    """Every price with its program, once per carrier; unmapped series drop out."""
    return (
        prices.withColumn("program", program_of(F.col("series_id"), mapping))
        .filter(F.col("program").isNotNull())
        .withColumn("carrier", F.explode(F.array(*[F.lit(c) for c in carriers])))
    )


def tables_in_force(demand: DataFrame, tables: DataFrame) -> DataFrame:
    """Inclusive as-of join of priced weeks with table effective dates.

    Carrier and program match case-insensitively. Ties of one date go to the
    smallest source_id, then the first table. The windows run over calendar days
    per carrier and program, which bounds them whatever the data volume.
    """
    left = demand.select(
        "*",
        F.lower("carrier").alias("_carrier"),
        F.lower("program").alias("_program"),
        valid_date(F.col("period")).alias("_day"),
    )
    right = tables.select(
        F.lower("carrier").alias("_carrier"),
        F.lower("program").alias("_program"),
        valid_date(F.col("effective_date")).alias("_from"),
        F.col("effective_date").alias("table_effective_date"),
        F.col("source_id").alias("table_source_id"),
        "table_index",
        F.col("run_id").alias("source_run_id"),
        "brackets",
    )
    return asof_join(
        left,
        right,
        ["_carrier", "_program"],
        "_day",
        "_from",
        [F.col("table_source_id").asc(), F.col("table_index").asc(), F.col("source_run_id").asc()],
        how="inner",
    ).drop("_carrier", "_program", "_day", "_from")


def change_reason(prior_date: Column, date: Column, prior_id: Column, bracket_id: Column) -> Column:
    """``prior_date`` is NULL exactly when there is no earlier row."""
    table, tier = ~prior_date.eqNullSafe(date), ~prior_id.eqNullSafe(bracket_id)
    return (
        F.when(prior_date.isNull(), "new")
        .when(table & tier, "both")
        .when(table, "table_change")
        .when(tier, "fuel_tier_change")
        .otherwise("no_change")
    )


def with_reason(applied: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Add ``reason`` against the previous week of the same carrier and program.

    Without ``history`` the weeks of ``applied`` itself are compared in one pass;
    with it, each row is compared with the newest earlier stored week.
    """
    compared = ["table_effective_date", "bracket_id"]
    pair = ["carrier", "program"]
    if history is None:
        out = previous_row(applied, pair, "week_ending_date", compared)
    else:
        stored = history.select(
            *pair, F.col("week_ending_date").alias("_week"), *[F.col(c).alias(f"prior_{c}") for c in compared]
        )
        out = asof_join(
            applied, stored, pair, "week_ending_date", "_week",
            [F.col("prior_bracket_id")], inclusive=False,
        ).drop("_week")
    reason = change_reason(
        F.col("prior_table_effective_date"), F.col("table_effective_date"),
        F.col("prior_bracket_id"), F.col("bracket_id"),
    )
    return out.withColumn("reason", reason).drop(*[f"prior_{c}" for c in compared])


def apply_rates(
    prices: DataFrame,
    tables: DataFrame,
    mapping: dict[str, str] = fixed.SERIES_PROGRAM,
    carriers: list[str] = tuple(fixed.CARRIERS),
    history: DataFrame | None = None,
) -> DataFrame:
    """Price → table in force → bracket → percent, with the reason of the change.

    ``prices`` series_id, period, value; ``tables`` as from :func:`rate_tables`.
    Prices without a table or a bracket drop out. If two series drive one
    program, the first series of a week is kept, as the stored key demands.
    """
    demand = series_program_cross(finite_prices(prices), mapping, list(carriers))
    demand = first_per_key(demand, ["carrier", "program", "period"], [F.col("series_id")])
    found = tables_in_force(demand, tables).withColumn(
        "_b", lookup_bracket(F.col("brackets"), F.col("value"))
    )
    percent = F.col("_b.surcharge_percent")
    applied = found.filter(F.col("_b").isNotNull()).select(
        "carrier",
        "program",
        F.col("period").alias("week_ending_date"),
        F.coalesce("table_effective_date", F.lit("")).alias("table_effective_date"),
        F.col("_b.bracket_id").alias("bracket_id"),
        F.col("_b.index_range").alias("bracket_range"),
        F.coalesce(to_decimal(percent, 8), F.lit(0).cast("decimal(8,4)")).alias("applied_percent"),
        (percent.isNull() | ~is_finite(percent)).alias("percent_missing"),
        to_decimal(F.col("value")).alias("fuel_price"),
        F.col("series_id").alias("fuel_index"),
        "source_run_id",
    )
    return with_reason(applied, history)


def store_applied(history: DataFrame, applied: DataFrame) -> DataFrame:
    """New rows for the stored table: insert-if-absent by carrier, program and week."""
    return absent_rows(
        history.select(*KEYS["applied_rates"]), applied, KEYS["applied_rates"], [F.col("fuel_index")]
    )
