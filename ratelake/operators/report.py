"""Weekly report as text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.functions.numbers import format_percent, format_price
from ratelake.operators.keyed import first_per_key
from ratelake.operators.ordered import previous_row


def latest_week(applied: DataFrame) -> DataFrame:
    """One row with the newest week; none when nothing was applied."""
    return applied.agg(F.max("week_ending_date").alias("week")).filter(F.col("week").isNotNull())


def upcoming_tables(snapshots: DataFrame, week: DataFrame, snapshot: str = "snapshot") -> DataFrame:
    """Tables whose own date (compared as text) lies after the week; the newest
    capture of every (source, table position) wins."""
    s = F.col(snapshot)
    rows = snapshots.select(
        "source_id", "run_id", "captured_at",
        s["carrier"].alias("carrier"),
        F.posexplode(s["tables"]).alias("table_index", "_t"),
    ).select("*", F.col("_t.program").alias("program"), F.col("_t.effective_date").alias("effective_date"))
    future = rows.drop("_t").filter(F.col("effective_date") > week.select("week").scalar())
    return first_per_key(
        future, ["source_id", "table_index"],
        [F.col("captured_at").desc(), F.col("run_id").asc()],
    ).select("carrier", "program", "effective_date", "source_id", "table_index")


def week_events(applied: DataFrame, week: DataFrame) -> DataFrame:
    """Rows of the newest week with the percent of the week before it."""
    with_prior = previous_row(applied, ["carrier", "program"], "week_ending_date", ["applied_percent"])
    return with_prior.filter(F.col("week_ending_date") == week.select("week").scalar())


def report_lines(applied: DataFrame, upcoming: DataFrame) -> DataFrame:
    """Lines (section, sort_key, line_no, line) in report order.

    The newest week enters as a scalar subquery; the lines are ordered by a
    distributed sort and can be written as text as they are.
    """
    week = latest_week(applied)

    def lines(df: DataFrame, section: int, sort_key, texts: list) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"),
            sort_key.alias("sort_key"),
            F.posexplode(F.array(*texts)).alias("line_no", "line"),
        )

    head = lines(
        week, 0, F.lit(""),
        [F.format_string("# Weekly Carrier Pricing Events (%s)", "week"), F.lit(""), F.lit("## Events"), F.lit("")],
    )
    events = lines(
        week_events(applied, week), 1, F.concat_ws("|", "carrier", "program"),
        [
            F.format_string(
                "- FSC | %s | %s | Week: %s | cause: %s", "carrier", "program", "week_ending_date", "reason"
            ),
            F.format_string(
                "  - old_charge: %s | new_charge: %s | bracket: %s | table_eff: %s",
                format_percent(F.col("prior_applied_percent").cast("double")),
                format_percent(F.col("applied_percent").cast("double")),
                F.coalesce("bracket_range", "bracket_id", F.lit("n/a")),
                F.col("table_effective_date"),
            ),
            F.format_string(
                "  - fuel: %s %s",
                F.coalesce("fuel_index", F.lit("fuel")),
                format_price(F.col("fuel_price").cast("double")),
            ),
            F.lit(""),
        ],
    )
    some = upcoming.agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    coming_head = lines(some, 2, F.lit(""), [F.lit("## Upcoming Changes"), F.lit("")])
    coming = lines(
        upcoming, 3, F.format_string("%s|%08d", "source_id", "table_index"),
        [
            F.format_string(
                "- %s | %s | effective: %s | source: %s",
                F.col("carrier"),
                F.coalesce("program", F.lit("unknown")),
                F.coalesce("effective_date", F.lit("n/a")),
                F.col("source_id"),
            )
        ],
    )
    every = head.unionByName(events).unionByName(coming_head).unionByName(coming)
    return every.orderBy("section", "sort_key", "line_no")

