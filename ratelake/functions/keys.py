"""Text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def group_key(carrier: Column, program: Column, effective_date: Column) -> Column:
    day = F.when(effective_date != "", effective_date)
    return F.concat_ws(
        "-",
        F.coalesce(F.left(day, F.lit(4)), F.lit("unknown")),
        F.lit("fuel_surcharge"),
        F.coalesce(effective_date, F.lit("unknown")),
        carrier,
        F.coalesce(program, F.lit("unknown")),
    )


def snapshot_key(carrier: Column, source_id: Column, captured_at: Column) -> Column:
    return F.concat_ws("::", carrier, source_id, captured_at)
