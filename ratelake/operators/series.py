"""Price series: landed responses → rows of the raw price table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake import fixed
from ratelake.functions.numbers import to_decimal
from ratelake.operators.gate import json_type, with_json
from ratelake.operators.keyed import absent_rows
from ratelake.operators.normalize import positions
from ratelake.schemas import KEYS


def response_rows(responses: DataFrame, raw: str, series_id: str = "series_id") -> DataFrame:
    """Rows of landed API responses: one per element of ``response.data``.

    Responses of another shape give no rows; see :func:`bad_responses`. Units and
    description are kept only where they are JSON strings.
    """
    responses = with_json(responses, raw, raw)
    data = F.try_variant_get(raw, "$.response.data", "array<variant>")

    def text_only(row: Column, path: str) -> Column:
        v = F.try_variant_get(row, path, "variant")
        return F.when(json_type(v) == "string", F.try_variant_get(v, "$", "string"))

    others = [c for c in responses.columns if c != raw]
    rows = positions(responses, data, others, ("_pos", "_r"))
    r = F.col("_r")
    return rows.select(
        F.col(series_id).alias("series_id"),
        F.try_variant_get(r, "$.period", "string").alias("period"),
        F.try_variant_get(r, "$.value", "string").try_cast("double").alias("value"),
        text_only(r, "$.units").alias("units"),
        text_only(r, "$['series-description']").alias("description"),
        *[c for c in others if c != series_id],
    )


def bad_responses(responses: DataFrame, raw: str) -> DataFrame:
    parsed = with_json(responses, raw, "_doc")
    data = F.try_variant_get("_doc", "$.response.data", "array<variant>")
    return parsed.filter(data.isNull()).drop("_doc").withColumn("error", F.lit("Unexpected response shape"))


def with_ingest_defaults(rows: DataFrame) -> DataFrame:
    return rows.withColumn("units", F.coalesce("units", F.lit(""))).withColumn(
        "description", F.coalesce("description", "series_id")
    )


def series_slice(
    rows: DataFrame, start: str | None = None, end: str | None = None, length: int | None = None
) -> DataFrame:
    """Rows of each series between two periods (text, inclusive); with ``length`` the
    newest so many of each."""
    if start is not None:
        rows = rows.filter(F.col("period") >= start)
    if end is not None:
        rows = rows.filter(F.col("period") <= end)
    if length is None:
        return rows
    w = Window.partitionBy("series_id").orderBy(F.col("period").desc())
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= length).drop("_n")


def ingest_series(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """New price rows: defaults, fixed scale, insert-if-absent by (series, period)."""
    ready = with_ingest_defaults(rows).withColumn("value", to_decimal(F.col("value")))
    ready = ready.filter(F.col("value").isNotNull())
    return absent_rows(existing, ready, KEYS["fuel_prices"], [F.col("value").asc()])
