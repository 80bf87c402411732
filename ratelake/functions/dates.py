"""Dates and timestamps held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelake import fixed

_WS = fixed.WHITESPACE
_MONTH_NUMBER = {name: f"{i:02d}" for i, name in enumerate(fixed.MONTH_NAMES, start=1)}
_MONTH_NUMBER.update({name[:3]: number for name, number in list(_MONTH_NUMBER.items())})
_MONTH_NUMBER.update(fixed.EXTRA_MONTH_ABBREVIATIONS)

NAMED_DATE = (
    f"(?i)({'|'.join(sorted(_MONTH_NUMBER, key=len, reverse=True))})"
    rf"\.?{_WS}+(\d{{1,2}})(?:st|nd|rd|th)?,?{_WS}+(\d{{4}})"
)
NUMERIC_DATE = r"(?<![0-9A-Za-z_])(\d{1,2})[/\-](\d{1,2})[/\-](\d{4})(?![0-9A-Za-z_])"


def _month_number(name: Column) -> Column:
    pairs = [F.lit(v) for kv in _MONTH_NUMBER.items() for v in kv]
    return F.element_at(F.create_map(*pairs), F.lower(name))


def _iso(pattern: str, text: Column, year: int, month: Column, day: int) -> Column:
    return F.when(
        F.regexp_extract(text, pattern, 0) != "",
        F.concat_ws(
            "-",
            F.regexp_extract(text, pattern, year),
            month,
            F.lpad(F.regexp_extract(text, pattern, day), 2, "0"),
        ),
    )


def parse_date_text(text: Column) -> Column:
    """``yyyy-MM-dd`` text, or NULL. Day and month ranges are not checked."""
    named = _iso(NAMED_DATE, text, 3, _month_number(F.regexp_extract(text, NAMED_DATE, 1)), 2)
    numeric = _iso(
        NUMERIC_DATE, text, 3, F.lpad(F.regexp_extract(text, NUMERIC_DATE, 1), 2, "0"), 2
    )
    return F.coalesce(named, numeric)


def date_warning(text: Column, date: Column | None = None) -> Column:
    """Warning struct when no date could be read, else NULL; ``date`` is what was read of it."""
    message = (
        F.when(F.coalesce(text, F.lit("")) == "", "Effective date was missing.")
        .otherwise(F.concat(F.lit("Could not normalize effective date: "), text))
    )
    return F.when(
        (parse_date_text(text) if date is None else date).isNull(), warning("MISSING_EFFECTIVE_DATE", message)
    )


def warning(code: str, message: Column, severity: str = "warning") -> Column:
    return F.struct(
        F.lit(code).alias("code"), message.alias("message"), F.lit(severity).alias("severity")
    )


def parse_timestamp(text: Column) -> Column:
    """Timestamp, or NULL when the text is not one."""
    return text.try_cast("timestamp")


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def file_safe(iso: Column) -> Column:
    return F.replace(iso, F.lit(":"), F.lit("-"))


def valid_date(text: Column) -> Column:
    """Date for comparisons; NULL when the text is not a calendar day."""
    return text.try_cast("date")
