"""Numbers: safe parsing, tolerance, formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelake import fixed


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def to_finite(x: Column) -> Column:
    """Double, or NULL for anything unparsable, NaN or infinite."""
    d = x.try_cast("double")
    return F.when(is_finite(d), d)


def within_tolerance(a: Column, b: Column, tolerance: float = fixed.VALUE_TOLERANCE) -> Column:
    """Both NULL: true; one NULL: false; else |a - b| <= tolerance, on doubles."""
    return F.coalesce(
        F.abs(a.cast("double") - b.cast("double")) <= tolerance, a.isNull() & b.isNull()
    )


def fixed_decimals(x: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, rounded from the exact binary value of the
    double (2.675 is a little less and gives 2.67); exact halves go away from zero.

    A half at this digit is exactly representable only as an odd multiple of
    1 / 2^(digits + 1); such a value is moved off the half before formatting.
    """
    value = x.cast("double")
    scaled = value * float(2 ** (digits + 1))
    half = (F.abs(scaled) < 2.0**52) & (F.floor(scaled) == scaled) & (F.pmod(scaled, F.lit(2.0)) == 1)
    moved = value + F.when(half, F.signum(value) * 10.0 ** -(digits + 2)).otherwise(F.lit(0.0))
    return F.call_function("format_number", moved, F.lit("0." + "0" * digits))


def two_decimals(x: Column) -> Column:
    return fixed_decimals(x, 2)


def format_percent(x: Column) -> Column:
    return F.coalesce(F.concat(fixed_decimals(x, 2), F.lit("%")), F.lit("n/a"))


def format_price(x: Column) -> Column:
    return F.coalesce(F.concat(F.lit("$"), fixed_decimals(x, 3)), F.lit("n/a"))


def to_decimal(x: Column, precision: int = 12, scale: int = 4) -> Column:
    """Fixed-scale number at the sink; NULL stays NULL."""
    return x.try_cast(f"decimal({precision},{scale})")
