"""Range texts, percent texts and bracket lookup inside one table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelake import fixed
from ratelake.functions.binding import let
from ratelake.functions.dates import warning
from ratelake.functions.numbers import two_decimals
from ratelake.functions.text import collapse_whitespace

BOUNDED, OPEN_HIGH, AT_LEAST, OPEN_LOW = fixed.BOUNDED, fixed.OPEN_HIGH, fixed.AT_LEAST, fixed.OPEN_LOW
NUMBER_PREFIX = fixed.NUMBER_PREFIX


def clean_range_text(text: Column) -> Column:
    hyphens = F.regexp_replace(text, fixed.DASHES, "-")
    return collapse_whitespace(F.lower(F.regexp_replace(hyphens, "[$,]", "")))


def fallback_bracket_id(text: Column) -> Column:
    slug = F.replace(clean_range_text(text), F.lit(" "), F.lit("_"))
    return F.coalesce(F.nullif(slug, F.lit("")), F.when(text.isNotNull(), "unknown_range"))


def _number(found: Column) -> Column:
    """A matched text as a number. Where nothing matched there is none: casting the empty text
    gives none as well, but by an exception for every row."""
    return let(found, lambda t: F.when(t != "", t).try_cast("double"))


def _group(text: Column, pattern: str, index: int) -> Column:
    return _number(F.regexp_extract(text, pattern, index))


def parse_range_text(text: Column) -> Column:
    """Struct (low, high, bracket_id, parsed); patterns are tried in a fixed order, the next
    one only where those before it found nothing."""
    null = F.lit(None).cast("double")

    def result(low: Column, high: Column, bracket_id: Column, parsed: bool) -> Column:
        return F.struct(
            low.alias("low"), high.alias("high"), bracket_id.alias("bracket_id"), F.lit(parsed).alias("parsed")
        )

    def bounded(low: Column, clean: Column) -> Column:
        return let(_group(clean, BOUNDED, 2), lambda high: result(
            low, high, F.concat(two_decimals(low), F.lit("_"), two_decimals(high)), True
        ))

    def above(low: Column, clean: Column) -> Column:
        return F.when(low.isNotNull(), result(low, null, F.concat(two_decimals(low), F.lit("_plus")), True)).otherwise(
            let(_group(clean, OPEN_LOW, 1), below)
        )

    def below(high: Column) -> Column:
        return F.when(high.isNotNull(), result(null, high, F.concat(F.lit("lt_"), two_decimals(high)), True)).otherwise(
            result(null, null, fallback_bracket_id(text), False)
        )

    def choose(clean: Column) -> Column:
        return let(_group(clean, BOUNDED, 1), lambda low: F.when(low.isNotNull(), bounded(low, clean)).otherwise(
            let(F.coalesce(_group(clean, OPEN_HIGH, 1), _group(clean, AT_LEAST, 1)), lambda n: above(n, clean))
        ))

    return let(clean_range_text(text), choose)


def range_warning(text: Column) -> Column:
    return warning("RANGE_PARSE_FAILED", F.concat(F.lit("Could not parse range: "), text))


def parse_percent_text(text: Column) -> Column:
    """Leading number of the text without ``%``, spaces and commas; NULL if none."""
    clean = F.regexp_replace(text, f"[%,]|{fixed.WHITESPACE}", "")
    return _number(F.regexp_extract(clean, NUMBER_PREFIX, 0))


def percent_warning(text: Column) -> Column:
    return warning("PERCENT_PARSE_FAILED", F.concat(F.lit("Could not parse percent: "), text))


def in_bracket(price: Column, low: Column, high: Column) -> Column:
    """low <= price < high + epsilon; a NULL bound is open."""
    return F.coalesce(price >= low, F.lit(True)) & F.coalesce(
        price < high + F.lit(fixed.BRACKET_EPSILON), F.lit(True)
    )


def lookup_bracket(brackets: Column, price: Column) -> Column:
    """First matching element of an array of (min_index, max_index, …); NULL if none.

    Works on the table's own nested array, so it needs no shuffle and no join.
    """
    hits = F.filter(brackets, lambda b: in_bracket(price, b["min_index"], b["max_index"]))
    return F.when(price.isNotNull(), F.get(hits, F.lit(0)))
