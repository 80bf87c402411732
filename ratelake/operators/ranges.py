"""Bracket lookup as a join, for flat bracket tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake import fixed
from ratelake.operators.keyed import first_per_key


_FAR = 1e300  # bounds and values beyond are compared one by one


def _first_open(points: DataFrame, rows: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """Of the one-sided brackets whose bound ``_at`` is not above a point's ``_at``: the
    smallest position, found by carrying it along the ordered bounds and points.

    ``rows`` hold (keys, _at, position), ``points`` (keys, value, _at, _open): an _open
    point does not take bounds equal to it. A key is walked in pieces of its values;
    the smallest position of every piece, one row each, is carried over.
    """
    none = F.lit(None)
    both = rows.select(*keys, "_at", position, F.lit(1).alias("_turn"), none.cast("double").alias(value)).unionByName(
        points.select(
            *keys, "_at", none.cast(rows.schema[position].dataType).alias(position),
            F.when(F.col("_open"), 0).otherwise(2).alias("_turn"), F.col(value).cast("double").alias(value),
        )
    ).withColumn("_piece", F.floor("_at"))
    parts = [*keys, "_piece"]
    within = Window.partitionBy(*parts).orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    least = both.groupBy(*parts).agg(F.min(position).alias("_least"))
    carried = least.select(*parts, F.min("_least").over(before).alias("_carried"))
    walked = both.withColumn("_here", F.min(position).over(within)).filter(F.col(value).isNotNull())
    found = walked.join(carried, parts).withColumn(position, F.least("_here", "_carried"))
    return found.filter(F.col(position).isNotNull()).select(*keys, value, position)


def range_lookup(
    facts: DataFrame,
    brackets: DataFrame,
    keys: list[str],
    value: str,
    low: str,
    high: str,
    position: str,
) -> DataFrame:
    """Bracket ``position`` that holds each distinct (keys, value) of ``facts``:
    the smallest position with low <= value < high + epsilon (NULL bounds open).

    No value meets the brackets it lies in one by one, so brackets that overlap cost no
    more than others. Closed brackets are filed under the power of two just above their
    width, in bins of a quarter of it: each covers some bins, ends in one and begins in
    another, and there it is one-sided. A value probes the bins that hold brackets, one of
    each level. One-sided brackets are carried along the ordered values. Brackets of equal
    bounds are merged first. Only brackets with an infinite bound or NaN meet every value
    of their table.
    """
    points = facts.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    distinct = brackets.groupBy(*keys, low, high).agg(F.min(position).alias(position))

    end = F.col(high).cast("double") + fixed.BRACKET_EPSILON
    inside = (F.col(low) <= F.col(value)) & (F.col(value) < F.col(high) + fixed.BRACKET_EPSILON)
    closed = distinct.filter(F.col(low).isNotNull() & F.col(high).isNotNull())
    finite = (F.abs(F.col(low).cast("double")) < _FAR) & (F.abs(end) < _FAR)
    far_hits = points.join(closed.filter(~finite), keys).filter(inside).select(*keys, value, position)

    width = end - F.col(low).cast("double")
    size = F.pow(F.lit(2.0), F.col("_level").cast("double"))

    def bin_of(x: Column) -> Column:
        return F.floor(x.cast("double") / size)

    filed = (
        closed.filter(finite & (width > 0)).withColumn("_level", F.ceil(F.log2(width)).cast("int") - 2)
        .withColumn("_first", bin_of(F.col(low))).withColumn("_last", bin_of(end))
        .withColumn("_bin", F.explode(F.sequence("_first", "_last")))
    )
    cells = [*keys, "_level", "_bin"]
    covers = (F.col("_first") < F.col("_bin")) & (F.col("_bin") < F.col("_last"))
    bins = filed.groupBy(*cells).agg(F.min(F.when(covers, F.col(position))).alias(position))
    levels = bins.groupBy(*keys).agg(F.collect_set("_level").alias("_levels"))
    probes = (
        points.filter(F.abs(F.col(value).cast("double")) < _FAR).join(levels, keys)
        .withColumn("_level", F.explode("_levels"))
        .withColumn("_bin", bin_of(F.col(value)))
        .drop("_levels")
        .join(bins, cells)
    )
    covered = probes.filter(F.col(position).isNotNull()).select(*keys, value, position)
    probes = probes.drop(position)
    begun = filed.filter(F.col("_bin") == F.col("_first")).withColumn("_at", F.col(low).cast("double"))
    ended = filed.filter(F.col("_bin") == F.col("_last")).withColumn("_at", -end)

    rising = distinct.filter(F.col(low).isNotNull() & F.col(high).isNull()).withColumn("_at", F.col(low).cast("double"))
    falling = distinct.filter(F.col(low).isNull() & F.col(high).isNotNull()).withColumn(
        "_at", -(F.col(high).cast("double") + fixed.BRACKET_EPSILON)
    )
    everything = distinct.filter(F.col(low).isNull() & F.col(high).isNull())

    def upward(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_at", F.col(value).cast("double")).withColumn("_open", F.lit(False))

    def downward(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_at", -F.col(value).cast("double")).withColumn("_open", F.lit(True))

    of_type = lambda df: df.withColumn(value, F.col(value).cast(points.schema[value].dataType))
    hits = (
        of_type(_first_open(upward(points), rising, keys, value, position))
        .unionByName(of_type(_first_open(downward(points), falling, keys, value, position)))
        .unionByName(points.join(everything, keys).select(*keys, value, position))
        .unionByName(covered)
        .unionByName(of_type(_first_open(upward(probes), begun, cells, value, position)).select(*keys, value, position))
        .unionByName(of_type(_first_open(downward(probes), ended, cells, value, position)).select(*keys, value, position))
        .unionByName(far_hits)
    )
    return hits.groupBy(*keys, value).agg(F.min(position).alias(position))


def range_join(
    facts: DataFrame,
    brackets: DataFrame,
    keys: list[str],
    value: str,
    low: str,
    high: str,
    position: str,
) -> DataFrame:
    """Facts with the columns of their bracket; facts without one are dropped.

    The positions of one table must be unique.
    """
    found = range_lookup(facts, brackets, keys, value, low, high, position)
    rows = first_per_key(brackets, [*keys, position], [F.col(low), F.col(high)])
    return facts.join(found.join(rows, [*keys, position]), [*keys, value])
