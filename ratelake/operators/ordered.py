"""As-of joins, previous rows and carried values along an order.

Windows run over *distinct instants per key*, never over the fact rows, and may
be cut into time buckets, so a key holding much of the data is spread over many
tasks. Facts meet the result again in an equi-join on (key, instant), which
adaptive execution can split when it is skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.operators.keyed import first_per_key


def carry_last(
    df: DataFrame,
    keys: list[str],
    order: str,
    values: dict[str, tuple[Column, bool]],
    bucket: Column | None = None,
) -> DataFrame:
    """Add, per output name, the last non-null value seen along ``order``.

    ``values`` maps the output name to (value, whether the own row counts).
    With ``bucket`` (a coarsening of ``order``, e.g. its day) a key is handled
    one bucket at a time; the last values of every bucket, one row each, are
    carried over to the following buckets.
    """
    frame = {True: 0, False: -1}

    def last_along(parts: list[str]) -> DataFrame:
        out = df if bucket is None else df.withColumn("_bucket", bucket)
        w = Window.partitionBy(*parts).orderBy(order)
        for name, (value, own) in values.items():
            rows = w.rowsBetween(Window.unboundedPreceding, frame[own])
            out = out.withColumn(name, F.last(value, ignorenulls=True).over(rows))
        return out

    if bucket is None:
        return last_along(keys)

    parts = [*keys, "_bucket"]
    ends = df.withColumn("_bucket", bucket).groupBy(*parts).agg(
        *[
            F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias(f"_end_{name}")
            for name, (value, _) in values.items()
        ]
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *parts,
        *[F.last(f"_end_{name}", ignorenulls=True).over(before).alias(f"_in_{name}") for name in values],
    )
    joined = last_along(parts).join(carried, parts, "left")
    for name in values:
        joined = joined.withColumn(name, F.coalesce(name, f"_in_{name}"))
    return joined.drop("_bucket", *[f"_in_{name}" for name in values])


def asof_instants(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    time: str,
    inclusive: bool = True,
    bucket: Column | None = None,
) -> DataFrame:
    """For every distinct (keys, time) of ``left``: the latest ``right`` time
    not after it (``inclusive``) or before it, as ``_match``."""
    none = F.lit(None).cast(right.schema[time].dataType)
    tagged = left.select(*keys, time, none.alias("_right"), F.lit(True).alias("_left")).unionByName(
        right.select(*keys, time, F.col(time).alias("_right"), F.lit(False).alias("_left"))
    )
    instants = (
        tagged.filter(F.col(time).isNotNull())
        .groupBy(*keys, time)
        .agg(F.max("_right").alias("_right"), F.max("_left").alias("_left"))
    )
    carried = carry_last(instants, keys, time, {"_match": (F.col("_right"), inclusive)}, bucket)
    return carried.filter(F.col("_left") & F.col("_match").isNotNull()).select(*keys, time, "_match")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    time: str,
    right_time: str,
    order: list[Column],
    inclusive: bool = True,
    bucket: Column | None = None,
    how: str = "left",
) -> DataFrame:
    """Backward as-of join; ``order`` decides between right rows of one instant.

    ``keys`` name the equi columns on both sides; the other right columns are
    appended. Right rows with a NULL time never match.
    """
    best = first_per_key(right.filter(F.col(right_time).isNotNull()), [*keys, right_time], order)
    renamed = best.select(*keys, F.col(right_time).alias(time))
    matches = asof_instants(left, renamed, keys, time, inclusive, bucket)
    payload = best.withColumn("_match", F.col(right_time))
    picked = matches.join(payload, [*keys, "_match"]).drop("_match")
    return left.join(picked, [*keys, time], how)


def previous_row(
    df: DataFrame, keys: list[str], time: str, columns: list[str], prefix: str = "prior_"
) -> DataFrame:
    """Append ``columns`` of the row with the next smaller ``time`` of the same key.

    For inputs holding one row per (keys, time), e.g. one row per week.
    """
    w = Window.partitionBy(*keys).orderBy(time)
    packed = F.lag(F.struct(*columns)).over(w)
    out = df.withColumn("_prior", packed)
    for c in columns:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_prior.{c}"))
    return out.drop("_prior")


def prior_of_other_owner(
    df: DataFrame,
    keys: list[str],
    time: str,
    owner: str,
    bucket: Column | None = None,
) -> DataFrame:
    """For every distinct (keys, time, owner): time and owner of the latest
    earlier row of the same keys that has another owner; ties go to the smallest
    owner. Linear: two owners per instant and the latest row of a second owner
    are all the state it takes.
    """
    # Smallest and second smallest owner of every instant; the rank filter is a
    # window group limit, so an instant with many owners ships two per task.
    owners = df.select(*keys, time, owner).filter(F.col(time).isNotNull()).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys, time).orderBy(owner))
    lowest, highest = F.min(owner), F.max(owner)
    instants = (
        owners.withColumn("_rank", rank)
        .filter(F.col("_rank") <= 2)
        .groupBy(*keys, time)
        .agg(lowest.alias("_first"), F.when(highest > lowest, highest).alias("_second"))
    )

    def entry(owner_col: Column, at: Column) -> Column:
        return F.when(owner_col.isNotNull(), F.struct(at.alias("t"), owner_col.alias("o")))

    # Previous instant of the key, then the latest entry of a different owner.
    own = F.struct(F.col(time).alias("t"), F.col("_first").alias("o"), F.col("_second").alias("s"))
    walked = carry_last(instants, keys, time, {"_prev": (own, False)}, bucket)
    prev = F.col("_prev")
    local = F.coalesce(
        entry(F.col("_second"), F.col(time)),
        F.when(prev["o"] != F.col("_first"), F.struct(prev["t"].alias("t"), prev["o"].alias("o"))),
        entry(prev["s"], prev["t"]),
    )
    other = carry_last(
        walked.withColumn("_local", local), keys, time, {"_other": (F.col("_local"), False)}, bucket
    )
    best = F.struct(prev["t"].alias("t"), prev["o"].alias("o"))
    return (
        owners.join(other.select(*keys, time, "_prev", "_other"), [*keys, time])
        .withColumn("_pick", F.when(prev["o"] != F.col(owner), best).otherwise(F.col("_other")))
        .select(
            *keys,
            time,
            owner,
            F.col("_pick.t").alias(f"prior_{time}"),
            F.col("_pick.o").alias(f"prior_{owner}"),
        )
    )
