"""One row per key, insert-if-absent, replace-by-key and key sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key under ``order`` (which must be a full order).

    The ``row_number() = 1`` filter is planned as a window group limit, so every
    map task sends at most one row per key: a hot key does not swell one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def absent_rows(
    existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column]
) -> DataFrame:
    """Rows of ``incoming`` that insert-if-absent would add to ``existing``.

    Keys holding a NULL never conflict, neither in the batch nor with the table.
    """
    null_key = any_null(keys)
    fresh = first_per_key(incoming.filter(~null_key), keys, order).join(
        existing.select(*keys), keys, "left_anti"
    )
    nullable = any(incoming.schema[k].nullable for k in keys)
    return fresh.unionByName(incoming.filter(null_key)) if nullable else fresh


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column]
) -> DataFrame:
    """The table after the insert."""
    return existing.unionByName(absent_rows(existing, incoming, keys, order))


def replace_by_key(
    existing: DataFrame, parents: DataFrame, children: DataFrame, keys: list[str]
) -> DataFrame:
    """Child rows after a reload of ``parents``.

    Every reloaded parent loses its old children, also one that comes back with
    none; other parents keep theirs.
    """
    kept = existing.join(parents.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(children)


def key_union(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).union(b.select(*keys)).distinct()


def key_except(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).subtract(b.select(*keys))


def key_intersect(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


def compare_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, with ``side`` = ``missing`` (only in a) or ``extra``.

    One shuffle: both sides are tagged, unioned and pre-aggregated per key.
    """
    tagged = a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    flags = tagged.groupBy(*keys).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return flags.filter(F.col("_a") != F.col("_b")).select(
        *keys, F.when(F.col("_a") == 1, "missing").otherwise("extra").alias("side")
    )
