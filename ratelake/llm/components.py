"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is grouping and joining; its result is written to the shared folder, so
lineage stays short and lost executors cost no more than one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import discard, stored


def _towards_least(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node (larger ones, or all smaller ones and itself)
    with the least of its neighbourhood."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.filter(F.col("u") > F.col("v")).distinct()


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v): its least reachable node.

    Null ends and loops are ignored; repeated edges count once.
    """
    current = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), "u", "v")
        .toDF("u", "v", "a", "b").filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") > F.col("v")))
        .select("u", "v").distinct(),
        purpose,
    )
    mark = None
    while True:
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
        before, current = current, stored(_towards_least(_towards_least(current, True), False), purpose)
        discard(before)
    return current.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component"))
