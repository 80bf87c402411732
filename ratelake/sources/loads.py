"""Tables that are loaded together and become visible together.

Below a root, every table has a folder per load, and every load one commit row, written
last:

    {table}/load={load}/…     rows, each with the ``load_id`` that brought it
    commits/load={load}/…     load_id, and the loads that it replaces

A reader asks the commits first and opens the folders of visible loads only, by literal
names. So a load counts in all its tables or in none, whatever was lost on the way; a load
that failed is written again under its id, and one that is committed is left alone. Ids of
loads sort by time.

Two rules make one table of many loads. *Parents* are inserted if absent: the earliest load
that brought a key holds it, and keys with a null never conflict. *Children* belong to a
parent and are replaced with it: those of the latest load that brought the parent count, so
a parent that came without children has none.

A compaction writes what counts of many loads as one, keeping each row's load_id, and
commits with the names it replaces: a reader sees the old folders or the new one, never
both. Compactions must not overlap.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.operators.keyed import any_null, first_per_key

_COMMIT = "load_id STRING, replaces ARRAY<STRING>, load STRING"


def _table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Rows below ``path``; none if there is no such folder."""
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], ddl)


def visible_loads(spark: SparkSession, root: str) -> list[str]:
    """Names of the loads that count: committed and not replaced. One short name per load
    comes to the driver; compaction keeps them few."""
    commits = _table(spark, f"{root}/commits", _COMMIT).select("load", "replaces").collect()
    replaced = {name for c in commits for name in c["replaces"] or []}
    return sorted({c["load"] for c in commits} - replaced)


def is_committed(spark: SparkSession, root: str, load_id: str) -> bool:
    return not _table(spark, f"{root}/commits", _COMMIT).filter(F.col("load") == load_id).isEmpty()


def write_rows(rows: DataFrame, root: str, table: str, load_id: str) -> None:
    """Rows of a load that is not committed yet; written again, they replace themselves."""
    own = rows if "load_id" in rows.columns else rows.withColumn("load_id", F.lit(load_id))
    own.write.mode("overwrite").parquet(f"{root}/{table}/load={load_id}")


def commit(spark: SparkSession, root: str, load_id: str, replaces: Iterable[str] = ()) -> None:
    """The row that makes a load visible, in one file."""
    names = F.array(*[F.lit(n) for n in replaces]).cast("array<string>")
    row = spark.range(1).select(F.lit(load_id).alias("load_id"), names.alias("replaces"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/load={load_id}")


def write_load(spark: SparkSession, tables: dict[str, DataFrame], root: str, load_id: str) -> bool:
    """All tables, then the commit; False if the load was there already."""
    if is_committed(spark, root, load_id):
        return False
    for table, rows in tables.items():
        write_rows(rows, root, table, load_id)
    commit(spark, root, load_id)
    return True


def loaded_rows(spark: SparkSession, root: str, table: str, ddl: str, loads: list[str] | None = None) -> DataFrame:
    """All rows that visible loads brought, with their load_id; only those folders are read."""
    names = visible_loads(spark, root) if loads is None else loads
    rows = _table(spark, f"{root}/{table}", f"{ddl}, load_id STRING, load STRING")
    return rows.filter(F.col("load").isin(names)).drop("load")


def parents(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of every key the row of its earliest load; rows with a null in their key all stay."""
    null_key = any_null(keys)
    first = first_per_key(rows.filter(~null_key), keys, [F.col("load_id").asc()])
    return first.unionByName(rows.filter(null_key))


def children(rows: DataFrame, parent_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that came with the latest load of their parent."""
    latest = parent_rows.groupBy(*keys).agg(F.max("load_id").alias("load_id"))
    return rows.join(latest, [*keys, "load_id"], "left_semi")


def compact(
    spark: SparkSession, root: str, load_id: str, parent_tables: dict[str, tuple[str, list[str]]],
    child_tables: dict[str, str], of: str, loads: list[str] | None = None,
) -> list[str]:
    """Write what counts of some loads (default: all visible) as one load; their names.

    ``parent_tables`` maps names to (schema, key), ``child_tables`` to schemas; ``of`` names
    the parent that the children belong to. Of that one, the row of the latest load stays
    beside that of the earliest, since it tells which children count.
    """
    if is_committed(spark, root, load_id):
        return []
    visible = visible_loads(spark, root)
    chosen = [n for n in visible if loads is None or n in loads]
    ddl, keys = parent_tables[of]
    all_parents = loaded_rows(spark, root, of, ddl, visible)
    for table, (ddl, own) in parent_tables.items():
        rows = loaded_rows(spark, root, table, ddl, chosen)
        kept = parents(rows, own)
        if table == of:
            last = first_per_key(rows.filter(~any_null(own)), own, [F.col("load_id").desc()])
            later = last.join(kept.select(*own, "load_id"), [*own, "load_id"], "left_anti")
            kept = kept.unionByName(later)
        write_rows(kept, root, table, load_id)
    for table, ddl in child_tables.items():
        rows = loaded_rows(spark, root, table, ddl, chosen)
        write_rows(children(rows, all_parents, keys), root, table, load_id)
    commit(spark, root, load_id, chosen)
    return chosen


def remove_replaced(spark: SparkSession, root: str, tables: Iterable[str]) -> None:
    """Delete the folders of replaced loads. Only for times without readers of them; the
    commits stay, so a replaced load is never taken for a new one."""
    commits = _table(spark, f"{root}/commits", _COMMIT).select("replaces").collect()
    gone = sorted({name for c in commits for name in c["replaces"] or []})
    for table in tables:
        for name in gone:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/load={name}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
