"""Sinks: documents, feeds and stored tables.

Stored tables only ever grow by appends. A load becomes visible when its commit
row is written last, so a lost executor or a failed job leaves nothing half
done, and running a load again changes nothing.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ratelake.operators.keyed import absent_rows, first_per_key
from ratelake.session import mounted_path


ARTIFACT_TASKS = 4  # per core, so that none waits long for the last


def write_documents(
    df: DataFrame, document: str, path: str, partition_by: list[str] = (), compression: str = "none"
) -> None:
    """One JSON document per row, as lines."""
    out = df.select(*partition_by, F.to_json(document, {"ignoreNullFields": "false"}).alias("value"))
    out.write.mode("overwrite").partitionBy(*partition_by).text(path, compression=compression)


ARTIFACT_KEYS = ["carrier", "source_id", "captured_at", "file"]
_ESCAPED = {chr(c) for c in range(1, 32)} | set("\"#%'*/:=?\\{[]^\x7f")


def _staged_rows(stage: str, job: str) -> Callable[[Iterator[Row]], None]:
    """Writes the rows of a task, sorted by folder, below a folder of its own. Nothing that it
    calls is a name of this package, which the workers need not have."""
    def value(text: str | None) -> str:
        return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text or "") or "__HIVE_DEFAULT_PARTITION__"

    def place(row: Row) -> str:  # spelled as partitioned writes spell it
        return "/".join(f"{k}={value(row[k])}" for k in ARTIFACT_KEYS)

    def write(rows: Iterator[Row]) -> None:
        task = TaskContext.get()
        # An attempt leaves its files, all or none, under the name of its task.
        own = f"{stage}/{task.partitionId()}"
        attempt = f"{stage}/_attempt-{task.taskAttemptId()}"
        for folder, found in groupby(rows, place):
            os.makedirs(f"{attempt}/{folder}", exist_ok=True)
            with open(f"{attempt}/{folder}/part-{task.partitionId():05d}-{job}.c000.txt", "a", encoding="utf-8", newline="") as f:
                f.writelines((row["value"] or "") + "\n" for row in found)
        try:
            if os.path.isdir(attempt):
                os.rename(attempt, own)
        except OSError:  # another attempt was first
            if not os.path.isdir(own):
                raise

    return write


def _moved_rows(stage: str, path: str) -> Callable[[int], None]:
    """Moves the files of a task to their folders; again, it goes on where it stopped."""
    def move(task: int) -> None:
        own = f"{stage}/{task}"
        for folder, _, files in os.walk(own):
            for name in files:
                to = path + folder[len(own):]
                os.makedirs(to, exist_ok=True)
                try:
                    os.replace(f"{folder}/{name}", f"{to}/{name}")
                except FileNotFoundError:  # another attempt was first
                    if not os.path.exists(f"{to}/{name}"):
                        raise
        shutil.rmtree(own, ignore_errors=True)

    return move


def _write_mounted(rows: DataFrame, path: str, tasks: int) -> None:
    """Files written by the tasks themselves, then moved to their places when all are there.

    Hadoop's local file system starts a process for every folder and file, to set its mode,
    which costs far more than the file.
    """
    job = uuid.uuid4().hex
    stage = f"{path}/_temporary-{job}"
    os.makedirs(stage)
    try:
        rows.foreachPartition(_staged_rows(stage, job))
        sc = rows.sparkSession.sparkContext
        sc.parallelize(range(tasks), tasks).foreach(_moved_rows(stage, path))
    finally:
        shutil.rmtree(stage, ignore_errors=True)


def write_artifacts(df: DataFrame, value: str, path: str) -> None:
    """Documents of a run folder's area, one line each, in folders
    ``carrier=…/source_id=…/captured_at=…/file=…`` by those columns of ``df``.

    A file costs far more than its row, so the rows are dealt out by folder over all cores,
    however few tasks they come from; rows of one folder stay in one file.
    """
    spark = df.sparkSession
    tasks = ARTIFACT_TASKS * spark.sparkContext.defaultParallelism
    rows = df.select(*ARTIFACT_KEYS, F.col(value).alias("value")).repartition(tasks, *ARTIFACT_KEYS)
    mounted = mounted_path(spark, path)
    if mounted is None:
        rows.write.mode("append").partitionBy(*ARTIFACT_KEYS).text(path)
    else:
        texts = rows.select(*[F.col(k).cast("string").alias(k) for k in ARTIFACT_KEYS], "value")
        _write_mounted(texts.sortWithinPartitions(*ARTIFACT_KEYS), mounted, tasks)


def write_deltas(deltas: DataFrame, path: str, compression: str = "none") -> None:
    """Delta feed as JSON lines; a record holds all its fields, and no rows give an empty feed."""
    deltas.write.mode("overwrite").option("ignoreNullFields", "false").json(path, compression=compression)


def write_report(lines: DataFrame, path: str) -> None:
    """Report lines as text, in order over the part files."""
    lines.select("line").write.mode("overwrite").text(path)


def write_parity(items: DataFrame, path: str) -> None:
    """Mismatches as JSON lines, one folder per category."""
    items.write.mode("overwrite").partitionBy("category").json(path)


def stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path``, or an empty one shaped like ``like``."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return like.limit(0)


LITERAL_PARTITIONS = 1000  # partitions that a batch names one by one


def touched_rows(existing: DataFrame, incoming: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows of a stored table in the partitions that ``incoming`` touches.

    Up to LITERAL_PARTITIONS of them are named in the filter, so that only their folders
    are listed and read; a batch that touches more is joined on their values.
    """
    values = incoming.select(*partition_by).distinct()
    names = values.limit(LITERAL_PARTITIONS + 1).collect()
    if len(names) > LITERAL_PARTITIONS:
        return existing.join(values, list(partition_by), "left_semi")
    if len(partition_by) == 1:
        return existing.filter(F.col(partition_by[0]).isin([r[0] for r in names if r[0] is not None]))
    here = F.lit(False)
    for row in names:
        one = F.lit(True)
        for name, value in zip(partition_by, row):
            one &= F.col(name) == F.lit(value)
        here |= one
    return existing.filter(here)


def append_absent(
    incoming: DataFrame, path: str, keys: list[str], order: list[Column], partition_by: list[str] = ()
) -> None:
    """Insert-if-absent into the Parquet table at ``path``: only new rows are written.

    ``partition_by`` must be among ``keys``; then only the partitions that ``incoming``
    touches are read.
    """
    existing = stored(incoming.sparkSession, path, incoming)
    if partition_by:
        existing = touched_rows(existing, incoming, partition_by)
    fresh = absent_rows(existing, incoming, keys, order)
    fresh.write.mode("append").partitionBy(*partition_by).parquet(path)


def publish_children(
    parents: DataFrame, children: dict[str, DataFrame], root: str, keys: list[str], load_id: str
) -> None:
    """Replace the children of ``parents``: append them under ``load_id``, then commit.

    ``children`` maps table names to rows holding ``keys``. Parents that come
    back without children are cleared, since the commit names them all the same.
    """
    for name, rows in children.items():
        rows.withColumn("load_id", F.lit(load_id)).write.mode("overwrite").parquet(
            f"{root}/{name}/load={load_id}"
        )
    parents.select(*keys).distinct().withColumn("load_id", F.lit(load_id)).write.mode("overwrite").parquet(
        f"{root}/commits/load={load_id}"
    )


def current_children(spark: SparkSession, root: str, name: str, keys: list[str]) -> DataFrame:
    """Child rows of the newest committed load of every parent; load ids sort by time."""
    commits = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/commits")
    newest = first_per_key(commits, keys, [F.col("load_id").desc()])
    # The load is a partition column, so the join on it reads committed, current loads only.
    schema = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/{name}").schema
    rows = spark.read.schema(schema.add("load", "string")).parquet(f"{root}/{name}")
    current = newest.withColumn("load", F.col("load_id"))
    return rows.join(current, [*keys, "load_id", "load"], "left_semi").drop("load_id", "load")
