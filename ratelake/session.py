"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Nothing here sets a number of executors or partitions: the cluster does.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def builder(app_name: str = "ratelake") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    for key, value in RECOMMENDED.items():
        b = b.config(key, value)
    return b


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """``df`` in at least so many partitions: for a scan of few splits whose rows are costly
    to work on. A scan that has as many stays as it is, without a shuffle."""
    return df if df.rdd.getNumPartitions() >= partitions else df.repartition(partitions)


_OWN: list[str] = []


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the cluster's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` is required. A local session without it gets
    one folder of its own, which is removed at the end of the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="ratelake-"))
            atexit.register(shutil.rmtree, _OWN[0], True)
        root = _OWN[0]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored_once(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, read by many, and
    still there when executors are lost."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def mounted_path(spark: SparkSession, path: str) -> str | None:
    """The path in the file system that all nodes mount, or None for one of another store."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = given.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(given).toUri().getPath() if store.getUri().getScheme() == "file" else None
