"""Readers of documents, feeds, artifacts and stored tables."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ratelake import fixed, schemas
from ratelake.operators.gate import DELTA_RULES, REGISTRY_RULES, SNAPSHOT_RULES, assert_valid, with_json
from ratelake.operators.keyed import first_per_key
from ratelake.session import mounted_path, stored_once


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listed_by_cores(spark: SparkSession) -> Iterator[None]:
    """Reads started in here list their folders by one task per core.

    Spark starts a task for every folder that it lists, and a job for every folder of more
    than 32; of captures, which have a folder each, the tasks cost far more than the listing.
    """
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def _or_empty(read: Callable[[], DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    """What ``read`` gives, or no rows if its path does not exist: listed once, by the read itself."""
    try:
        with listed_by_cores(spark):
            return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def column_names(ddl: str) -> list[str]:
    """Column names of a schema text."""
    return StructType.fromDDL(ddl).fieldNames()


def failing(df: DataFrame, broken: Column, message: Column) -> DataFrame:
    """``df``; a row that is ``broken`` fails the job with its message."""
    return df.filter(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def read_json_documents(spark: SparkSession, path: str, schema: str, name: str | None = None) -> DataFrame:
    """One row per JSON document; ``name`` picks files of that name at any depth.

    A path that does not exist reads as empty.
    """
    reader = spark.read.schema(schema).option("multiLine", "true")
    if name is not None:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", name)
    return _or_empty(
        lambda: reader.json(path).withColumn("file_path", F.col("_metadata.file_path")), spark, f"{schema}, file_path STRING"
    )


def read_text_documents(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Whole files as text (``value``), for untrusted JSON and raw HTML."""
    reader = spark.read
    if name is not None:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", name)
    return _or_empty(
        lambda: reader.text(path, wholetext=True).withColumn("file_path", F.col("_metadata.file_path")),
        spark, "value STRING, file_path STRING",
    )


def read_binary_artifacts(spark: SparkSession, path: str, name: str = "*.pdf") -> DataFrame:
    """Files as bytes with their SHA-256."""
    with listed_by_cores(spark):
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", name)
            .load(path)
        )
    return files.withColumn("content_hash_sha256", F.sha2("content", 256))


def feed_lines(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Lines of text files that are not blank: ``value``, ``file_path``, and their ``place``,
    which is the block of the file and a number that grows along the block."""
    reader = spark.read.option("lineSep", "\n")
    if name is not None:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", name)
    lines = _or_empty(
        lambda: reader.text(path).select(
            "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block")
        ),
        spark, "value STRING, file_path STRING, block BIGINT",
    ).filter(F.regexp_like("value", F.lit(f"[^{fixed.WHITESPACE[1:-1]}]")))
    # Numbered after the filter: along a block, which one task reads, without gaps.
    place = F.struct("block", F.monotonically_increasing_id().alias("line"))
    return lines.select("value", "file_path", place.alias("place"))


def numbered(lines: DataFrame, wanted: Column) -> DataFrame:
    """The ``wanted`` rows of :func:`feed_lines` with their ``line`` in the file, from 1,
    blank lines not counted.

    Each block gives its count and its wanted lines; the counts are summed up along the
    file, one row per block, so neither a file nor its lines are gathered or sorted.
    """
    found = F.collect_list(F.when(wanted, F.struct("place", "value")))
    blocks = lines.groupBy("file_path", F.col("place.block").alias("block")).agg(
        F.count(F.lit(1)).alias("n"), F.min("place.line").alias("first"), found.alias("found")
    )
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return placed.select("file_path", "before", "first", F.explode("found").alias("_l")).select(
        "file_path", (F.col("before") + F.col("_l.place.line") - F.col("first") + 1).alias("line"), "_l.value"
    )


def _first_place(bad: DataFrame) -> Column:
    """Message that names the first bad line by file and line, as a scalar subquery; NULL if none is."""
    first = bad.agg(F.min(F.struct("file_path", "line")).alias("p"))
    return first.select(F.concat(F.lit("Invalid JSONL at "), "p.file_path", F.lit(":"), F.col("p.line"))).scalar()


def _parsed_line(schema: str) -> Column:
    return F.from_json("value", f"{schema}, _corrupt_record STRING", {"columnNameOfCorruptRecord": "_corrupt_record"})


def bad_json_lines(spark: SparkSession, path: str, schema: str, name: str | None = None) -> DataFrame:
    """Quarantine rows of a feed: file_path, line and value of each line that is no JSON
    record of this schema. ``line`` counts the lines of the file that are not blank."""
    return numbered(feed_lines(spark, path, name), _parsed_line(schema)["_corrupt_record"].isNotNull())


def read_json_lines(
    spark: SparkSession, path: str, schema: str, name: str | None = None, strict: bool = True
) -> DataFrame:
    """JSON lines; blank lines are skipped.

    Strict: the job fails on a bad line and names the first one by file and line; a scan
    before the read looks for it. Otherwise bad lines come back with ``_corrupt_record``
    set (:func:`bad_json_lines` tells where they stand).
    """
    lines = feed_lines(spark, path, name)
    if strict:
        place = _first_place(bad_json_lines(spark, path, schema, name))
        lines = failing(lines, place.isNotNull(), place)
    rows = lines.select(_parsed_line(schema).alias("_p"), "file_path").select("_p.*", "file_path")
    return rows.drop("_corrupt_record") if strict else rows


def decoded_path(file_path: Column) -> Column:
    """A file path as it is named in its store, without scheme and host."""
    plain = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def _segment(part: Column) -> Column:
    """A path segment, or the value of a ``name=value`` one as partitioned writes leave it."""
    named = part.rlike("^[a-z_]+=")
    value = F.url_decode(F.replace(F.regexp_replace(part, "^[a-z_]+=", ""), F.lit("+"), F.lit("%2B")))
    return F.when(named, value).otherwise(part)


def path_keys(file_path: Column, area: str) -> Column:
    """Carrier, source and capture time from ``…/{area}/{carrier}/{source}/{captured_at}/file``
    (segments may read ``name=value``); NULL when the path is too short."""
    plain = decoded_path(file_path)
    parts = F.split(F.element_at(F.split(plain, f"/{area}/"), -1), "/")
    return F.when(
        F.contains(plain, F.lit(f"/{area}/")) & (F.size(parts) >= 4),
        F.struct(
            _segment(F.get(parts, F.lit(0))).alias("carrier"),
            _segment(F.get(parts, F.lit(1))).alias("source_id"),
            _segment(F.get(parts, F.lit(2))).alias("captured_at"),
        ),
    )


def with_path_keys(files: DataFrame, area: str) -> DataFrame:
    keyed = files.withColumn("_k", path_keys(F.col("file_path"), area)).filter(F.col("_k").isNotNull())
    return keyed.select("*", "_k.*").drop("_k")


LISTED = 1000  # entries of one folder that the driver looks at, at most
_HIDDEN = re.compile(r"(?!_metadata|_common_metadata)(_[^=]*|[.].*|.*[.]_COPYING_)", re.DOTALL)  # names that Spark passes over
_COMPRESSED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd")
_READ_BYTES = 4 << 20  # texts that a task hands on at once


def _walked(name: str) -> Callable[[Iterator[str]], Iterator[tuple[str, str, bool]]]:
    """Files below folders that hold documents ``name``: path, path as Spark spells it, and
    whether the document is the whole file. What Spark's own listing passes over is passed
    over, and empty files are. Nothing that it calls is a name of this package, which the workers need not have."""
    legal = "/;:@&=+$,_-!.~'()*"

    def spelled(path: str) -> str:
        return "file:" + "".join(
            c if c.isalnum() or c in legal or (ord(c) > 159 and not c.isspace()) else quote(c) for c in path
        )

    def files(path: str) -> Iterator[tuple[str, str, bool]]:
        below = []
        with os.scandir(path) as found:
            for entry in found:
                n = entry.name
                if _HIDDEN.fullmatch(n):
                    continue
                if entry.is_dir():
                    below.append(entry.path)
                elif (n == name or n.startswith("part-")) and not n.startswith("_") and entry.is_file() and entry.stat().st_size > 0:
                    uri = spelled(entry.path)
                    if n == name:
                        yield entry.path, uri, True
                    if n.startswith("part-") and f"/file={name}/" in uri:
                        yield entry.path, uri, False
        for folder in below:
            yield from files(folder)

    return lambda paths: (f for path in paths for f in files(path))


def _texts() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads listed files: whole, or a row per line that is not blank, in batches bounded by
    bytes. As little of this package as in :func:`_walked`."""
    def batch_of(values: list[bytes], paths: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values, pa.binary()), pa.array(paths, pa.string())], ["value", "file_path"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, paths, size = [], [], 0
        for batch in batches:
            for path, uri, whole in zip(*(c.to_pylist() for c in batch.columns)):
                with open(path, "rb") as f:
                    text = f.read()
                # Lines as Hadoop's reader cuts them, without the mark that may begin a file.
                lines = [text] if whole else [x for x in text.removeprefix(b"\xef\xbb\xbf").splitlines() if x.strip(b" ")]
                values += lines
                paths += [uri] * len(lines)
                size += len(text)
                if size > _READ_BYTES:
                    yield batch_of(values, paths)
                    values, paths, size = [], [], 0
        if values:
            yield batch_of(values, paths)

    return read


def _some_folders(roots: list[str], wanted: int) -> list[str]:
    """Folders that have all files of ``roots`` below them: about ``wanted`` of them, for as
    many tasks to walk. A folder that holds files or more than LISTED entries is one, whole."""
    whole, level = [], sorted(roots)
    while level and len(whole) + len(level) < wanted:
        below = []
        for path in level:
            with os.scandir(path) as found:
                entries = list(islice(found, LISTED + 1))
            seen = [e for e in entries if not _HIDDEN.fullmatch(e.name)]
            if len(entries) > LISTED or any(not e.is_dir() for e in seen):
                whole.append(path)
            else:
                below += [e.path for e in seen]
        level = below
    return whole + level


def _listed(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """Files of :func:`_walked` below the folders that ``root`` names in a mounted store, as a
    stored table: neither their names nor their states come to the driver. None for another
    store, or if what is found must be uncompressed."""
    if mounted_path(spark, root) is None:
        return None
    given = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = given.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(given) or []
    if any(not f.isDirectory() for f in found):
        return None
    sc = spark.sparkContext
    folders = _some_folders([f.getPath().toUri().getPath() for f in found], 4 * sc.defaultParallelism)
    ddl = "path STRING, file_path STRING, whole BOOLEAN"
    if not folders:
        return spark.createDataFrame([], ddl)
    walked = sc.parallelize(folders, min(len(folders), sc.defaultParallelism)).mapPartitions(_walked(name))
    listed = stored_once(spark.createDataFrame(walked, ddl).repartition(sc.defaultParallelism), "listing")
    packed = F.lit(False)
    for end in _COMPRESSED:
        packed |= F.endswith("path", F.lit(end))
    return listed if listed.filter(packed).isEmpty() else None


def _unsized(df: DataFrame) -> DataFrame:
    """``df`` as rows of a size that the planner cannot know: it would take texts for as small
    as the paths that they are read from, and broadcast them."""
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(df._jdf.toJavaRDD(), df._jdf.schema()), spark)


def read_artifacts(spark: SparkSession, run_dir: str, area: str, name: str) -> DataFrame:
    """Documents ``name`` of an area of a run folder: ``value``, ``file_path``, and the
    ``document_path`` that a manifest names them by.

    Either whole files of that name, or the part files that
    :func:`~ratelake.sources.writers.write_artifacts` leaves in a folder ``file={name}``.
    In a mounted store tasks list and read them, since Spark's file index holds the state of
    every file in the driver; other stores and compressed files go by that index.
    """
    root = f"{run_dir}/{area}"
    listed = _listed(spark, root, name)
    if listed is None:
        both = _indexed_artifacts(spark, root, name)
    else:
        read = _unsized(listed.mapInArrow(_texts(), "value BINARY, file_path STRING"))
        both = read.select(F.col("value").cast("string").alias("value"), "file_path")
    return both.withColumn("document_path", F.regexp_replace(decoded_path(F.col("file_path")), f"(/file={name})/part-[^/]*$", "$1"))


def _indexed_artifacts(spark: SparkSession, root: str, name: str) -> DataFrame:
    parts = _or_empty(
        lambda: spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").text(root)
        .filter(F.contains(F.col("_metadata.file_path"), F.lit(f"/file={name}/")))
        .select("value", F.col("_metadata.file_path").alias("file_path")),
        spark, "value STRING, file_path STRING",
    ).filter(F.trim("value") != "")
    return read_text_documents(spark, root, name).unionByName(parts)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Validated registry rows; an invalid registry fails the job with all errors."""
    text = read_text_documents(spark, path)
    valid = assert_valid(text, "value", F.lit("Registry"), REGISTRY_RULES)
    parsed = valid.select(F.from_json("value", schemas.REGISTRY).alias("_r"))
    return parsed.select(F.explode("_r.sources").alias("_s")).select("_s.*")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of the run folder at ``path`` and those of run folders right below it:
    ``run_manifest.json`` as one document, or as a folder of part files with one text per
    line (:func:`~ratelake.sources.manifests.write_manifests`).

    A row is a manifest, or a line of one: ``sources`` then holds the line's source, if
    any, and ``position`` its place; ``is_head`` marks the one row of a run that describes
    it. ``base`` is the folder of the run. Text that is no manifest fails the job.
    """
    found = spark.createDataFrame([], "value STRING, file_path STRING")
    for root in (f"{path}/{fixed.MANIFEST_FILE}", f"{path}/*/{fixed.MANIFEST_FILE}"):
        for name, whole in ((fixed.MANIFEST_FILE, True), ("part-*", False)):
            found = found.unionByName(_or_empty(
                lambda root=root, name=name, whole=whole: spark.read.option("pathGlobFilter", name)
                .text(root, wholetext=whole).select("value", F.col("_metadata.file_path").alias("file_path")),
                spark, "value STRING, file_path STRING",
            ))
    documents = found.filter(F.trim("value") != "")
    parsed = F.from_json("value", f"{schemas.MANIFEST_LINE}, _broken STRING", {"columnNameOfCorruptRecord": "_broken"})
    parsed = documents.select("file_path", parsed.alias("_m")).select("file_path", "_m.*")
    parsed = failing(
        parsed, F.col("_broken").isNotNull() | F.col("run_id").isNull(),
        F.concat(F.lit("Invalid manifest at "), F.col("file_path")),
    )
    own = F.col("source")
    return parsed.select(
        *[c for c in column_names(schemas.MANIFEST) if c != "sources"],
        F.when(own.isNotNull(), F.array(own)).otherwise(F.col("sources")).alias("sources"),
        F.coalesce("position", F.lit(0)).alias("position"), own.isNull().alias("is_head"), "file_path",
        F.substring_index("file_path", f"/{fixed.MANIFEST_FILE}", 1).alias("base"),
    )


def manifest_runs(manifests: DataFrame, now: Column) -> DataFrame:
    """Rows of the runs table; a missing time becomes ``now``."""
    def time(c: str) -> Column:
        return F.coalesce(F.col(c).try_cast("timestamp"), now).alias(c)

    heads = manifests.filter("is_head")
    return heads.select("run_id", "out_dir", "run_dir", "registry_path", time("started_at"), time("ended_at"))


def manifest_sources(manifests: DataFrame) -> DataFrame:
    """Sources of the manifests with their place; ``captured_text`` is the time as written."""
    rows = manifests.select("run_id", "base", "position", F.posexplode("sources").alias("_i", "_s"))
    return rows.select(
        "run_id", "base", (F.col("position") + F.col("_i")).alias("position"), "_s.*", F.col("_s.captured_at").alias("captured_text")
    ).withColumn("captured_at", F.col("captured_at").try_cast("timestamp"))


def manifest_children(sources: DataFrame, now: Column) -> DataFrame:
    """Rows of the child artifacts table, from rows of :func:`manifest_sources`."""
    rows = sources.select(
        "run_id", "base", "position", F.col("source_id").alias("parent_source_id"),
        F.posexplode("child_artifacts").alias("child_position", "_c"),
    ).select(
        "run_id", "base", "position", "child_position", "parent_source_id", "_c.*", F.col("_c.captured_at").alias("captured_text")
    )
    return rows.withColumn("captured_at", F.coalesce(F.col("captured_at").try_cast("timestamp"), now))


def read_run_snapshots(spark: SparkSession, run_dir: str, strict: bool = True) -> DataFrame:
    """Snapshots of one run with their file path; of documents with the same key the
    last one wins. Reads named files, one document each, and the part files that
    :func:`~ratelake.sources.writers.write_documents` leaves, one document per line."""
    root = f"{run_dir}/snapshots"
    parts = _or_empty(
        lambda: spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").text(root)
        .select("value", F.col("_metadata.file_path").alias("file_path")),
        spark, "value STRING, file_path STRING",
    ).filter(F.trim("value") != "")
    text = read_text_documents(spark, root, "parsed.json").unionByName(parts)
    if strict:
        label = F.concat(F.lit("Snapshot "), F.col("file_path"))
        text = assert_valid(text, "value", label, SNAPSHOT_RULES)
    docs = text.select(F.from_json("value", schemas.SNAPSHOT).alias("_s"), "file_path").select("_s.*", "file_path")
    return first_per_key(docs, ["carrier", "source_id", "captured_at"], [F.col("file_path").desc()])


def read_run_deltas(spark: SparkSession, run_dir: str, strict: bool = True, named: bool = True) -> DataFrame:
    """Delta records of one run, from feed files of either kind: named ones, or the part
    files that :func:`~ratelake.sources.writers.write_deltas` leaves. Their ``position``
    orders rows by file and line. Strict: a line that is no JSON fails the job by file and
    line, a record that breaks the rules with all its errors. What names the line is a scan
    of its own before the read; not ``named``, the line fails as a record without it.
    """
    lines = feed_lines(spark, f"{run_dir}/changes", f"{{{fixed.DELTA_FILE},part-*}}")
    lines = lines.withColumn("position", F.struct("file_path", "place"))
    if strict and named:
        place = _first_place(numbered(with_json(lines, "value", "doc"), F.col("doc").isNull()))
        lines = failing(lines, place.isNotNull(), place)
    if strict:
        lines = assert_valid(lines, "value", F.concat(F.lit("Delta in "), F.col("file_path")), DELTA_RULES)
    record = F.from_json("value", schemas.DELTA)
    if not strict:
        return lines.select(record.alias("_d"), "file_path", "position").select("_d.*", "file_path", "position")

    # Texts and numbers of a checked record are as the gate read them; a zero that it read has lost its sign.
    def field(f: StructField) -> Column:
        kind = f.dataType.simpleString()
        if kind not in ("string", "double"):
            return record[f.name].alias(f.name)
        read = F.try_variant_get("doc", f"$.{f.name}", kind)
        return (read if kind == "string" else F.when(read == 0, record[f.name]).otherwise(read)).alias(f.name)

    return lines.select(*[field(f) for f in StructType.fromDDL(schemas.DELTA)], "file_path", "position")


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Stored table; only the named columns are read."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)
