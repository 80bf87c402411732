"""Streaming jobs over landed captures.

Results are Parquet tables and checkpoints live in the cluster's shared folder,
so a restarted job goes on where it stopped. Batches may be replayed after a
failure; every sink here gives the same table when they are.

What a job must remember of all earlier rows is keyed state in RocksDB, so a batch
costs what it brings and no stored table is read again.
"""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructType

from ratelake.functions.dates import parse_timestamp
from ratelake.operators.diff import ID, snapshot_diff
from ratelake.operators.keyed import any_null
from ratelake.operators.normalize import normalize

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """Keyed state needs this store; a query keeps the settings it was started with."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def stream_normalize(captures: DataFrame, raw: str, path: str, checkpoint: str) -> StreamingQuery:
    """Normalise captures as they land: stateless, appended to ``path``."""
    return (
        normalize(captures, raw)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class _FirstArrival(StatefulProcessor):
    """Emits the first row of a key once, and remembers that the key was there."""

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def _place(self, row: Row) -> list:
        return [(True, 0) if row[name] is None else (False, row[name]) for name in self.order]

    def handleInputRows(self, key, rows, timer_values) -> Iterator[Row]:
        if not self.seen.exists():
            self.seen.update((True,))
            yield min(rows, key=self._place)

    def handleInitialState(self, key, initial_state, timer_values) -> None:
        self.seen.update((True,))

    def close(self) -> None:
        pass


def stream_dedup(
    rows: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str,
    partition_by: list[str] = (), existing: DataFrame | None = None,
) -> StreamingQuery:
    """Insert-if-absent for ever: the first arrival of every key, however late it comes,
    appended to the table at ``path``.

    Of one batch the row that is first by the columns ``order`` counts (nulls last), of
    several batches the earliest batch's. Keys with a null never conflict. ``existing``
    holds rows whose keys are taken before the first batch.
    """
    spark = rows.sparkSession
    null_key = any_null(keys)
    start = None if existing is None else existing.select(*keys).distinct().groupBy(*keys)
    first = rows.filter(~null_key).groupBy(*keys).transformWithState(
        _FirstArrival(list(order)), rows.schema, "Append", "None", start
    )
    with _rocksdb(spark):
        return (
            first.unionByName(rows.filter(null_key))
            .writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


_VERSION = "instant bigint, run_id string, captured_text string, structural_error boolean, tie bigint, place bigint"
_PAIRED = (
    f"carrier string, source_id string, {_VERSION}, "
    "prior_run_id string, prior_text string, prior_tie bigint, prior_place bigint"
)


class _Versions(StatefulProcessor):
    """The versions of one source: their ids in order of capture as one small value, each with
    the place of its tables. Emits every new version with the latest earlier one of another run."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ids = handle.getValueState("ids", "ids string")

    def _known(self) -> list[list]:
        return json.loads(self.ids.get()[0]) if self.ids.exists() else []

    def _keep(self, known: list[list], row: Row) -> None:
        # Versions without a time come first and are prior to none.
        instant = -1 << 62 if row["instant"] is None else row["instant"]
        insort(known, [instant, row["run_id"], row["captured_text"], row["tie"], row["place"]])

    @staticmethod
    def _prior(known: list[list], row: Row) -> list | None:
        if row["instant"] is None:
            return None
        at, found = bisect_left(known, [row["instant"]]) - 1, None
        while at >= 0 and known[at][0] > -1 << 62 and (found is None or known[at][0] == found[0]):
            if known[at][1] != row["run_id"]:
                found = known[at]
            at -= 1
        return found

    def handleInputRows(self, key, rows, timer_values) -> Iterator[Row]:
        known = self._known()
        taken = {(run, text) for _, run, text, _, _ in known}
        new = {}
        for row in sorted(rows, key=lambda r: (r["structural_error"], r["tie"])):
            if (row["run_id"], row["captured_text"]) not in taken:
                taken.add((row["run_id"], row["captured_text"]))
                new[(row["run_id"], row["captured_text"])] = row
        for row in new.values():
            self._keep(known, row)
        if new:
            self.ids.update((json.dumps(known),))
        for row in new.values():
            prior = self._prior(known, row)
            old = [None] * 4 if prior is None else prior[1:]
            yield Row(**row.asDict(), **dict(zip(["prior_run_id", "prior_text", "prior_tie", "prior_place"], old)))

    def handleInitialState(self, key, initial_state, timer_values) -> None:
        known = self._known()
        self._keep(known, initial_state)
        self.ids.update((json.dumps(known),))

    def close(self) -> None:
        pass


_KNOWN = 0  # place of the versions that were there before the first batch
_NAME = ["carrier", "source_id", "run_id", "captured_text", "tie"]


def _versions(snapshots: DataFrame, place: Column) -> DataFrame:
    """Snapshots as rows of state, without their tables: times as instants."""
    text = isinstance(snapshots.schema["captured_at"].dataType, StringType)
    at = parse_timestamp(F.col("captured_at")) if text else F.col("captured_at").cast("timestamp")
    return _named(snapshots).select(
        "carrier", "source_id", F.unix_micros(at).alias("instant"), "run_id", "captured_text", "structural_error", "tie",
        place.alias("place"),
    )


def _named(snapshots: DataFrame) -> DataFrame:
    """Snapshots with the columns that name one delivery of a version: its id and its content."""
    return snapshots.withColumns({
        "run_id": F.col("run_id").cast("string"), "captured_text": F.col("captured_at").cast("string"),
        "tie": F.xxhash64(F.to_json("tables", {"ignoreNullFields": "false"})),
    })


def _flat_tables(snapshots: DataFrame) -> DataFrame:
    """A row per bracket; a table without brackets has one row, without a position."""
    tables = _named(snapshots).select(*_NAME, F.explode("tables").alias("_t")).select(*_NAME, "_t.*")
    return tables.select(
        *_NAME, "program", "table_index", "effective_date", F.posexplode_outer("brackets").alias("position", "bracket")
    )


def _places(history: str, place: int) -> str:
    return f"{history}/_places/{place}"


def stream_delta(
    snapshots: DataFrame, history: str, out: str, checkpoint: str, known: DataFrame | None = None
) -> StreamingQuery:
    """Deltas of arriving snapshots against the ones before them.

    ``snapshots`` streams one row per snapshot: ID, structural_error and ``tables``, an
    array of (program, table_index, effective_date, brackets); an element of brackets
    may carry its own bracket_index, else its position counts. So a snapshot is always
    complete, and one whose id was there already is ignored.

    Every source's version ids are state; their tables are not, so a snapshot of any size
    costs the state a few words. Tables are stored as they arrive, a row per bracket, in
    the folder ``_arrived`` of ``history``; the state knows the ``place`` of every version, which
    is the time of its batch (a replay keeps it), and ``_places`` the batch of a place. A batch is diffed with the
    versions known and with its own earlier ones, in capture order; a late snapshot is diffed
    with what precedes it and rewrites nothing. So a batch reads the places of the versions it
    is compared with, whatever the length of the history. ``known`` holds snapshots that were
    there before the first batch. Both tables, ``history`` (each version with the id of the
    one before it) and ``out`` (delta records), have a folder per batch, so a replay
    overwrites itself.
    """
    spark = snapshots.sparkSession
    kind = snapshots.schema["tables"].dataType
    own_index = "bracket_index" in kind.elementType["brackets"].dataType.elementType.fieldNames()
    source = ["carrier", "source_id"]
    if known is not None and known.schema["tables"].dataType != kind:
        known = known.withColumn("tables", F.from_json(F.to_json("tables", {"ignoreNullFields": "false"}), kind))
    start = None if known is None else _versions(known, F.lit(_KNOWN).cast("bigint")).groupBy(*source)
    now = F.unix_micros(F.current_timestamp())
    paired = _versions(snapshots, now).groupBy(*source).transformWithState(
        _Versions(), StructType.fromDDL(_PAIRED), "Append", "None", start
    )
    # One write takes both from a batch: its new versions and the rows of all its tables.
    arriving = paired.withColumn("_version", F.lit(True)).unionByName(
        _flat_tables(snapshots).withColumn("_version", F.lit(False)), allowMissingColumns=True
    )
    moment = snapshots.schema["captured_at"].dataType

    def write(batch: DataFrame, batch_id: int) -> None:
        session, arrived = batch.sparkSession, f"{history}/_arrived"

        def read(*names: object) -> DataFrame:
            return session.read.schema(batch.schema).parquet(*[f"{arrived}/batch={name}" for name in names])

        if batch_id == 0 and known is not None:
            _flat_tables(known).withColumn("_version", F.lit(False)).write.mode("overwrite").parquet(f"{arrived}/batch=known")
        batch.write.mode("overwrite").parquet(f"{arrived}/batch={batch_id}")
        folder = f"{history}/batch={batch_id}"
        read(batch_id).filter("_version").select(paired.columns).write.mode("overwrite").parquet(folder)
        rows = session.read.schema(paired.schema).parquet(folder)
        own = rows.select("place").first()
        if own is not None:
            session.range(batch_id, batch_id + 1).write.mode("overwrite").parquet(f"{_places(history, own[0])}/{batch_id}")
        places = {r[0] for r in rows.select("prior_place").distinct().collect()} - {None}
        sought = [_places(history, p) for p in sorted(places - {_KNOWN})]
        batches = session.read.schema("id bigint").option("recursiveFileLookup", True).parquet(*sought).collect() if sought else []
        names = {batch_id} | {r[0] for r in batches} | ({"known"} if _KNOWN in places else set())

        prior = rows.filter(F.col("prior_text").isNotNull()).select(
            *source, F.col("prior_run_id").alias("run_id"), F.col("prior_text").alias("captured_text"), F.col("prior_tie").alias("tie")
        )
        # A version that precedes several counts once; one that was there already, not at all.
        wanted = rows.select(*_NAME).unionByName(prior).distinct()
        at = F.col("captured_text").cast(moment).alias("captured_at")
        used = read(*names).filter(~F.col("_version")).join(wanted, _NAME, "left_semi").withColumn("captured_at", at)
        tables = used.select(*ID, "program", "table_index", "effective_date").distinct()
        brackets = used.filter(F.col("position").isNotNull()).select(
            *ID, "program", "table_index",
            F.col("bracket.bracket_index" if own_index else "position").alias("bracket_index"),
            "bracket.bracket_id", "bracket.index_range", "bracket.surcharge_percent",
        )
        pairs = rows.select(
            *source, "run_id", at, F.col("prior_text").cast(moment).alias("prior_captured_at"), "prior_run_id", "structural_error"
        )
        snapshot_diff(pairs, tables, brackets).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with _rocksdb(spark):
        return (
            arriving.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
