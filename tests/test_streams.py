from pyspark.sql import functions as F

from ratelake.streaming.jobs import stream_dedup, stream_delta

ROW = "s string, p string, at timestamp, v int"


def land(spark, path, rows):
    spark.createDataFrame(rows, "s string, p string, at string, v int").withColumn(
        "at", F.col("at").cast("timestamp")
    ).coalesce(1).write.mode("append").parquet(path)


def test_dedup_over_restarts(spark, tmp_path):
    source, out, check = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check"
    batches = [
        [("a", "1", "2026-01-01 00:00:00", 1), ("a", "1", "2026-01-01 01:00:00", 2), ("b", "1", "2026-01-01 00:00:00", 3)],
        # Days later: a repeat beyond the watermark, and a new key.
        [("a", "1", "2026-01-09 00:00:00", 4), ("c", "1", "2026-01-09 00:00:00", 5)],
        [],
        # A new key that is older than everything seen.
        [("z", "1", "2026-01-01 00:00:00", 6), ("a", "1", "2025-01-01 00:00:00", 7)],
    ]
    for rows in batches:
        if rows:
            land(spark, source, rows)
        stream = spark.readStream.schema(ROW).parquet(source)
        stream_dedup(stream, ["s", "p"], ["at"], out, check).awaitTermination()
    got = spark.read.parquet(out).collect()
    assert sorted((r.s, r.p, r.v) for r in got) == [("a", "1", 1), ("b", "1", 3), ("c", "1", 5), ("z", "1", 6)]


def test_dedup_rules(spark, tmp_path):
    """Null keys never conflict; nulls come last in a batch; taken keys stay taken."""
    source, out, check = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check"
    taken = spark.createDataFrame([("t", "1"), ("t", "1"), (None, "1")], "s string, p string")
    for rows in (
        [("a", "1", None, 1), ("a", "1", "2026-01-02 00:00:00", 2), (None, "1", None, 3), (None, "1", None, 4), ("t", "1", None, 5)],
        [(None, "1", None, 6), ("a", "1", "2020-01-01 00:00:00", 7), ("t", "2", None, 8), ("b", None, None, 9)],
    ):
        land(spark, source, rows)
        stream = spark.readStream.schema(ROW).parquet(source)
        stream_dedup(stream, ["s", "p"], ["at", "v"], out, check, ["p"], existing=taken).awaitTermination()
    got = spark.read.schema(ROW).parquet(out).collect()
    assert sorted(r.v for r in got) == [2, 3, 4, 6, 8, 9]


def test_dedup_reads_no_table(spark, tmp_path):
    """A batch's plan scans its own files only, and its state is keyed."""
    source, out, check = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check"
    for k in range(2):
        land(spark, source, [(str(k), "1", "2026-01-01 00:00:00", k)])
        query = stream_dedup(spark.readStream.schema(ROW).parquet(source), ["s", "p"], ["at"], out, check)
        query.awaitTermination()
        assert sum(s["numInputRows"] for p in query.recentProgress for s in p["sources"]) in (1, 2)
    plan = query._jsq.explainInternal(True)
    physical = plan.split("== Physical Plan ==")[1]
    assert "TransformWithState" in physical
    assert all("/in" in scan.split("]")[0] for scan in physical.split("Location: ")[1:])


SNAPSHOT = (
    "carrier string, source_id string, run_id string, captured_at string, structural_error boolean, "
    "tables array<struct<program:string,table_index:int,effective_date:string,"
    "brackets:array<struct<bracket_id:string,index_range:string,surcharge_percent:double>>>>"
)


def snapshot(source_id, run, at, *tables):
    return ("ups", source_id, run, at, False, [
        ("ground", k, "2026-01-01", [(b, b, v) for b, v in values.items()]) for k, values in enumerate(tables)
    ])


def run_deltas(spark, tmp_path, batches):
    source, check = f"{tmp_path}/in", f"{tmp_path}/check"
    for rows in batches:
        spark.createDataFrame(rows, SNAPSHOT).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SNAPSHOT).parquet(source)
        stream_delta(stream, f"{tmp_path}/tables", f"{tmp_path}/deltas", check).awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/deltas").collect()
    return sorted((r.source_id, r.captured_at, r.bracket_id, r.prior_captured_at, r.old_value, r.new_value) for r in rows)


def test_delta_over_batches(spark, tmp_path):
    got = run_deltas(spark, tmp_path, [
        [snapshot("s1", "r1", "2026-01-01", {"a": 1.0, "b": 2.0}), snapshot("s2", "r1", "2026-01-01", {"a": 9.0})],
        [snapshot("s1", "r3", "2026-01-03", {"a": 1.0, "b": 3.0})],
        [snapshot("s1", "r2", "2026-01-02", {"a": 5.0})],  # late: compared with what precedes it
        [snapshot("s1", "r1", "2026-01-01", {"a": 1.0, "b": 2.0}), snapshot("s1", "r3", "2026-01-03", {"c": 7.0})],  # delivered again
    ])
    assert got == [
        ("s1", "2026-01-01", "a", None, None, 1.0), ("s1", "2026-01-01", "b", None, None, 2.0),
        ("s1", "2026-01-02", "a", "2026-01-01", 1.0, 5.0), ("s1", "2026-01-02", "b", "2026-01-01", 2.0, None),
        ("s1", "2026-01-03", "b", "2026-01-01", 2.0, 3.0),
        ("s2", "2026-01-01", "a", None, None, 9.0),
    ]


def test_delta_of_several_tables(spark, tmp_path):
    got = run_deltas(spark, tmp_path, [
        [snapshot("s1", "r1", "2026-01-01", {"a": 1.0, "b": 2.0})],
        [snapshot("s1", "r2", "2026-01-02", {"a": 9.0}, {"b": 2.0})],
    ])
    assert got[2:] == [("s1", "2026-01-02", "a", "2026-01-01", 1.0, 9.0)]


def test_delta_times_are_instants(spark, tmp_path):
    got = run_deltas(spark, tmp_path, [
        [snapshot("s1", "r1", "2026-01-01T12:00:00Z", {"a": 1.0}), snapshot("s1", "r2", "2026-01-01T13:00:00+05:00", {"a": 2.0})],
        [snapshot("s1", "r3", "soon", {"a": 3.0})],
    ])
    assert [(r[1], r[3]) for r in got] == [
        ("2026-01-01T12:00:00Z", "2026-01-01T13:00:00+05:00"), ("2026-01-01T13:00:00+05:00", None), ("soon", None),
    ]


def test_delta_of_a_known_history(spark, tmp_path):
    """Versions from before the stream are state from the start; the own run is no prior."""
    known = spark.createDataFrame([
        snapshot("s1", "r0", "2025-01-01", {"a": 1.0}), snapshot("s1", "r9", "2026-01-05", {"a": 2.0}),
        snapshot("s2", "r1", "2026-01-01", {"a": 4.0}),
    ], SNAPSHOT)
    source, check = f"{tmp_path}/in", f"{tmp_path}/check"
    for rows in (
        [snapshot("s1", "r9", "2026-01-06", {"a": 3.0}), snapshot("s2", "r1", "2026-01-01", {"z": 0.0})],
        [snapshot("s1", "r1", "2026-01-07", {"a": 5.0}), snapshot("s1", "r8", "2026-01-07", {"a": 6.0})],
        [snapshot("s1", "r7", "2026-01-08", {"a": 7.0}), snapshot("s3", "r1", None, {"a": 8.0}), snapshot("s3", "r1", None, {"a": 8.0})],
    ):
        spark.createDataFrame(rows, SNAPSHOT).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SNAPSHOT).parquet(source)
        stream_delta(stream, f"{tmp_path}/tables", f"{tmp_path}/deltas", check, known).awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/deltas").collect()
    got = sorted((r.source_id, str(r.captured_at), r.run_id, r.prior_captured_at, r.old_value, r.new_value) for r in rows)
    assert got == [
        ("s1", "2026-01-06", "r9", "2025-01-01", 1.0, 3.0),
        ("s1", "2026-01-07", "r1", "2026-01-06", 3.0, 5.0), ("s1", "2026-01-07", "r8", "2026-01-06", 3.0, 6.0),
        ("s1", "2026-01-08", "r7", "2026-01-07", 5.0, 7.0),
    ]
    # A batch holds its versions, each with one prior: as many rows as arrived and are new.
    stored = spark.read.parquet(f"{tmp_path}/tables").groupBy("batch").count().collect()
    assert sorted(r["count"] for r in stored) == [1, 2, 2]


def test_delta_keeps_tables_out_of_state(spark, tmp_path):
    """State holds ids only, so a large snapshot does not pass through it; of one id that comes
    twice in a batch, one content counts; a table without brackets is one."""
    big = {f"b{k}": float(k) for k in range(20_000)}
    source, check = f"{tmp_path}/in", f"{tmp_path}/check"
    for rows in (
        [snapshot("s1", "r1", "2026-01-01", big)],
        [snapshot("s1", "r2", "2026-01-02", {**big, "b7": 0.5}), snapshot("s1", "r3", "2026-01-03", {}, {"b7": 1.0})],
        [snapshot("s2", "r1", "2026-01-01", {"a": 1.0}), snapshot("s2", "r1", "2026-01-01", {"z": 2.0})],
    ):
        spark.createDataFrame(rows, SNAPSHOT).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SNAPSHOT).parquet(source)
        stream_delta(stream, f"{tmp_path}/tables", f"{tmp_path}/deltas", check).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/deltas").groupBy("source_id", "captured_at").count().collect()
    assert sorted((r.source_id, r.captured_at, r["count"]) for r in got) == [
        ("s1", "2026-01-01", 20_000), ("s1", "2026-01-02", 1), ("s1", "2026-01-03", 20_000), ("s2", "2026-01-01", 1),
    ]
    state = sum(f.stat().st_size for f in (tmp_path / "check" / "state").rglob("*") if f.is_file())
    assert state < 200_000
