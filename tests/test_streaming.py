"""Streams over several files give the result of one batch run; restarts and re-runs add nothing."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from changeflow.operators import changes, monitor, writeback
from changeflow.sources.scan import raw_changes
from changeflow.streaming import micro
from changeflow.streaming import operators as streaming
from conftest import SMALL

CUTS = ["2024-01-08", "2024-01-15", "2024-01-22", "2030-01-01"]


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{SMALL}/events.parquet")


def land(events, folder, cuts=CUTS, start="2000-01-01"):
    """Files in time order, one per cut."""
    for cut in cuts:
        part = events.filter((F.col("ts") >= start) & (F.col("ts") < cut))
        part.coalesce(1).write.mode("append").parquet(folder)
        start = cut


def source(spark, events, folder):
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def raw(df):
    kind = F.when(F.col("event_type") == "error", "Delete").otherwise("Snapshot")
    return raw_changes(df, "e", "ts", kind).withColumn("event_id", F.col("row.event_id"))


COLUMNS = ["event_id", "change_type", "prev.event_id", "prev.value"]


@pytest.mark.parametrize("ttl", [None, timedelta(hours=20)])
def test_track_changes(spark, events, shared, ttl):
    land(events, f"{shared}/in", CUTS[:2])
    args = (["user_id"], ["source_ts", "event_id"], f"{shared}/out")
    streaming.track_changes(raw(source(spark, events, f"{shared}/in")), *args, ttl=ttl).awaitTermination()
    land(events, f"{shared}/in", CUTS[2:], CUTS[1])  # a restart goes on where the first run stopped
    streaming.track_changes(raw(source(spark, events, f"{shared}/in")), *args, ttl=ttl).awaitTermination()
    got = micro.read_batches(spark, f"{shared}/out/events")
    assert got.select("v").distinct().count() >= 4
    want = changes.with_history(raw(events), ["user_id"], ["source_ts", "event_id"], ttl=ttl)
    assert got.select(*COLUMNS).exceptAll(want.select(*COLUMNS)).count() == 0
    assert got.count() == 1000
    stored = spark.read.format("statestore").option("stateVarName", "value").load(f"{shared}/out/checkpoint")
    last = changes.current_state(raw(events), ["user_id"], ["source_ts", "event_id"])
    assert stored.count() == last.count()  # one value per key, none for deleted keys
    assert "RocksDB" in spark.read.text(f"{shared}/out/checkpoint/offsets/0").select(F.collect_list("value").cast("string")).first()[0]


def test_state_of_a_key_may_expire(spark, shared):
    """With ``keep`` the store forgets a key by itself."""
    import time

    schema = "entity string, change_type string, source_ts timestamp, row struct<id: int>, meta map<string,string>"
    land_change(spark, schema, shared, 1)
    args = (spark.readStream.schema(schema).parquet(f"{shared}/in"), ["id"], ["source_ts"], f"{shared}/out")
    with pytest.raises(ValueError):
        streaming.track_changes(*args, keep=timedelta(seconds=1))
    kinds = lambda: [r.change_type for r in micro.read_batches(spark, f"{shared}/out/events").collect()]
    query = streaming.track_changes(*args, keep=timedelta(seconds=1), every="500 milliseconds")
    try:
        for n in (1, 2):
            if n == 2:
                land_change(spark, schema, shared, 2)
            deadline = time.time() + 40
            while time.time() < deadline and not (micro.versions(spark, f"{shared}/out/events") and len(kinds()) == n):
                time.sleep(0.5)
            time.sleep(2.5)
    finally:
        query.stop()
    assert kinds() == ["Insert", "Insert"]


def land_change(spark, schema, folder, day):
    spark.createDataFrame([("e", "Snapshot", datetime(2026, 1, day), (7,), {})], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def test_batch_run_again_is_the_same(spark, events, shared):
    """The state before a batch does not depend on whether the batch already ran."""
    state = micro.KeyedState(spark, shared, ["k"])
    state.write(spark.sql("select 'a' k, 1 x"), 0)
    state.write(spark.sql("select 'a' k, 2 x union all select 'b', 5"), 1)
    assert [r.x for r in state.before(1).collect()] == [1]
    state.write(spark.sql("select 'a' k, 3 x"), 1)
    assert [r.x for r in state.before(2).collect()] == [3]
    assert state.before(0) is None
    assert state.before(2, spark.sql("select 'zz' k")).count() == 0


def test_a_batch_reads_the_state_of_its_buckets(spark, shared):
    from changeflow.scratch import children

    state = micro.KeyedState(spark, shared, ["k"])
    state.load(spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"), "id"))
    state.write(spark.sql("select 'k7' k, -1L id where false"), 0)  # a batch that changes nothing
    one = state.before(1, spark.sql("select 'k7' k"))
    assert [r.id for r in one.collect()] == [7]
    read = [r for r in one._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in r]
    assert read and all("__b" in r.split("PartitionFilters: [")[1].split("]")[0] for r in read)
    assert len([c for c in children(spark, f"{shared}/base/v=-1") if c.startswith("__b=")]) == 17
    assert state.before(1).count() == 2000


def test_dedup_stream(spark, events, shared):
    rows = events.select("event_id", "user_id", "ts")
    land(rows, f"{shared}/in")
    streaming.dedup_stream(
        source(spark, rows, f"{shared}/in"), "user_id", "ts", f"{shared}/out", timedelta(hours=30), ["event_id"]
    ).awaitTermination()
    got = micro.read_batches(spark, f"{shared}/out/requests").select("event_id", "duplicate")
    want = changes.dedup_requests(rows, "user_id", "ts", timedelta(hours=30), ["event_id"]).select("event_id", "duplicate")
    assert got.exceptAll(want).count() == 0 and got.count() == 1000


def test_late_request_is_a_duplicate(spark, shared):
    schema = "id int, r string, ts timestamp"
    for i, minute in enumerate((30, 10)):
        spark.createDataFrame([(i, "x", datetime(2026, 1, 1, 0, minute))], schema).coalesce(1).write.mode("append").parquet(f"{shared}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{shared}/in")
    streaming.dedup_stream(stream, "r", "ts", f"{shared}/out").awaitTermination()
    assert {r.id: r.duplicate for r in micro.read_batches(spark, f"{shared}/out/requests").collect()} == {0: False, 1: True}


def test_echo_stream(spark, events, shared):
    rows = events.select("event_id", "ts", F.col("user_id").alias("replica_session"))
    sessions = rows.filter("replica_session < 5").select("replica_session")
    land(rows, f"{shared}/in")
    streaming.suppress_echo_stream(source(spark, rows, f"{shared}/in"), sessions, ["ts", "event_id"], f"{shared}/out").awaitTermination()
    got = micro.read_batches(spark, f"{shared}/out/changes").drop("v")
    want = writeback.suppress_echo(rows, sessions, ["ts", "event_id"])
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0 and got.count() == 995


def test_sessions_that_open_while_the_stream_runs(spark, shared):
    schema, opened = "i int, replica_session string", "replica_session string"
    batches = ([(1, "A-1"), (0, "a-1"), (9, None)], [(2, "b-2"), (3, "b-2")], [(4, "a-1")], [(5, "B-2"), (6, "c-3")])
    for rows, names in zip(batches, (["a-1"], [], ["B-2", "A-1"], ["zz", None])):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{shared}/in")
        spark.createDataFrame([(n,) for n in names], opened).write.mode("append").parquet(f"{shared}/sessions")
        stream, sessions = spark.readStream.schema(schema).parquet(f"{shared}/in"), spark.readStream.schema(opened).parquet(f"{shared}/sessions")
        streaming.suppress_echo_stream(stream, sessions, ["i"], f"{shared}/out").awaitTermination()
    # b-2 opened after its first changes: the next one is dropped
    assert sorted(r.i for r in micro.read_batches(spark, f"{shared}/out/changes").collect()) == [1, 2, 3, 4, 6, 9]


def test_late_heartbeats_are_counted(spark, shared):
    for day in (9, 1, 5):
        spark.createDataFrame([(datetime(2026, 1, day), "d")], "ts timestamp, driver_id string").coalesce(1).write.mode("append").parquet(f"{shared}/in")
    stream = spark.readStream.schema("ts timestamp, driver_id string").option("maxFilesPerTrigger", 1).parquet(f"{shared}/in")
    streaming.heartbeat_stream(stream, f"{shared}/out").awaitTermination()
    assert [r.events for r in streaming.read_heartbeats(spark, f"{shared}/out").collect()] == [1, 1, 1]


def test_heartbeat_stream(spark, events, shared):
    rows = events.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("driver_id"))
    land(rows, f"{shared}/in")
    streaming.heartbeat_stream(source(spark, rows, f"{shared}/in"), f"{shared}/out", "1 hour").awaitTermination()
    got = streaming.read_heartbeats(spark, f"{shared}/out")
    want = monitor.heartbeats(rows, "1 hour").select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_builtin_dedup(spark, events, shared):
    rows = events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    land(rows, f"{shared}/in")
    out = streaming.drop_within_watermark(source(spark, rows, f"{shared}/in"), "user_id", "ts", "5 minutes")
    micro.run(out, lambda df, n: micro.write_batch(df, f"{shared}/out", n), f"{shared}/cp").awaitTermination()
    kept = micro.read_batches(spark, f"{shared}/out")
    assert 15 <= kept.count() < 1000
    assert kept.select("user_id").distinct().count() == events.select("user_id").distinct().count()


def test_poll_runs_the_scan(spark, shared):
    seen = []
    query = micro.poll(spark, seen.append, f"{shared}/cp", "1 second")
    deadline = datetime.now() + timedelta(seconds=40)
    while len(seen) < 2 and datetime.now() < deadline:
        query.awaitTermination(1)
    query.stop()
    assert seen[:2] == [0, 1]


def test_publish_changes(spark, events, shared):
    from changeflow.plans.forward import Driver, change_events
    from changeflow.sinks.tables import read_version

    land(events, f"{shared}/in", CUTS[:2])
    driver = Driver("d1", "pg", "ctx:A")
    row_id = lambda df: df.withColumnRenamed("event_id", "row_id")

    def start():
        raw_stream = row_id(raw(source(spark, events, f"{shared}/in")))
        streaming.publish_changes(raw_stream, driver, ["user_id"], ["source_ts", "row_id"], f"{shared}/out", F.col("source_ts"), max_bytes=464).awaitTermination()

    start()
    land(events, f"{shared}/in", CUTS[2:], CUTS[1])
    start()
    got = micro.read_batches(spark, f"{shared}/out/events")
    want = change_events(row_id(raw(events)), driver, ["user_id"], ["source_ts", "row_id"], F.col("source_ts"), sequence=True)
    columns = ["row_id", "event_id", "seq", "change_type", "subject", "prev.value"]
    assert got.select(*columns).exceptAll(want.select(*columns)).count() == 0 and got.count() == 1000
    assert {r.reason for r in got.filter("outcome = 'dead_lettered'").select("reason").distinct().collect()} == {"too large"}
    assert 0 < got.filter("outcome = 'dead_lettered'").count() < 1000
    position = read_version(spark, f"{shared}/out/checkpoints").first()
    assert position.position[:26] == events.agg(F.max("ts")).first()[0].isoformat()


def test_apply_command_stream(spark, events, shared):
    op = F.when(F.col("event_type") == "signup", "Create").when(F.col("event_type") == "error", "Delete").otherwise("Update")
    cmds = events.select(F.col("event_id").cast("string").alias("correlation_id"), "ts", op.alias("operation"), F.col("user_id").alias("k"), "value")
    rows = spark.range(40).select(F.col("id").alias("k"), F.lit(0.0).alias("value"))
    table = streaming.CommandTable(spark, f"{shared}/table", ["k"])
    with pytest.raises(ValueError):
        table.read()
    table.load(rows)
    land(cmds, f"{shared}/in")
    streaming.apply_command_stream(source(spark, cmds, f"{shared}/in"), table, ["ts"], f"{shared}/out").awaitTermination()
    after, results = writeback.apply_commands(rows, cmds, ["k"], ["ts"])
    got = table.read()
    assert got.exceptAll(after).count() == 0 and after.exceptAll(got).count() == 0 and got.count() > 25
    done = micro.read_batches(spark, f"{shared}/out/results").select("correlation_id", "success")
    assert done.exceptAll(results.select("correlation_id", "success")).count() == 0 and done.count() == 1000


def test_folding_drops_what_is_covered(spark, shared):
    from changeflow.scratch import children

    state = micro.KeyedState(spark, shared, ["k"], compact_every=2)
    for n in range(6):
        state.write(spark.sql(f"select 'a' k, {n} x union all select 'k{n}', {n}"), n, live="x >= 0")
        assert {r.k: r.x for r in state.before(n + 1).collect()} == {"a": n} | {f"k{i}": i for i in range(n + 1)}
    assert sorted(children(spark, f"{shared}/base")) == ["v=3", "v=5"]
    assert sorted(children(spark, f"{shared}/delta")) == ["v=4", "v=5"]
    state.write(spark.sql("select 'a' k, 50 x"), 5)  # run again
    assert [r.x for r in state.before(6).filter("k = 'a'").collect()] == [50]


def test_scan_step(spark, shared):
    from changeflow.spec import Entity
    from changeflow.streaming.polling import scan_step

    tables = {"a": [(1, datetime(2026, 1, 1, 0, 30)), (2, datetime(2025, 12, 31))], "b": []}
    load = lambda e: spark.createDataFrame(tables[e.name], "id int, updated_at timestamp")
    step = scan_step(spark, "d", [Entity("a", ("id",)), Entity("b", ("id",))], load, shared, now=lambda: datetime(2026, 1, 1, 1))
    ids = lambda: sorted((r.v, r.pk) for r in micro.read_batches(spark, f"{shared}/changes").collect())
    step(0)
    tables["a"].append((3, datetime(2026, 1, 1, 0, 45)))
    tables["b"].append((9, datetime(2026, 1, 1, 0, 10)))
    step(1)
    assert ids() == [(0, '{"id":1}'), (1, '{"id":3}'), (1, '{"id":9}')]
    step(1)  # run again: the same rows
    assert ids() == [(0, '{"id":1}'), (1, '{"id":3}'), (1, '{"id":9}')]
    step(2)
    assert len(ids()) == 3


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_scan_step_in_any_process_zone(spark, shared, monkeypatch, zone):
    """The stored watermark is a moment, whatever zone this process runs in."""
    import time

    from changeflow.spec import Entity
    from changeflow.streaming.polling import scan_step

    rows = [(1, "2026-01-01 06:00:00")]
    load = lambda e: spark.createDataFrame(rows, "id int, t string").select("id", F.to_timestamp("t").alias("updated_at"))
    step = scan_step(spark, "d", [Entity("a", ("id",))], load, shared, now=lambda: datetime(2026, 1, 1, 6, 30))
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        step(0)
        rows += [(2, "2026-01-01 08:00:00"), (3, "2026-01-01 05:00:00")]
        step(1)
        step(2)
    finally:
        monkeypatch.undo()
        time.tzset()
    assert sorted((r.v, r.pk) for r in micro.read_batches(spark, f"{shared}/changes").collect()) == [(0, '{"id":1}'), (1, '{"id":2}')]


def test_snapshot_cycle(spark, shared):
    from changeflow.sources.scan import snapshot_cycle

    make = lambda rows: spark.createDataFrame(rows, "id int, wm timestamp")
    day = lambda d: datetime(2026, 1, d)
    first = snapshot_cycle(make([(1, day(1)), (2, None)]), shared, ["id"], "wm", day(1))
    assert first.count() == 0
    second = snapshot_cycle(make([(3, day(2))]), shared, ["id"], "wm", day(1)).orderBy("phase", "id").collect()
    assert [(r.phase, r.change_type, r.id) for r in second] == [(0, "Delete", 1), (0, "Delete", 2), (1, "Snapshot", 3)]


def test_own_source(spark, shared):
    """A Python data source that yields raw changes works like any other source."""
    from pyspark.sql.datasource import DataSource, DataSourceReader

    class Meter(DataSource):
        @classmethod
        def name(cls):
            return "meter"

        def schema(self):
            return "entity string, change_type string, source_ts timestamp, row struct<id: int, v: int>, meta map<string,string>"

        def reader(self, schema):
            class Reader(DataSourceReader):
                def read(self, partition):
                    from datetime import datetime

                    for i, v in enumerate((5, 6, 7)):
                        yield ("m", "Snapshot", datetime(2026, 1, 1 + i), (1, v), {})

            return Reader()

    spark.dataSource.register(Meter)
    out = changes.with_history(spark.read.format("meter").load(), ["id"], ["source_ts"]).orderBy("source_ts")
    assert [(r.change_type, r.prev.v if r.prev else None) for r in out.collect()] == [("Insert", None), ("Update", 5), ("Update", 6)]


def test_feed_source_reads_offset_ranges(spark, shared):
    """Skips what was there before the first start, at most some versions a batch, goes on after a restart, waits for complete versions."""
    from changeflow.sources.feed_stream import ChangeFeed

    spark.dataSource.register(ChangeFeed)

    def land(version, rows, schema="k int, a string", done=True):
        spark.createDataFrame(rows, schema).write.parquet(f"{shared}/feed/_commit_version={version}")
        if not done:
            from changeflow.scratch import remove

            remove(spark, f"{shared}/feed/_commit_version={version}/_SUCCESS")

    def go(most=None, **options):
        reader = spark.readStream.format("change_feed").schema("_commit_version long, a string, k long, late double")
        reader = reader.options(path=f"{shared}/feed", position=f"{shared}/position", **options)
        stream = (reader.option("maxVersionsPerTrigger", most) if most else reader).load()
        micro.run(stream, lambda df, n: micro.write_batch(df, f"{shared}/out", n), f"{shared}/cp").awaitTermination()

    rows = lambda: sorted((r._commit_version, r.k, r.a, r.late) for r in micro.read_batches(spark, f"{shared}/out").collect())
    land(0, [(1, "old")])
    go()
    land(3, [(2, "x"), (3, None)])
    land(4, [(4, "y")])
    land(5, [(9, "not complete")], done=False)
    go()
    assert rows() == [(3, 2, "x", None), (3, 3, None, None), (4, 4, "y", None)]
    land(6, [(5, 1.5)], "k long, late double")
    go()
    assert rows()[3:] == [(6, 5, None, 1.5)]
    go()
    assert len(rows()) == 4
    with pytest.raises(Exception, match="position"):
        spark.readStream.format("change_feed").schema("k int").option("path", shared).load().writeStream.format("noop").option("checkpointLocation", f"{shared}/x").start().awaitTermination(20)


def test_committed_sink_stores_each_row_once(spark, shared):
    from changeflow.sinks.stream_sink import CommittedFiles, commits, read_committed, staged_only

    spark.dataSource.register(CommittedFiles)
    bad = [True]

    def go():
        stream = spark.readStream.schema("i long").parquet(f"{shared}/in")
        value = F.when(F.lit(bad[0]) & (F.col("i") == 70), F.raise_error(F.lit("one failure"))).otherwise(F.col("i"))
        query = stream.select(value.cast("long").alias("i")).writeStream.format("committed_files").option("path", f"{shared}/out")
        query.option("checkpointLocation", f"{shared}/cp").trigger(availableNow=True).start().awaitTermination()

    spark.range(100).toDF("i").repartition(4).write.parquet(f"{shared}/in")
    with pytest.raises(Exception, match="one failure"):
        go()
    assert commits(f"{shared}/out") == {} and read_committed(spark, f"{shared}/out", "i long").count() == 0
    bad[0] = False
    go()
    spark.range(100, 110).toDF("i").write.mode("append").parquet(f"{shared}/in")
    go()
    assert sorted(r.i for r in read_committed(spark, f"{shared}/out", "i long").collect()) == list(range(110))
    assert [c["rows"] for c in commits(f"{shared}/out").values()] == [100, 10]
    from changeflow.sinks.stream_sink import FilesWriter, Staged

    files = commits(f"{shared}/out")[1]["files"]
    FilesWriter(f"{shared}/out").commit([*(Staged(f, 1) for f in files), None], 1)  # run again with the same result: nothing is lost
    FilesWriter(f"{shared}/out").abort([Staged("part-none.parquet", 1)], 2)
    assert read_committed(spark, f"{shared}/out", "i long").count() == 110 and not set(staged_only(f"{shared}/out")) & set(files)


def test_published_rows_are_made_in_many_tasks(spark, events, shared):
    """One driver is one group: only its numbers are made in order, images and envelopes by key."""
    from changeflow.plans.forward import Driver

    land(events, f"{shared}/in", CUTS[-1:])
    rows = raw(source(spark, events, f"{shared}/in")).withColumnRenamed("event_id", "row_id")
    streaming.publish_changes(rows, Driver("d1", "pg", "ctx:A"), ["user_id"], ["source_ts", "row_id"], f"{shared}/out", F.col("source_ts")).awaitTermination()
    got = micro.read_batches(spark, f"{shared}/out/events")
    assert len(got.inputFiles()) > 1
    assert [r.seq for r in got.orderBy("source_ts", "row_id").select("seq").collect()] == list(range(1, 1001))


def test_newest_rows_of_null_and_float_keys(spark, shared):
    """Keys that Spark groups as one (nulls, NaN, both zeros) have one newest row; a Delete clears it."""
    schema = "entity string, change_type string, source_ts timestamp, row struct<id: double, n: int>, meta map<string,string>"
    batches = [[(None, 1), (float("nan"), 2), (-0.0, 3), (1.5, 4)], [(None, 5), (float("nan"), 6), (0.0, 7), (1.5, 8)], [(1.5, 9)]]
    for i, rows in enumerate(batches):
        kind = lambda n: "Delete" if n == 8 else "Snapshot"
        spark.createDataFrame([("e", kind(n), datetime(2026, 1, 1 + i), (k, n), None) for k, n in rows], schema).write.mode("append").parquet(f"{shared}/in")
        streaming.track_changes(spark.readStream.schema(schema).parquet(f"{shared}/in"), ["id"], ["source_ts"], f"{shared}/out").awaitTermination()
    got = {r.row.n: (r.change_type, r.prev.n if r.prev else None) for r in micro.read_batches(spark, f"{shared}/out/events").collect()}
    first = {n: ("Insert", None) for n in (1, 2, 3, 4)}
    assert got == first | {5: ("Update", 1), 6: ("Update", 2), 7: ("Update", 3), 8: ("Delete", 4), 9: ("Insert", None)}


def test_landed_pieces_are_dealt_over_files(spark, shared, monkeypatch):
    from changeflow.plans import stream_queries

    monkeypatch.setattr(stream_queries, "shared_path", lambda *_: f"{shared}/landed")
    start = lambda s: micro.run(s, lambda df, n: micro.write_batch(df, f"{shared}/out", n), f"{shared}/checkpoint")
    stream_queries.restarted([spark.range(4_000).coalesce(1)], start)
    sizes = [r[1] for r in spark.read.parquet(f"{shared}/landed").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 1_000 and micro.read_batches(spark, f"{shared}/out").count() == 4_000
