from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from changeflow.scratch import children
from changeflow.sinks import checkpoints as cp
from changeflow.sinks import tables


def positions(spark, rows):
    return spark.createDataFrame(rows, "driver_id string, entity string, position string, updated_at string")


def test_an_append_opens_only_its_folders(spark, shared):
    day = lambda d: f"{(d * 86_400_000):012x}"
    rows = [(f"{day(d)}-{i}", i) for d in range(30) for i in range(40)] + [("no prefix", 1)]
    events = spark.createDataFrame(rows, "event_id string, n int")
    tables.append_if_absent(events, shared)
    one = events.filter(F.col("event_id").startswith(day(3)) & (F.col("n") < 2))
    slots = [(r.id_day, r.id_bucket) for r in one.select(*[c.alias(n) for n, c in tables.id_slots().items()]).distinct().collect()]
    table = spark.read.parquet(shared)
    part = tables.stored_slots(table, slots)
    assert 1 <= len(part.inputFiles()) and part.select(F.input_file_name()).distinct().count() <= 2 < len(table.inputFiles()) // 10
    for _ in range(2):
        tables.append_if_absent(one.unionByName(spark.createDataFrame([(f"{day(3)}-new", 7)], events.schema)), shared)
    assert spark.read.schema(events.schema).parquet(shared).count() == len(rows) + 1
    assert {r.id_day for r in table.select("id_day").distinct().collect()} == {f"1970-01-{d + 1:02d}" for d in range(30)} | {"none"}


def test_outcomes_are_counted_while_they_are_written(spark, shared):
    rows = [(i, "a.b" if i % 3 else "", "x" * i) for i in range(30)]
    df = spark.createDataFrame(rows, "i int, subject string, envelope string")
    first, second = tables.write_outcomes(df, shared, max_bytes=20), tables.write_outcomes(df, shared, max_bytes=20)
    assert first == {"published": 14, "dead_lettered": 16, "retried": 0} and second["retried"] == 14
    stored = spark.read.parquet(f"{shared}/run=0")
    good, dead = tables.split_dead_letters(df, max_bytes=20)
    assert {r.i for r in stored.filter("outcome = 'published'").collect()} == {r.i for r in good.collect()}
    assert {(r.i, r.reason, r.subject) for r in stored.filter("outcome = 'dead_lettered'").collect()} == {(r.i, r.reason, r.subject) for r in dead.collect()}


def test_expired_days_can_be_dropped(spark, shared):
    rows = spark.sql("select 'd' driver_id, timestamp '2026-01-01 05:00:00' + make_interval(0, 0, 0, cast(id as int)) detected_at from range(5)")
    tables.write_events(rows, shared)
    assert len(tables.drop_expired(spark, shared, datetime(2026, 1, 4, 12))) == 2
    assert spark.read.parquet(shared).count() == 3


def test_checkpoints_overwrite_and_stay_apart(spark, shared):
    cp.save_checkpoints(positions(spark, [("d1", "a", "1", "t"), ("d1", "b", "2", "t"), ("d2", "a", "3", "t")]), shared)
    cp.save_checkpoints(positions(spark, [("d1", "a", "9", "u")]), shared)
    got = {(r.driver_id, r.entity): r.position for r in tables.read_version(spark, shared).collect()}
    assert got == {("d1", "a"): "9", ("d1", "b"): "2", ("d2", "a"): "3"}
    assert tables.versions(spark, shared) == [0, 1]


def test_failed_write_keeps_the_old_version(spark, shared):
    tables.write_version(spark.range(3), shared)
    broken = spark.range(3).select(F.raise_error(F.lit("load failed")).alias("id"))
    with pytest.raises(Exception, match="load failed"):
        tables.write_version(broken, shared)
    assert tables.read_version(spark, shared).count() == 3
    assert tables.versions(spark, shared) == [0]


def test_no_version_yet(spark, shared):
    assert tables.read_version(spark, shared) is None


def log(spark, n=2000):
    """One driver holds most of the events."""
    return spark.range(n).select(
        F.when(F.col("id") % 10 == 0, "small").otherwise("big").alias("driver_id"),
        F.lit(None).cast("timestamp").alias("source_ts"), F.timestamp_seconds(F.col("id") * 100).alias("detected_at"), F.col("id").alias("seq"), F.lit("t").alias("entity"),
        F.concat(F.lit("e"), "id").alias("event_id"), F.concat(F.lit("cdc."), F.col("id") % 2).alias("subject"),
    )


def test_event_log_layout_replay_and_retention(spark, shared):
    tables.write_events(log(spark), shared)
    assert sorted(c for c in children(spark, shared) if "=" in c) == ["driver_id=big", "driver_id=small"]
    assert tables.replay(spark, shared).count() == 2000
    assert tables.replay(spark, shared, "cdc.1", since=1000).count() == 500
    plan = tables.replay(spark, shared).filter("driver_id = 'big'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(driver_id" in plan
    now = datetime(1970, 1, 3, 12)
    assert tables.expired_days(spark, shared, now) == ["driver_id=big/event_date=1970-01-01", "driver_id=small/event_date=1970-01-01"]
    kept = tables.retain(tables.replay(spark, shared), now, timedelta(days=1))
    assert kept.agg(F.min("detected_at")).first()[0] >= datetime(1970, 1, 2, 12)
    assert 0 < kept.count() < 2000


def test_replay_of_a_driver_and_a_range(spark, shared):
    for _ in range(2):  # a run that is repeated replaces its own events
        tables.write_events(log(spark), shared, run=7)
    assert tables.replay(spark, shared).count() == 2000
    out = tables.replay(spark, shared, driver="big", start=datetime(1970, 1, 2), end=datetime(1970, 1, 2, 1))
    assert sorted(r.seq for r in out.collect()) == [i for i in range(864, 900) if i % 10]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(driver_id" in plan and "event_date" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert tables.replay(spark, shared, since={"big": 1990}).count() == 200 + 9
    assert tables.expired_days(spark, shared, datetime(1970, 1, 3, 12)) == ["run=7/driver_id=big/event_date=1970-01-01", "run=7/driver_id=small/event_date=1970-01-01"]


def test_a_checkpoint_needs_an_order(spark):
    with pytest.raises(Exception, match="a checkpoint needs seq"):
        cp.checkpoints(log(spark, 5).withColumn("seq", F.lit(None).cast("int"))).collect()


def test_positions_of_other_kinds(spark):
    state = spark.createDataFrame([("d", "t", 12), ("d", "u", 7)], "driver_id string, entity string, version long")
    stored = cp.positions(state, "version")
    rows = spark.createDataFrame([("d", "t", v) for v in (11, 12, 13, 100)] + [("d", "v", 3)], "driver_id string, entity string, version long")
    assert sorted(r.version for r in cp.resume(rows, stored, "version", 0).collect()) == [3, 13, 100]
    assert {r.position for r in cp.position_of(stored, "long").collect()} == {12, 7}
    events = spark.createDataFrame([("d", "t", datetime(2026, 1, 1), i) for i in (1, 2, 2030)], "driver_id string, entity string, ts timestamp, n long")
    by_id = positions(spark, [("d", "t", "2", "")])
    assert [r.n for r in cp.resume(events, by_id, "ts", datetime(2025, 1, 1), id_col="n").collect()] == [2030]
    with pytest.raises(Exception, match="position is no watermark"):
        cp.resume(events, by_id, "ts", datetime(2025, 1, 1)).collect()


def test_append_twice_adds_nothing(spark, shared):
    events = log(spark, 50)
    for _ in range(2):
        tables.append_if_absent(events.unionByName(events), shared, order=["seq"])
    assert spark.read.parquet(shared).count() == 50


def test_first_copy_is_stored(spark):
    events = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "event_id string, n int")
    out = tables.new_rows(events, spark.createDataFrame([("b", 0)], "event_id string, n int"), order=["n"])
    assert [tuple(r) for r in out.collect()] == [("a", 1)]


def test_kind_codes(spark):
    df = spark.createDataFrame([(k,) for k in tables.CHANGE_KINDS] + [("x",)], "change_type string")
    assert [r[0] for r in df.select(tables.kind_code()).collect()] == [0, 1, 2, 3, 4, 5, None]


def test_position_is_last_not_greatest(spark):
    df = spark.createDataFrame(
        [("d", "t", datetime(2026, 1, 2), "e1", 1), ("d", "t", datetime(2026, 1, 1), "e2", 2), ("d", "u", None, "e3", 3)],
        "driver_id string, entity string, source_ts timestamp, event_id string, seq int",
    ).withColumn("detected_at", F.col("source_ts"))
    got = {r.entity: r.position for r in cp.checkpoints(df).collect()}
    assert got == {"t": "2026-01-01T00:00:00.0000000+00:00", "u": "e3"}


def test_resume_parses_positions(spark):
    df = spark.createDataFrame([("d", "t", datetime(2026, 1, d)) for d in (1, 2, 3)], "driver_id string, entity string, ts timestamp")
    stored = positions(spark, [("d", "t", "2026-01-02T00:00:00.0000000+00:00", "")])
    assert [r.ts.day for r in cp.resume(df, stored, "ts", datetime(2025, 1, 1)).collect()] == [3]
    assert cp.resume(df, stored.limit(0), "ts", datetime(2026, 1, 1)).count() == 2
