from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from changeflow.functions.values import cold_start, moment, normalise_watermark, parse_duration
from changeflow.sources import documents, feeds, scan
from changeflow.spec import Entity
from conftest import SMALL


@pytest.mark.parametrize(
    "text, hours",
    [("PT1H", 1), ("PT90M", 1.5), ("P1D", 24), ("P1DT12H", 36), ("-PT2H", -2), ("PT0.5S", 0.5 / 3600), ("P1Y", 8760), ("junk", 1), ("", 1),
     (None, 1), ("P", 1), ("PT", 1)],
)
def test_durations(text, hours):
    assert parse_duration(text) == timedelta(hours=hours)


def test_cold_start():
    assert cold_start(datetime(2026, 1, 1), "bad") == datetime(2025, 12, 31, 23)


def test_moment_is_zone_safe(spark):
    aware = datetime(2026, 1, 1, 12, tzinfo=timezone(timedelta(hours=2)))
    for name in ("timestamp", "timestamp_ntz"):
        dtype = spark.sql(f"select cast(null as {name}) t").schema["t"].dataType
        assert spark.range(1).select(moment(aware, dtype).cast("string")).first()[0] == "2026-01-01 10:00:00"


def test_null_watermarks_never_qualify(spark):
    df = spark.createDataFrame([(1, None), (2, datetime(2026, 1, 2)), (3, datetime(2026, 1, 1))], "id int, wm timestamp")
    assert [r.id for r in scan.incremental_scan(df, "wm", datetime(2026, 1, 1)).collect()] == [2]


def test_watermark_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    plan = scan.incremental_scan(orders, "o_orderdate", datetime(1998, 1, 1)).select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate,1998-01-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_overlap_needs_emitted_rows(spark):
    with pytest.raises(ValueError):
        scan.incremental_scan(spark.sql("select timestamp'2026-01-01' wm"), "wm", datetime(2026, 1, 1), overlap=timedelta(days=1))


def test_snapshot_diff_with_null_keys(spark):
    prev = spark.createDataFrame([(1, None, "a"), (2, "x", "b"), (None, "y", "c")], "k int, l string, v string")
    cur = spark.createDataFrame([(1, None, "z"), (None, "y", "c")], "k int, l string, v string")
    assert [r.v for r in scan.snapshot_diff(prev, cur, ["k", "l"]).collect()] == ["b"]
    assert scan.snapshot_diff(None, cur, ["k", "l"]).count() == 0
    with pytest.raises(ValueError):
        scan.snapshot_diff(prev, cur, [])


def test_anchor_without_position_discards(spark):
    df = spark.range(5)
    assert scan.anchor(df, "id").count() == 0
    assert scan.anchor(df, "id", 2).count() == 2
    assert scan.anchor_position(df, "id").first()[0] == 4


def test_watermark_keeps_value_without_rows(spark):
    state = spark.createDataFrame([("d", "a", 5), ("d", "b", 7), ("e", "a", 1)], "driver_id string, entity string, since int")
    rows = spark.createDataFrame([("d", "a", 9), ("d", "b", 6)], "driver_id string, entity string, wm int")
    got = {(r.driver_id, r.entity): r.since for r in scan.advance_watermark(rows, "wm", state).collect()}
    assert got == {("d", "a"): 9, ("d", "b"): 7, ("e", "a"): 1}


def test_unknown_watermark_kind_is_unchanged(spark):
    assert spark.sql("select 'x' w").select(normalise_watermark("w", "text")).first()[0] is None


def test_scan_all_needs_entities():
    with pytest.raises(ValueError):
        scan.scan_all([], datetime(2026, 1, 1))


def test_scan_all_filters(spark):
    df = spark.createDataFrame([(1, datetime(2026, 1, 2)), (2, datetime(2026, 1, 2))], "id int, updated_at timestamp")
    out = scan.scan_all([(Entity("t", ("id",), "id > 1"), df), (Entity("u"), df)], datetime(2026, 1, 1))
    assert sorted((r.entity, r.pk[:8]) for r in out.collect()) == [("t", '{"id":2}'), ("u", '{"id":1,'), ("u", '{"id":2,')]


def test_spark_catalogue(spark):
    spark.range(1).createOrReplaceTempView("some_view")
    got = [r.entity for r in scan.discover_tables(scan.catalogue_tables(spark)).collect()]
    assert any(name.endswith("some_view") for name in got)


def test_change_tracking_key_side_wins(spark):
    log = spark.createDataFrame([(1, 10, "U"), (2, 11, "D"), (3, 12, "I"), (1, 5, "I")], "id int, version int, operation string")
    table = spark.createDataFrame([("x", 1), ("y", 2)], "v string, id int")
    out = feeds.changes_join_current(log, table, ["id"], 9).orderBy("version")
    assert [tuple(r) for r in out.collect()] == [(10, "Update", 1, "x"), (11, "Delete", 2, None), (12, "Insert", 3, None)]
    with pytest.raises(ValueError):
        feeds.changes_join_current(log, table, [], 9)


def test_log_values_that_were_not_sent_are_null(spark):
    df = spark.sql(
        "select 'index_update' message, 's' namespace, 't' relation, timestamp'2026-01-01' server_ts, array('a', 'b') columns, "
        "array('1', cast(null as string)) new_values, cast(null as array<string>) old_values, array('a') key_columns, array('0') key_values"
    )
    r = feeds.decode_log_messages(df).first()
    assert (r.entity, r.change_type, r.row, r.prev) == ("s.t", "Update", {"a": "1", "b": None}, {"a": "0"})


def test_document_delete_and_missing_namespace(spark):
    df = spark.createDataFrame(
        [('{"operationType":"delete","documentKey":{"_id":"7"},"clusterTime":5}',), ('{"operationType":"rename"}',)], "value string"
    )
    rows = documents.decode_document_changes(df).collect()
    assert [(r.entity, r.change_type, r.row, r.meta["resumeToken"], r.source_ts.second) for r in rows] == [("unknown", "Delete", '{"_id":"7"}', "", 5)]


def test_delta_page_without_items(spark):
    df = spark.createDataFrame([("e", 1, "{}"), ("e", 2, '{"value":[{"id":1,"deleted":null}]}')], "entity string, page_no int, value string")
    assert [(r.page_no, r.change_type) for r in documents.decode_delta_pages(df).collect()] == [(2, "Delete")]
    assert [r.cursor for r in documents.page_cursors(df).collect()] == [None]


def test_watched_types():
    assert documents.watched_types([]) == ("element", "elementTemplate", "attribute")
    assert documents.watched_types([None, " ", "attribute"]) == ("element", "attribute")


def test_nested_attributes_last_value(spark):
    objects = spark.createDataFrame([(1,), (2,)], "object_id int")
    attributes = spark.createDataFrame([(1, "a", "old", 1), (1, "a", "new", 2), (1, "b", None, 1)], "object_id int, name string, value string, ordinal int")
    categories = spark.createDataFrame([(1, "z"), (1, "y"), (1, "z")], "object_id int, name string")
    rows = documents.nest_attributes(objects, attributes, categories).orderBy("object_id").collect()
    assert (rows[0].attributes, rows[0].categories) == ({"a": "new", "b": None}, ["y", "z"])
    assert (rows[1].attributes, rows[1].categories) == (None, [])


def test_decoded_feed_to_events(spark):
    """Envelopes in JSON through to addressed events, with the images of the feed."""
    from changeflow.operators.changes import with_history
    from changeflow.plans.forward import Driver, finish_events

    source = '"source":{"version":"2","connector":"pg","name":"d","ts_ms":%d,"table":"t"}'
    feed = [
        '{"payload":{"op":"r","after":{"id":1,"v":"a"},' + source % 1000 + "}}",
        '{"payload":{"op":"u","before":{"id":1,"v":"x"},"after":{"id":1,"v":"b"},' + source % 2000 + "}}",
        '{"payload":{"op":"r","before":{},"after":{"id":1,"v":"oops"},' + source % 3000 + "}}",
        '{"payload":{"op":"d","before":{"id":1,"v":"c"},"after":null,' + source % 4000 + "}}",
    ]
    raw = feeds.typed_rows(feeds.decode_debezium(spark.createDataFrame([(f,) for f in feed], "value string")), "id int, v string")
    raw = raw.withColumn("row", F.coalesce("row", "prev"))
    events = finish_events(with_history(raw, ["id"], ["source_ts"]), Driver("d", "pg"), ["id"], ["source_ts"]).orderBy("seq")
    got = [(r.change_type, r.fields.v, r.prev.v if r.prev else None, r.subject) for r in events.collect()]
    assert got == [
        ("Insert", "a", None, "cdc.pg.d.insert"), ("Update", "b", "x", "cdc.pg.d.update"), ("Update", "oops", "b", "cdc.pg.d.update"),
        ("Delete", "c", "c", "cdc.pg.d.delete"),
    ]


def test_typed_rows_of_json(spark):
    df = spark.sql("""select '{"a":1,"b":"x"}' row, cast(null as string) prev""")
    r = feeds.typed_rows(df, "a int, b string").first()
    assert (r.row.a, r.row.b, r.prev) == (1, "x", None)


def test_feed_without_key_for_before_images(spark):
    feed = spark.sql("select 1 id, 'insert' _change_type, 3L _commit_version, timestamp'2026-01-01' _commit_timestamp")
    with pytest.raises(ValueError):
        feeds.read_change_feed(feed, 0, keep_before=True)
    assert feeds.read_change_feed(feed, 3).columns == ["version", "change_type", "id"]
    assert feeds.next_feed_version(feed, 3).first()[0] == 4
    assert feeds.next_feed_version(feed, 9).first()[0] == 9
