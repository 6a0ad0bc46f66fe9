import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from changeflow.operators import changes
from changeflow.plans.change_queries import event_changes, event_order
from changeflow.sources.scan import raw_changes
from conftest import SMALL


def test_pinned_counts(spark):
    """Known result of the events table: kinds and before images."""
    out = changes.with_history(event_changes(spark, SMALL), ["user_id"], event_order())
    got = {r[0]: (r[1], r[2]) for r in out.groupBy("change_type").agg(F.count("*"), F.count("prev")).collect()}
    assert got == {"Delete": (201, 158), "Insert": (170, 0), "Update": (629, 629)}


def history_by_hand(rows):
    """rows: (i, key, kind, value) in order."""
    state, out = {}, {}
    for i, key, kind, value in rows:
        known = key in state
        resolved = ("Update" if known else "Insert") if kind == "Snapshot" else kind
        out[i] = (resolved, state.get(key))
        if kind == "Delete":
            state.pop(key, None)
        else:
            state[key] = value
    return out


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_history(spark, hot_rows):
    rnd = random.Random(5)
    kinds = ["Snapshot", "Snapshot", "Delete", "Insert", "Update"]
    rows = [(i, rnd.choice(["k", "k", "k", "a", None]), rnd.choice(kinds), rnd.randrange(99)) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, key string, kind string, value int").repartition(5)
    raw = raw_changes(df, "t", change_type=F.col("kind"))
    out = changes.with_history(raw, ["key"], [F.col("row.i")], hot_rows=hot_rows)
    got = {r.i: (r.change_type, r.v) for r in out.select("row.i", "change_type", F.col("prev.value").alias("v")).collect()}
    assert got == history_by_hand(rows)


def test_key_is_required(spark):
    raw = raw_changes(spark.createDataFrame([(1,)], "i int"), "t")
    with pytest.raises(ValueError):
        changes.with_history(raw, [], ["source_ts"])
    assert changes.with_history(raw, [], ["source_ts"], keyless=True).first()["change_type"] == "Insert"


def fold(times, ttl):
    last, out = None, []
    for t in times:
        ok = last is None or t - last >= ttl
        out.append(not ok)
        last = t if ok else last
    return out


@pytest.mark.parametrize("hot_rows", [None, 0, 30])
@pytest.mark.parametrize("spread", [60, 3000])
def test_dedup_requests(spark, hot_rows, spread):
    """Dense and sparse ids, equal times, one id with a third of the rows."""
    rnd = random.Random(spread)
    start = datetime(2026, 1, 1)
    rows = []
    for i in range(240):
        key = "hot" if i % 3 == 0 else rnd.choice("abcdefgh")
        rows.append((i, key, start + timedelta(seconds=rnd.randrange(spread))))
    df = spark.createDataFrame(rows, "i int, req string, ts timestamp").repartition(4)
    out = changes.dedup_requests(df, "req", "ts", timedelta(seconds=20), tie=["i"], hot_rows=hot_rows, **({} if hot_rows is None else {"fold_rows": hot_rows}))
    got = {r.i: r.duplicate for r in out.collect()}
    want = {}
    for key in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))
        want |= {r[0]: d for r, d in zip(mine, fold([m[2] for m in mine], timedelta(seconds=20)))}
    assert got == want


def test_requests_without_an_id_are_one_id(spark):
    start = datetime(2026, 1, 1)
    rows = [(i, key, start + timedelta(minutes=4 * i)) for key in (None, "a") for i in range(3)]
    df = spark.createDataFrame(rows, "i int, req string, ts timestamp")
    for rest in ({}, {"hot_rows": 0, "fold_rows": 0}):
        out = changes.dedup_requests(df, "req", "ts", tie=["i"], **rest).collect()
        assert {(r.req, r.i): r.duplicate for r in out} == {(k, i): i == 1 for k in (None, "a") for i in range(3)}


def test_a_long_run_is_folded_whole(spark):
    df = spark.range(24_000).select(F.lit("x").alias("req"), F.timestamp_seconds(F.col("id") * 3).alias("ts"), "id")
    for rest in ({}, {"hot_rows": 50_000}, {"fold_rows": 50_000}):
        assert changes.dedup_requests(df, "req", "ts", timedelta(seconds=5), tie=["id"], **rest).filter("not duplicate").count() == 12_000


def test_event_ids_tell_missing_from_empty(spark):
    df = spark.createDataFrame([(None, "a", "b"), (None, "", "ab"), (None, None, "ab"), (None, "a:", "b"), (None, "a", ":b")], "source_ts timestamp, x string, y string")
    out = changes.with_event_id(df, ["x", "y"]).select("event_id").collect()
    assert len({r[0] for r in out}) == 5 and {len(r[0]) for r in out} == {12 + 64}


def test_many_copies_make_one_request(spark):
    start = datetime(2026, 1, 1)
    df = spark.createDataFrame([(i, "r", start) for i in range(10)], "i int, req string, ts timestamp")
    out = changes.dedup_requests(df, "req", "ts", tie=["i"])
    assert out.filter("not duplicate").count() == 1


def test_event_id_is_stable_and_sortable(spark):
    raw = event_changes(spark, SMALL).withColumn("driver_id", F.lit("d"))
    parts = ["driver_id", "entity", F.col("row.event_id")]
    a = changes.with_event_id(raw, parts).select("source_ts", "event_id")
    b = changes.with_event_id(raw.repartition(7), parts).select("source_ts", "event_id")
    assert a.exceptAll(b).count() == 0
    assert a.select("event_id").distinct().count() == 1000
    by_id = [r.source_ts.replace(microsecond=r.source_ts.microsecond // 1000 * 1000) for r in a.orderBy("event_id").collect()]
    assert by_id == sorted(by_id)


def test_field_diff(spark):
    df = spark.sql(
        "select named_struct('a', 1, 'b', 'x', 'c', cast(null as int)) row, named_struct('a', 1, 'b', 'y', 'c', 2) prev "
        "union all select named_struct('a', 1, 'b', 'x', 'c', 3), null"
    )
    rows = changes.field_diff(df).select("changed", "unchanged").collect()
    assert [tuple(c) for c in rows[0].changed] == [("b", "y", "x"), ("c", "2", None)]
    assert rows[0].unchanged == ["a"]
    assert rows[1].changed == [] and rows[1].unchanged == []


def test_key_history_newest_first(spark):
    raw = event_changes(spark, SMALL)
    ts = [r.source_ts for r in changes.key_history(raw, {"user_id": 3}, ["source_ts"]).collect()]
    assert ts == sorted(ts, reverse=True) and len(ts) > 10


def test_document_diff(spark):
    rows = [
        (1, '{"a": 1, "b": {"c": [1, 2], "d": {"e": "x"}}, "gone": null}', '{"b": {"d": {"e": "y", "f.g": true}, "c": [1, 2]}, "a": 1.0, "n": {}}'),
        (2, '{"a": 1}', None), (3, None, '{"a": 1}'), (4, "{broken", '{"a": 1}'), (5, '{"a": {"b": 1}}', '{"a": "{\\"b\\": 1}"}'), (6, "[1]", "[2]"), (7, '{"a": 1}', '{"a": 1}'),
    ]
    df = spark.createDataFrame(rows, "id int, before string, after string")
    got = {(r.id, r.path, r.kind, r.old, r.new) for r in changes.document_diff(df, ["id"], "after", "before").collect()}
    assert got == {
        (1, "b.d.e", "changed", '"x"', '"y"'), (1, r"b.d.f\.g", "added", None, "true"), (1, "gone", "removed", "null", None), (1, "n", "added", None, "{}"),
        (5, "a.b", "removed", "1", None), (5, "a", "added", None, '"{\\"b\\": 1}"'), (6, None, "changed", "[1]", "[2]"),
    }
    shallow = changes.document_diff(df.filter("id = 1"), ["id"], "after", "before", depth=1)
    assert ("b", "changed") in {(r.path, r.kind) for r in shallow.collect()}
