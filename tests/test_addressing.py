import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changeflow.operators import addressing
from changeflow.plans.forward import Driver, change_events, publishable
from changeflow.sinks.tables import split_dead_letters
from changeflow.sources.scan import raw_changes
from changeflow.spec import Rule

EVENT = "select '{c}' context, '{e}' entity, '{k}' change_type, 'D1' driver_id, 'Postgres' source_type"


def subject(spark, context, entity="public.assets", kind="Insert", **options):
    return addressing.with_subject(spark.sql(EVENT.format(c=context, e=entity, k=kind)), **options).first().subject


@pytest.mark.parametrize(
    "context, kind, want",
    [
        ("ctx:PROC", "Insert", "cdc.ctx-proc.public.assets.insert"),
        ("", "Delete", "cdc.postgres.d1.delete"),
        ("ns:area:zone", "Update", "cdc.ns-area-zone.public.assets.update"),
    ],
)
def test_default_subject(spark, context, kind, want):
    assert subject(spark, context, kind=kind) == want


def test_template_subject(spark):
    assert subject(spark, "ctx:PID", template="cdc.{context}.{entityPath}.{changeType}") == "cdc.ctx-pid.public.assets.insert"
    assert subject(spark, "", template="{driverId}/{sourceType}") == "D1/Postgres"
    with pytest.raises(ValueError):
        subject(spark, "c", template="cdc.{tenant}")


def test_precedence(spark):
    assert subject(spark, "c", override="x", template="y") == "x"
    assert subject(spark, "c", template="y") == "y"


def events(spark, **options):
    df = spark.createDataFrame(
        [(1, 12345678901234567, datetime(2026, 1, 1, 1, 2, 3, 456789), None), (1, 5, datetime(2026, 1, 2), "n")],
        "id int, big long, at timestamp, note string",
    ).withColumn("price", F.lit("1.10").cast("decimal(12,2)"))
    raw = raw_changes(df, "t", "at")
    driver = Driver("d", "pg", "c", rules=[Rule("id", is_key=True)])
    return change_events(raw, driver, ["id"], ["source_ts"], F.col("source_ts"), **{"sequence": True} | options)


def test_envelope(spark):
    first, second = [json.loads(r.envelope) for r in publishable(events(spark)).orderBy("seq").collect()]
    assert list(first) == [
        "event_id", "detected_at", "source_timestamp", "source_type", "driver_id", "context", "entity_path", "change_type",
        "primary_key", "fields", "metadata", "sequence_number",
    ]
    assert first["fields"] == {"big": 12345678901234567, "at": "2026-01-01T01:02:03.4567890+00:00", "note": None, "price": 1.10}
    assert first["source_timestamp"] == "2026-01-01T01:02:03.4567890+00:00" and first["change_type"] == "Insert"
    assert second["previous_fields"]["note"] is None and second["change_type"] == "Update"


def test_envelope_with_doubles(spark):
    text = publishable(events(spark), numbers="double").orderBy("seq").first().envelope
    assert json.loads(text)["fields"]["big"] == 12345678901234567.0 and "1.2345678901234568E16" in text


def test_headers(spark):
    out = addressing.with_headers(events(spark), {"context": "other", "x": "1"}).first().headers
    assert out["context"] == "other" and out["x"] == "1" and len(out) == 7


def test_sequence_is_optional(spark):
    assert events(spark, sequence=False).filter("seq is not null").count() == 0


def test_unknown_kind_is_a_dead_letter(spark):
    df = spark.createDataFrame([("a", "x", k) for k in ("Insert", "Upsert", None)], "subject string, envelope string, change_type string")
    good, dead = split_dead_letters(df)
    assert good.count() == 1 and [r.reason for r in dead.collect()] == ["unknown change kind"] * 2


def test_dead_letters(spark):
    df = spark.createDataFrame(
        [("A.b", "x"), ("", "x"), (None, "x"), ("a.{y}", "x"), ("a", None), ("a", "x" * 50), ("a", "é" * 25)], "subject string, envelope string"
    )
    good, dead = split_dead_letters(df, max_bytes=40)
    assert [r.subject for r in good.collect()] == ["A.b"]
    assert sorted((r.reason, r.subject) for r in dead.collect()) == [
        ("no address", "cdc.dlq."), ("no address", "cdc.dlq."), ("not encodable", "cdc.dlq.a"), ("too large", "cdc.dlq.a"),
        ("too large", "cdc.dlq.a"), ("unresolved token", "cdc.dlq.a.{y}"),
    ]
