"""Registered queries: addresses, envelopes, subscriptions, sinks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from changeflow.functions.text import sanitise_path
from changeflow.operators.addressing import subscribe as subscribed, with_subject
from changeflow.plans.change_queries import HISTORY_SQL, event_changes, event_order
from changeflow.plans.forward import Driver, change_events, publishable
from changeflow.plans.tables import read
from changeflow.scratch import shared_path
from changeflow.sinks import tables as sinks


def _part_events(spark, sf):
    part = read(spark, sf, "part")
    return part.select(
        "p_partkey", F.concat(F.lit("Part\\"), "p_type", F.lit("//"), "p_name", F.lit(":"), "p_brand", F.lit("/")).alias("entity"),
        F.when(F.col("p_size") > 10, F.concat(F.lit("ctx:"), "p_type", F.lit(":X"))).otherwise("").alias("context"),
        F.when(F.col("p_size") % 2 == 0, "Update").otherwise("Delete").alias("change_type"),
        F.lit("Pg-1").alias("driver_id"), F.lit("Postgres").alias("source_type"),
    )


def sanitised_paths(spark, sf):
    pages = read(spark, sf, "pages").select("page_id", sanitise_path("url").alias("path"))
    texts = read(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.md5(sanitise_path("text")).alias("path"))
    return pages.unionByName(texts)


def default_subject(spark, sf):
    return with_subject(_part_events(spark, sf)).select("p_partkey", "subject")


def template_subject(spark, sf):
    out = with_subject(_part_events(spark, sf), template="x.{context}.{entityPath}.{changeType}.{driverId}.{sourceType}")
    return out.select("p_partkey", "subject")


def override_subject(spark, sf):
    out = with_subject(_part_events(spark, sf), override="fixed.subject", template="x.{context}")
    return out.select("p_partkey", "subject")


def _events(spark, sf):
    driver = Driver("Web-1", "postgres", "ctx:Web", headers={"region": "eu"})
    return change_events(
        event_changes(spark, sf), driver, ["user_id"], event_order(), detected_at=F.col("source_ts")
    )


def _opened(spark, sf, numbers):
    image = "struct<event_id: string, value: double>"
    schema = (
        f"event_id string, change_type string, entity_path string, source_timestamp string, primary_key struct<user_id: string>, "
        f"fields {image}, previous_fields {image}, metadata map<string,string>"
    )
    out = publishable(_events(spark, sf), numbers).withColumn("e", F.from_json("envelope", schema))
    return out.select(
        F.col("e.fields.event_id").alias("event_id"), F.col("e.primary_key.user_id").alias("user_id"),
        F.col("e.source_timestamp").alias("source_ts"), F.col("e.change_type").alias("change_type"),
        F.col("e.entity_path").alias("entity"), F.col("e.fields.value").alias("value"),
        F.col("e.previous_fields.event_id").alias("prev_id"), F.try_element_at("e.metadata", F.lit("region")).alias("region"),
        F.col("envelope").contains("previous_fields").alias("has_prev"), (F.col("e.event_id") == F.col("event_id")).alias("same_id"),
    )


def envelope(spark, sf):
    return _opened(spark, sf, "exact")


def envelope_doubles(spark, sf):
    return _opened(spark, sf, "double")


def headers(spark, sf):
    out = publishable(_events(spark, sf)).withColumn("n", F.size("headers"))
    get = lambda k: F.try_element_at("headers", F.lit(k))
    return out.select(
        F.col("fields.event_id").alias("source_event_id"), get("driverId").alias("driver_id"), get("context").alias("context"),
        get("sourceType").alias("source_type"), get("changeType").alias("change_type"), get("content-type").alias("content_type"), "n",
    )


def subscribe(spark, sf):
    events = _events(spark, sf)
    rest = subscribed(events, "cdc.*.public.>", preview=True)
    exact = subscribed(events, "cdc.ctx-web.public.events.delete", preview=True)
    nothing = subscribed(events, "cdc.*", preview=True)
    return subscribed(rest, "*.*.*.events.insert").unionByName(exact).unionByName(nothing).select(
        F.col("fields.event_id").alias("source_event_id"), "subject", F.substring_index("preview", ", value", 1).alias("preview")
    )


def dead_letters(spark, sf):
    """Documents as payloads: no address for one source, an open token for another, a size cap for all."""
    docs = read(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("envelope"),
        F.when(F.col("lang") == "fr", None).when(F.col("source") == "src1", F.concat(F.lit("cdc.{x}."), "lang"))
        .otherwise(F.concat(F.lit("cdc.Docs."), "lang")).alias("subject"),
        F.when(F.col("n_chars") < 100, F.array(F.lit("short"))).otherwise(F.array().cast("array<string>")).alias("errors"),
    )
    good, dead = sinks.split_dead_letters(docs, max_bytes=4000, errors="errors")
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(dead).select("doc_id", "subject", "reason")


def _audit(spark, sf):
    return event_changes(spark, sf).select(
        F.concat(F.lit("e"), "row.event_id").alias("event_id"), F.col("source_ts"), F.col("row.value").alias("value"),
        F.when(F.col("change_type") == "Delete", "Delete").otherwise("Insert").alias("change_type"),
    ).withColumn("change_code", sinks.kind_code())


def append_if_absent(spark, sf):
    """A stored half, then everything twice: each id is stored once."""
    events = _audit(spark, sf)
    path = shared_path(spark, "audit")
    sinks.append_if_absent(events.filter("source_ts < '2024-01-15'"), path, order=["source_ts"])
    sinks.append_if_absent(events.unionByName(events.filter("value > 50")), path, order=["source_ts"])
    return spark.read.parquet(path).drop("id_day", "id_bucket")


def append_overlapping(spark, sf):
    """Three appends of ids with a time prefix, each overlapping the one before by days: a day and bucket is opened only where ids fall into it."""
    events = _events(spark, sf).select("event_id", "source_ts", F.col("fields.value").alias("value"))
    path = shared_path(spark, "audit")
    for start, end in ((1, 14), (10, 24), (20, 32)):
        days = F.dayofmonth("source_ts")
        sinks.append_if_absent(events.filter((days >= start) & (days < end)), path, order=["source_ts"])
    out = spark.read.schema("source_ts timestamp_ntz, value double, id_day string").parquet(path)
    return out.select("source_ts", "value", "id_day")


def publish_outcomes(spark, sf):
    """Publishable events and dead letters from one pass; the second run of the same batch replaces the first. With the counts taken while writing."""
    path = shared_path(spark, "outcomes")
    events = publishable(_events(spark, sf)).withColumn("subject", F.when(F.col("fields.event_id") % 7 == 0, F.lit("")).otherwise(F.col("subject")))
    counts = [sinks.write_outcomes(events, path), sinks.write_outcomes(events, path)]
    out = spark.read.parquet(f"{path}/run=0").select(F.col("fields.event_id").alias("source_event_id"), "outcome", "reason", "subject")
    return out.withColumns({n: F.lit(counts[1][n]).cast("bigint") for n in ("published", "dead_lettered", "retried")})


def retention(spark, sf):
    events = read(spark, sf, "events").select("event_id", "ts")
    return sinks.retain(events, datetime(2024, 1, 30, 12), timedelta(days=1), "ts")


def retention_without_source_time(spark, sf):
    """Age counts from detection; most of these events have no time of their source."""
    events = read(spark, sf, "events").select(
        "event_id", F.col("ts").alias("detected_at"), F.when(F.col("event_type") == "view", F.col("ts")).alias("source_ts")
    )
    return sinks.retain(events, datetime(2024, 1, 20, 12), timedelta(days=2))


def replay_log(spark, sf):
    """The event log written by driver and day, then replayed for one subscription after a position."""
    events = _events(spark, sf).withColumn("seq", F.col("fields.event_id"))
    path = shared_path(spark, "log")
    sinks.write_events(events, path)
    sinks.write_events(events.limit(0), path)
    out = sinks.replay(spark, path, "cdc.*.public.events.update", since={"Web-1": 100, "other": 10**9})
    return out.select("seq", "source_ts", F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "driver_id", "subject")


def replay_range(spark, sf):
    """The log of one driver over some days, written twice by the same run."""
    events = _events(spark, sf).withColumn("seq", F.col("fields.event_id")).withColumn("driver_id", F.concat("driver_id", F.col("seq") % 3))
    path = shared_path(spark, "log")
    sinks.write_events(events, path, run=0)
    sinks.write_events(events, path, run=0)
    out = sinks.replay(spark, path, driver="Web-12", start=datetime(2024, 1, 5, 6), end=datetime(2024, 1, 9, 18))
    return out.select("seq", "detected_at", "driver_id", "subject")


QUERIES = {
    f.__name__: f
    for f in (
        sanitised_paths, default_subject, template_subject, override_subject, envelope, envelope_doubles, headers, subscribe,
        dead_letters, append_if_absent, append_overlapping, publish_outcomes, retention, retention_without_source_time, replay_log, replay_range,
    )
}


def clean_sql(path: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(translate({path}, '/\\', '..'), '[^\\p{{L}}\\p{{Nd}}._-]', '_', 'g'), "
        "'\\.+', '.', 'g'), '.')"
    )


_PATH = clean_sql("'Part\\' || p_type || '//' || p_name || ':' || p_brand || '/'")
_CHANGE = "CASE WHEN p_size % 2 = 0 THEN 'update' ELSE 'delete' END"
_CONTEXT = "CASE WHEN p_size > 10 THEN 'ctx-' || lower(p_type) || '-x' ELSE '' END"
_KIND = "CASE WHEN event_type = 'error' THEN 'Delete' WHEN has_prev THEN 'Update' ELSE 'Insert' END"
_ENVELOPE = f"""WITH {HISTORY_SQL.format(source="events")}
        SELECT {{number}} AS event_id, {{user}} AS user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0' AS source_ts,
        {_KIND} AS change_type, 'public.events' AS entity, value, CASE WHEN has_prev THEN {{prev}} END AS prev_id,
        'eu' AS region, has_prev, true AS same_id FROM h"""

ORACLE = {
    "sanitised_paths": f"""SELECT page_id, {clean_sql("url")} AS path FROM pages
        UNION ALL SELECT doc_id, md5({clean_sql("text")}) FROM documents""",
    "default_subject": f"""SELECT p_partkey, CASE WHEN p_size > 10 THEN 'cdc.' || {_CONTEXT} || '.' || {_PATH} || '.' || {_CHANGE}
        ELSE 'cdc.postgres.pg-1.' || {_CHANGE} END AS subject FROM part""",
    "template_subject": f"""SELECT p_partkey, 'x.' || {_CONTEXT} || '.' || {_PATH} || '.' || {_CHANGE} || '.Pg-1.Postgres' AS subject FROM part""",
    "override_subject": "SELECT p_partkey, 'fixed.subject' AS subject FROM part",
    "envelope": _ENVELOPE.format(number="event_id::VARCHAR", user="user_id::VARCHAR", prev="p_id::VARCHAR"),
    "envelope_doubles": _ENVELOPE.format(
        number="event_id::DOUBLE::VARCHAR", user="user_id::DOUBLE::VARCHAR", prev="p_id::DOUBLE::VARCHAR"
    ),
    "headers": f"""WITH {HISTORY_SQL.format(source="events")}
        SELECT event_id AS source_event_id, 'Web-1' AS driver_id, 'ctx:Web' AS context, 'postgres' AS source_type,
        {_KIND} AS change_type, 'application/json' AS content_type, 6 AS n FROM h""",
    "subscribe": f"""WITH {HISTORY_SQL.format(source="events")}
        SELECT event_id AS source_event_id, 'cdc.ctx-web.public.events.' || lower({_KIND}) AS subject,
        'event_id=' || event_id || ', ts=' || rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') || ', event_type=' || event_type AS preview
        FROM h WHERE {_KIND} <> 'Update'""",
    "dead_letters": """SELECT doc_id, CASE WHEN reason IS NULL THEN subject ELSE lower('cdc.dlq.' || coalesce(subject, '')) END AS subject, reason
        FROM (SELECT doc_id, subject, CASE WHEN n_chars < 100 THEN 'invalid' WHEN subject IS NULL THEN 'no address'
            WHEN source = 'src1' THEN 'unresolved token' WHEN strlen(text) > 4000 THEN 'too large' END AS reason
          FROM (SELECT *, CASE WHEN lang = 'fr' THEN NULL WHEN source = 'src1' THEN 'cdc.{x}.' || lang ELSE 'cdc.Docs.' || lang END AS subject
                FROM documents))""",
    "append_if_absent": """SELECT 'e' || event_id AS event_id, ts AS source_ts, value,
        CASE WHEN event_type = 'error' THEN 'Delete' ELSE 'Insert' END AS change_type,
        CASE WHEN event_type = 'error' THEN 2 ELSE 0 END AS change_code FROM events""",
    "append_overlapping": "SELECT ts AS source_ts, value, strftime(ts, '%Y-%m-%d') AS id_day FROM events",
    "publish_outcomes": f"""WITH {HISTORY_SQL.format(source="events")},
        marked AS (SELECT event_id AS source_event_id, CASE WHEN event_id % 7 = 0 THEN 'dead_lettered' ELSE 'published' END AS outcome,
          CASE WHEN event_id % 7 = 0 THEN 'no address' END AS reason,
          CASE WHEN event_id % 7 = 0 THEN 'cdc.dlq.' ELSE 'cdc.ctx-web.public.events.' || lower({_KIND}) END AS subject FROM h)
        SELECT *, count_if(outcome = 'published') OVER () AS published, count_if(outcome <> 'published') OVER () AS dead_lettered,
          count_if(outcome = 'published') OVER () AS retried FROM marked""",
    "retention": "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-29 12:00:00'",
    "retention_without_source_time": """SELECT event_id, ts AS detected_at, CASE WHEN event_type = 'view' THEN ts END AS source_ts FROM events
        WHERE ts >= TIMESTAMP '2024-01-18 12:00:00'""",
    "replay_range": f"""WITH {HISTORY_SQL.format(source="events")}
        SELECT event_id AS seq, ts AS detected_at, 'Web-1' || event_id % 3 AS driver_id, 'cdc.ctx-web.public.events.' || lower({_KIND}) AS subject
        FROM h WHERE event_id % 3 = 2 AND ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09 18:00:00'""",
    "replay_log": f"""WITH {HISTORY_SQL.format(source="events")}
        SELECT event_id AS seq, ts AS source_ts, strftime(ts, '%Y-%m-%d') AS event_date, 'Web-1' AS driver_id,
        'cdc.ctx-web.public.events.update' AS subject FROM h WHERE {_KIND} = 'Update' AND event_id > 100""",
}
