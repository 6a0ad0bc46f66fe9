"""Registered queries: the streaming forms over several micro-batches, stopped and started again between them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.plans import capture_queries, change_queries, command_queries, monitor_queries
from changeflow.plans.tables import read
from changeflow.scratch import shared_path
from changeflow.sinks.stream_sink import CommittedFiles, read_committed
from changeflow.sources.feed_stream import VERSION, ChangeFeed
from changeflow.sources.scan import raw_changes, snapshot_cycle
from changeflow.spec import Entity
from changeflow.streaming import operators as streaming
from changeflow.streaming.micro import read_batches, run as micro_run, write_batch
from changeflow.streaming.polling import scan_step

BATCHES = 5


def cuts(df: DataFrame, by: str, parts: int = BATCHES) -> list[DataFrame]:
    """A table in ``parts`` pieces of about equal size, in order of a time column; rows without a time come first."""
    at = F.unix_micros(F.col(by).cast("timestamp")).cast("double")
    edges = df.select(at.alias("t")).approxQuantile("t", [i / parts for i in range(1, parts)], 0.01)
    edges = [float("-inf"), *edges, float("inf")]
    first = lambda a: at.isNull() if a == edges[0] else F.lit(False)
    return [df.filter(first(a) | ((at > a) & (at <= b))) for a, b in zip(edges, edges[1:])]


def restarted(pieces: list[DataFrame], start: Callable[[DataFrame], StreamingQuery], retries: int = 0) -> None:
    """Land the pieces one after another, each dealt evenly over a file per core; the query is started again for each and goes on where it stopped.

    A query that fails is started again up to ``retries`` times.
    """
    spark = pieces[0].sparkSession
    folder = shared_path(spark, "landed")
    for piece in pieces:
        piece.repartition(spark.sparkContext.defaultParallelism).write.mode("append").parquet(folder)
        for left in range(retries, -1, -1):
            try:
                start(spark.readStream.schema(pieces[0].schema).parquet(folder)).awaitTermination()
                break
            except StreamingQueryException:
                if not left:
                    raise


def _events(spark, sf) -> list[DataFrame]:
    return cuts(read(spark, sf, "events"), "ts")


def _raw(events: DataFrame) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "Delete").otherwise("Snapshot")
    return raw_changes(events, "public.events", "ts", kind).withColumn("event_id", F.col("row.event_id"))


def stream_change_events(spark, sf):
    path = shared_path(spark, "stream-changes")
    restarted(_events(spark, sf), lambda s: streaming.track_changes(_raw(s), ["user_id"], ["source_ts", "event_id"], path))
    out = read_batches(spark, f"{path}/events")
    return out.select("event_id", "row.user_id", "source_ts", "change_type", F.col("prev.event_id").alias("prev_id"), F.col("prev.value").alias("prev_value"))


def stream_publish(spark, sf):
    """The whole forward path: sequence numbers, before images and positions go on over batches and the restart."""
    path = shared_path(spark, "stream-publish")
    start = lambda s: streaming.publish_changes(
        _raw(s).withColumnRenamed("event_id", "number"), change_queries.WEB, ["user_id"], ["source_ts", "number"], path,
        detected_at=F.col("source_ts"),
    )
    restarted(_events(spark, sf), start)
    out = read_batches(spark, f"{path}/events").filter("outcome = 'published'")
    return out.select(
        F.col("fields.event_id").alias("source_event_id"), "pk.user_id", "source_ts", "change_type", "driver_id", "context",
        F.col("fields.event_type").alias("event_type"), F.col("prev.event_type").alias("prev_event_type"),
        F.col("prev.value").alias("prev_value"), "seq", "subject",
    )


def stream_commands(spark, sf):
    """Write commands on a stream: the table afterwards."""
    path = shared_path(spark, "stream-commands")
    table = streaming.CommandTable(spark, f"{path}/table", command_queries.KEY)
    table.load(command_queries.customers(spark, sf))
    commands = cuts(command_queries.event_commands(spark, sf), "ts")
    restarted(commands, lambda s: streaming.apply_command_stream(s, table, command_queries.ORDER, f"{path}/run", types=("element",)))
    return table.read()


def stream_heartbeats(spark, sf):
    """Batches in reverse order of time: all but the first come late, and all are counted."""
    path = shared_path(spark, "stream-heartbeats")
    pieces = [p.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("driver_id")) for p in reversed(_events(spark, sf))]
    restarted(pieces, lambda s: streaming.heartbeat_stream(s, path))
    out = streaming.read_heartbeats(spark, path)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end", "last_event_at")})


def stream_dedup(spark, sf):
    path = shared_path(spark, "stream-dedup")
    pieces = [p.select("event_id", "user_id", "ts") for p in _events(spark, sf)]
    restarted(pieces, lambda s: streaming.dedup_stream(s, "user_id", "ts", path, timedelta(hours=24), ["event_id"]))
    return read_batches(spark, f"{path}/requests").drop("v")


def stream_echo(spark, sf):
    """Sessions come as a stream of their own, each not after its first change."""
    events = read(spark, sf, "events")
    opened = events.filter("event_type = 'signup' and value > 40").select(F.col("user_id").alias("replica_session")).distinct()
    path, landed = shared_path(spark, "stream-echo"), shared_path(spark, "sessions")
    opened.write.parquet(landed)
    sessions = spark.readStream.schema(opened.schema).parquet(landed)
    pieces = [p.select("event_id", "ts", F.when(F.col("event_type") != "view", F.col("user_id")).alias("replica_session")) for p in _events(spark, sf)]
    restarted(pieces, lambda s: streaming.suppress_echo_stream(s, sessions, ["ts", "event_id"], path))
    return read_batches(spark, f"{path}/changes").drop("v")


def stream_feed_source(spark, sf):
    """A landed feed by offset ranges: what was there before the first start is skipped, a restart goes on after the last range."""
    spark.dataSource.register(ChangeFeed)
    path, landed = shared_path(spark, "stream-feed"), shared_path(spark, "feed")
    events = read(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    days = F.dayofmonth("ts")
    land = lambda version, part: part.write.parquet(f"{landed}/{VERSION}={version}")

    def run() -> None:
        stream = spark.readStream.format("change_feed").schema(f"event_id long, user_id long, ts timestamp, value double, {VERSION} long")
        stream = stream.option("path", landed).option("position", f"{path}/position.json").load()
        micro_run(stream, lambda df, n: write_batch(df, f"{path}/rows", n), f"{path}/checkpoint").awaitTermination()

    land(0, events.filter(days <= 5))
    run()
    land(1, events.filter((days > 5) & (days <= 12)))
    land(2, events.filter((days > 12) & (days <= 20)))
    run()
    land(3, events.filter(days > 20))
    run()
    return read_batches(spark, f"{path}/rows").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value", F.col(VERSION).alias("version"))


def stream_committed_sink(spark, sf):
    """Two-phase commit: the second batch fails once after some of its tasks have staged their files, and runs again."""
    spark.dataSource.register(CommittedFiles)
    path = shared_path(spark, "stream-sink")
    pieces = [p.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts")) for p in _events(spark, sf)]
    failing = iter((False, True, False, False, False, False))

    def start(stream: DataFrame) -> StreamingQuery:
        broken = F.when(F.lit(next(failing)) & (F.col("event_id") % 97 == 0), F.raise_error(F.lit("one failure"))).otherwise(F.col("event_id"))
        rows = stream.withColumn("event_id", broken.cast("bigint"))
        return rows.writeStream.format("committed_files").option("path", path).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()

    restarted(pieces, start, retries=1)
    return read_committed(spark, path, "event_id long, event_type string, ts timestamp").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def poll_scan(spark, sf):
    """Polls of a growing table: each reads what came after the stored watermark; one poll is run twice."""
    path = shared_path(spark, "poll")
    events = read(spark, sf, "events")
    limits = [datetime(2024, 1, d) for d in (5, 10, 15, 20, 25)] + [datetime(2100, 1, 1)]
    seen = {"limit": limits[0]}
    load = lambda e: events.filter(F.col("ts") < F.lit(seen["limit"].isoformat(sep=" ")).cast("timestamp_ntz"))
    entity = Entity("public.events", ("event_id",), watermark="ts")
    step = scan_step(spark, "web", [entity], load, path, lookback="P3650D", now=lambda: datetime(2024, 1, 1, tzinfo=timezone.utc))
    for number, seen["limit"] in enumerate(limits):
        step(number)
        if number == 2:
            step(number)
    out = read_batches(spark, f"{path}/changes")
    return out.select("entity", F.get_json_object("pk", "$.event_id").alias("event_id"), F.col("source_ts").cast("timestamp_ntz").alias("source_ts"))


def snapshot_polls(spark, sf):
    """Two cycles of a snapshot source: the second reports what changed and what vanished."""
    path = shared_path(spark, "snapshots")
    changes = capture_queries.line_changes(spark, sf)
    before = capture_queries.line_state(changes.filter("source_ts < '1999-01-01'"))
    since = datetime(2000, 1, 1)
    snapshot_cycle(before, path, capture_queries.LINE_KEY, "l_shipdate", since)
    out = snapshot_cycle(capture_queries.line_state(changes), path, capture_queries.LINE_KEY, "l_shipdate", since)
    return out.select("phase", "change_type", *capture_queries.LINE_KEY, "l_quantity", "l_shipdate")


QUERIES = {
    f.__name__: f
    for f in (
        stream_change_events, stream_publish, stream_commands, stream_heartbeats, stream_dedup, stream_echo, stream_feed_source,
        stream_committed_sink, poll_scan, snapshot_polls,
    )
}

ORACLE = {
    "stream_change_events": f"""WITH {change_queries.HISTORY_SQL.format(source="events")}
        SELECT event_id, user_id, ts AS source_ts,
        CASE WHEN event_type = 'error' THEN 'Delete' WHEN has_prev THEN 'Update' ELSE 'Insert' END AS change_type,
        CASE WHEN has_prev THEN p_id END AS prev_id, CASE WHEN has_prev THEN p_value END AS prev_value FROM h""",
    "stream_publish": change_queries.ORACLE["change_events_whole"],
    "stream_commands": command_queries.ORACLE["apply_commands"],
    "stream_heartbeats": monitor_queries.HEARTBEATS_SQL,
    "stream_dedup": change_queries.ORACLE["dedup_requests"],
    "stream_echo": command_queries.ORACLE["echo_suppression"],
    "stream_feed_source": """SELECT event_id, ts, value, CASE WHEN day(ts) <= 12 THEN 1 WHEN day(ts) <= 20 THEN 2 ELSE 3 END::BIGINT AS version
        FROM events WHERE day(ts) > 5""",
    "stream_committed_sink": "SELECT event_id, event_type, ts FROM events",
    "poll_scan": "SELECT 'public.events' AS entity, event_id::VARCHAR AS event_id, ts AS source_ts FROM events",
    "snapshot_polls": capture_queries.ORACLE["snapshot_changes"],
}
