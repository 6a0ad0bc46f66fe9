"""Health, throughput, outcome and lifecycle rollups, and catalogue checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.functions.values import moment
from changeflow.operators.lookup import lookup

# Allowed lifecycle transitions (state, action, next state).
TRANSITIONS = (
    ("Disconnected", "start", "Connecting"),
    ("Failed", "start", "Connecting"),
    ("Failed", "restart", "Connecting"),
    ("Connecting", "stop", "Disconnected"),
    ("Connected", "stop", "Disconnected"),
    ("Streaming", "stop", "Disconnected"),
    ("Streaming", "restart", "Connecting"),
    ("Reconnecting", "stop", "Disconnected"),
)


def health(log: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Per driver: events emitted, last event time, trailing failures, last error and state.

    log: driver_id, ts, ok BOOLEAN, error, state and the order columns. The last error is not cleared
    by a success. The summaries are partial aggregates, so a driver with most of the rows is reduced
    before the shuffle; only failures meet the per-driver last success in a join.
    """
    at = F.struct(*order)
    ok = F.col("ok")
    last_ok = log.filter(ok).groupBy(F.col("driver_id").alias("__d")).agg(F.max(at).alias("__ok"))
    trailing = (
        lookup(log.filter(~ok), last_ok, ["driver_id"], ["__d"])
        .filter(F.col("__ok").isNull() | (at > F.col("__ok")))
        .groupBy("driver_id")
        .agg(F.count(F.lit(1)).alias("consecutive_failures"))
    )
    summary = log.groupBy("driver_id").agg(
        F.count_if(ok).alias("events_emitted"),
        F.max(F.when(ok, F.col("ts"))).alias("last_event_at"),
        F.max_by("error", F.when(~ok, at)).alias("last_error"),
        F.max_by("state", at).alias("state"),
    )
    return summary.join(trailing, "driver_id", "left").withColumn(
        "consecutive_failures", F.coalesce("consecutive_failures", F.lit(0).cast("bigint"))
    )


def heartbeats(
    events: DataFrame, every: str = "30 seconds", ts: str = "ts", late: str | None = None
) -> DataFrame:
    """Events per driver in tumbling event-time windows; ``late`` sets the watermark of a stream."""
    if late is not None:
        events = events.withWatermark(ts, late)
    return (
        events.groupBy(F.window(ts, every).alias("w"), "driver_id")
        .agg(F.count(F.lit(1)).alias("events"), F.max(ts).alias("last_event_at"))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "driver_id", "events",
            "last_event_at",
        )
    )


def heartbeats_of_all(
    events: DataFrame, drivers: DataFrame, start: datetime, end: datetime, every: timedelta = timedelta(seconds=30), ts: str = "ts"
) -> DataFrame:
    """A row per driver and window of [start, end), also where a driver was silent (0 events)."""
    dtype = events.schema[ts].dataType
    first, last = moment(start, dtype), moment(end, dtype) - F.lit(timedelta(microseconds=1))
    size = f"{int(every.total_seconds())} seconds"
    grid = drivers.select("driver_id").distinct().withColumn("t", F.explode(F.sequence(first, last, F.lit(every))))
    grid = grid.select(F.window("t", size).alias("w"), "driver_id").select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "driver_id")
    counted = heartbeats(events.filter((F.col(ts) >= first) & (F.col(ts) <= last)), size, ts)
    return grid.join(counted, ["window_start", "window_end", "driver_id"], "left").withColumn(
        "events", F.coalesce("events", F.lit(0).cast("bigint"))
    )


def minute_rollup(events: DataFrame, ts: str = "detected_at", late: str | None = None) -> DataFrame:
    """Per driver and minute: events, greatest lag in seconds, dead letters. One partial aggregate over the raw rows.

    events: driver_id, detected_at, source_ts, dead BOOLEAN; ``late`` sets the watermark of a stream.
    """
    if late is not None:
        events = events.withWatermark(ts, late)
    lag = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("source_ts").cast("timestamp"))) / 1e6
    return (
        events.groupBy(F.window(ts, "1 minute").alias("w"), "driver_id")
        .agg(F.count(F.lit(1)).alias("events"), F.max(lag).alias("max_lag_seconds"), F.count_if("dead").alias("dead_letters"))
        .select(F.col("w.start").alias("minute"), "driver_id", "events", "max_lag_seconds", "dead_letters")
    )


def throughput(
    events: DataFrame, size: str = "5 minutes", slide: str = "1 minute", ts: str = "detected_at"
) -> DataFrame:
    """Per driver and sliding window of whole minutes: events, events per minute, greatest lag in seconds, dead letters.

    The windows slide over the minute rollup, so what is multiplied is a row per driver and minute, not the events.
    """
    return slide_minutes(minute_rollup(events, ts), size, slide)


def slide_minutes(rollup: DataFrame, size: str, slide: str = "1 minute") -> DataFrame:
    """Sliding windows over a minute rollup."""
    minutes = F.unix_seconds(F.col("w.end").cast("timestamp")) - F.unix_seconds(F.col("w.start").cast("timestamp"))
    return (
        rollup.groupBy(F.window("minute", size, slide).alias("w"), "driver_id")
        .agg(F.sum("events").alias("events"), F.max("max_lag_seconds").alias("max_lag_seconds"), F.sum("dead_letters").alias("dead_letters"))
        .select(
            F.col("w.start").alias("window_start"), "driver_id", "events",
            (F.col("events") * 60 / minutes).alias("events_per_minute"), "max_lag_seconds", "dead_letters",
        )
    )


def dead_letters_within(rollup: DataFrame, hours: int = 24) -> DataFrame:
    """Per driver and minute with events: the dead letters of the ``hours`` up to the end of that minute."""
    at = F.unix_seconds(F.col("minute").cast("timestamp"))
    back = Window.partitionBy("driver_id").orderBy("__at").rangeBetween(-hours * 3600 + 60, 0)
    out = rollup.withColumn("__at", at).withColumn("dead_letters", F.sum("dead_letters").over(back))
    return out.select("minute", "driver_id", "dead_letters")


def outcome_counts(log: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Published, dead-lettered and retried messages per driver."""
    return log.groupBy("driver_id").agg(
        *[F.count_if(F.col(outcome) == n).alias(n) for n in ("published", "dead_lettered", "retried")]
    )


def audit_lifecycle(log: DataFrame, state: str = "state", action: str = "action") -> DataFrame:
    """Whether each logged action was allowed, the expected next state and the allowed actions.

    The transition table is fixed, so it is part of the plan and needs no join.
    """
    name = F.lower(action)
    expected = F.lit(None).cast("string")
    allowed: dict[str, list[str]] = {}
    for before, verb, after in TRANSITIONS:
        expected = F.when((F.col(state) == before) & (name == verb), F.lit(after)).otherwise(expected)
        allowed.setdefault(before, []).append(verb)
    actions = F.array().cast("array<string>")
    for before, verbs in allowed.items():
        actions = F.when(F.col(state) == before, F.array(*map(F.lit, verbs))).otherwise(actions)
    return log.withColumns({"valid": expected.isNotNull(), "next_state": expected, "valid_actions": actions})


def group_profile(rows: DataFrame, names: DataFrame, group: str, name_key: str, name: str) -> DataFrame:
    """Rows per group with the group's name (``?`` when unknown), counted before the join."""
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("rows"))
    table = names.select(F.col(name_key).alias("__n"), F.col(name).alias("group_name"))
    return (
        counts.join(table, F.col(group) == F.col("__n"), "left")
        .select(F.col(group), F.coalesce("group_name", F.lit("?")).alias("group_name"), "rows")
    )


def not_in_state(rows: DataFrame, column: str, normal: object) -> DataFrame:
    """Rows whose state differs from the normal one; a missing state differs."""
    return rows.filter(~F.col(column).eqNullSafe(F.lit(normal)))


def row_by_key(rows: DataFrame, column: str, value: object) -> DataFrame:
    return rows.filter(F.col(column) == F.lit(value))

