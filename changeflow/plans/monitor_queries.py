"""Registered queries: health, windows, outcomes, lifecycle and catalogue checks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from changeflow.operators import monitor
from changeflow.plans.tables import numbered_as_given, read


def _log(spark, sf):
    """``events`` as a health log: each user is a driver, errors and clicks above 40 are failures."""
    ok = ~((F.col("event_type") == "error") | ((F.col("event_type") == "click") & (F.col("value") > 40)))
    return read(spark, sf, "events").select(
        F.concat(F.lit("d"), "user_id").alias("driver_id"), "ts", ok.alias("ok"), F.when(~ok, F.col("props")).alias("error"),
        F.when(ok, "Streaming").otherwise("Failed").alias("state"), F.col("event_id").alias("seq"),
    )


def health_rollup(spark, sf):
    return monitor.health(_log(spark, sf), ["ts", "seq"])


def heartbeat_windows(spark, sf):
    events = read(spark, sf, "events").select("ts", F.col("event_type").alias("driver_id"))
    return monitor.heartbeats(events)


def _lagged(spark, sf):
    """Detected at the event's time, changed at the source ``value`` seconds before; errors are dead letters."""
    source = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) - F.round(F.col("value") * 1_000_000).cast("bigint"))
    return read(spark, sf, "events").select(
        F.col("event_type").alias("driver_id"), F.col("ts").alias("detected_at"), source.alias("source_ts"),
        (F.col("value") > 60).alias("dead"),
    )


def throughput_windows(spark, sf):
    out = monitor.throughput(_lagged(spark, sf), "5 minutes", "1 minute")
    return out.withColumn("max_lag_seconds", F.round("max_lag_seconds", 3))


def throughput_minutes(spark, sf):
    out = monitor.throughput(_lagged(spark, sf), "1 minute", "1 minute")
    return out.withColumn("max_lag_seconds", F.round("max_lag_seconds", 3))


def dead_letters_day(spark, sf):
    return monitor.dead_letters_within(monitor.minute_rollup(_lagged(spark, sf)), 24)


def heartbeats_all_drivers(spark, sf):
    """Hourly heartbeats of one day for every user, most of whom are silent in most hours."""
    events = read(spark, sf, "events").select("ts", F.concat(F.lit("d"), "user_id").alias("driver_id"))
    day = datetime(2024, 1, 10), datetime(2024, 1, 11)
    return monitor.heartbeats_of_all(events, events, *day, every=timedelta(hours=1))


def outcome_counts(spark, sf):
    outcome = F.when(F.col("event_type") == "error", "dead_lettered").when(F.col("event_type") == "view", "retried").otherwise("published")
    log = read(spark, sf, "events").select(F.concat(F.lit("d"), "user_id").alias("driver_id"), outcome.alias("outcome"))
    return monitor.outcome_counts(log)


def lifecycle_audit(spark, sf):
    """Each event is a logged action on a state; state from the hour, action from the type, in mixed case."""
    states = F.array(*map(F.lit, ("Disconnected", "Connecting", "Connected", "Streaming", "Reconnecting", "Failed", "Stopped")))
    action = F.when(F.col("event_type").isin("click", "view"), "Start").when(F.col("event_type") == "error", "RESTART").otherwise("stop")
    log = read(spark, sf, "events").select("event_id", F.element_at(states, F.hour("ts") % 7 + 1).alias("state"), action.alias("action"))
    return monitor.audit_lifecycle(log).withColumn("valid_actions", F.concat_ws(",", "valid_actions"))


def group_profile(spark, sf):
    """Nations of one region have keys that no customer names."""
    key = F.when(F.col("n_regionkey") == 2, F.col("n_nationkey") + 1000).otherwise(F.col("n_nationkey"))
    nations = read(spark, sf, "nation").select(key.alias("n_nationkey"), "n_name")
    out = monitor.group_profile(read(spark, sf, "customer"), nations, "c_nationkey", "n_nationkey", "n_name").orderBy("c_nationkey")
    return numbered_as_given(out)


def not_normal(spark, sf):
    orders = read(spark, sf, "orders").withColumn("state", F.nullif("o_orderstatus", F.lit("P")))
    return monitor.not_in_state(orders, "state", "O").select("o_orderkey", "state", "o_orderpriority")


def row_by_key(spark, sf):
    return monitor.row_by_key(read(spark, sf, "orders"), "o_orderkey", 11)


QUERIES = {
    f.__name__: f
    for f in (
        health_rollup, heartbeat_windows, throughput_windows, throughput_minutes, dead_letters_day, heartbeats_all_drivers, outcome_counts, lifecycle_audit, group_profile,
        not_normal, row_by_key,
    )
}

HEARTBEATS_SQL = """SELECT time_bucket(INTERVAL 30 SECOND, ts) AS window_start, time_bucket(INTERVAL 30 SECOND, ts) + INTERVAL 30 SECOND AS window_end,
        event_type AS driver_id, count(*) AS events, max(ts) AS last_event_at FROM events GROUP BY 1, 2, 3"""


def _throughput_sql(minutes: int) -> str:
    return f"""SELECT w AS window_start, event_type AS driver_id, count(*) AS events, count(*) * 60 / {minutes * 60}.0::DOUBLE AS events_per_minute,
        round(max(round(value * 1000000) / 1000000), 3) AS max_lag_seconds, count(*) FILTER (value > 60) AS dead_letters
        FROM (SELECT *, unnest(generate_series(date_trunc('minute', ts) - INTERVAL {minutes - 1} MINUTE, date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS w FROM events)
        GROUP BY 1, 2"""


_FAIL = "(event_type = 'error' OR (event_type = 'click' AND value > 40))"

ORACLE = {
    "health_rollup": f"""WITH l AS (SELECT *, {_FAIL} AS bad FROM events), s AS (
          SELECT user_id AS u, max((ts, event_id)) FILTER (NOT bad) AS k FROM l GROUP BY 1)
        SELECT 'd' || user_id AS driver_id, count(*) FILTER (NOT bad) AS events_emitted, max(ts) FILTER (NOT bad) AS last_event_at,
          arg_max(props, (ts, event_id)) FILTER (bad) AS last_error, CASE WHEN arg_max(bad, (ts, event_id)) THEN 'Failed' ELSE 'Streaming' END AS state,
          count(*) FILTER (bad AND (k IS NULL OR (ts, event_id) > k)) AS consecutive_failures
        FROM l JOIN s ON u = user_id GROUP BY user_id""",
    "heartbeat_windows": HEARTBEATS_SQL,
    "throughput_windows": _throughput_sql(5),
    "throughput_minutes": _throughput_sql(1),
    "dead_letters_day": """WITH m AS (SELECT date_trunc('minute', ts) AS minute, event_type AS driver_id, count(*) FILTER (value > 60) AS dead FROM events GROUP BY 1, 2)
        SELECT minute, driver_id, sum(dead) OVER (PARTITION BY driver_id ORDER BY minute RANGE BETWEEN INTERVAL 1439 MINUTE PRECEDING AND CURRENT ROW)::BIGINT AS dead_letters FROM m""",
    "heartbeats_all_drivers": """WITH g AS (SELECT DISTINCT 'd' || user_id AS driver_id, w FROM events,
          (SELECT unnest(generate_series(TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-10 23:00:00', INTERVAL 1 HOUR)) AS w)),
        c AS (SELECT 'd' || user_id AS driver_id, date_trunc('hour', ts) AS w, count(*) AS n, max(ts) AS last FROM events GROUP BY 1, 2)
        SELECT g.w AS window_start, g.w + INTERVAL 1 HOUR AS window_end, g.driver_id, coalesce(n, 0) AS events, last AS last_event_at
        FROM g LEFT JOIN c ON c.driver_id = g.driver_id AND c.w = g.w""",
    "outcome_counts": """SELECT 'd' || user_id AS driver_id, count(*) FILTER (event_type NOT IN ('error', 'view')) AS published,
        count(*) FILTER (event_type = 'error') AS dead_lettered, count(*) FILTER (event_type = 'view') AS retried FROM events GROUP BY user_id""",
    "lifecycle_audit": """WITH l AS (SELECT event_id, ['Disconnected', 'Connecting', 'Connected', 'Streaming', 'Reconnecting', 'Failed', 'Stopped'][hour(ts) % 7 + 1] AS state,
          CASE WHEN event_type IN ('click', 'view') THEN 'Start' WHEN event_type = 'error' THEN 'RESTART' ELSE 'stop' END AS action FROM events),
        n AS (SELECT *, CASE WHEN action = 'Start' AND state IN ('Disconnected', 'Failed') THEN 'Connecting'
          WHEN action = 'RESTART' AND state IN ('Failed', 'Streaming') THEN 'Connecting'
          WHEN action = 'stop' AND state IN ('Connecting', 'Connected', 'Streaming', 'Reconnecting') THEN 'Disconnected' END AS next_state FROM l)
        SELECT event_id, state, action, next_state IS NOT NULL AS valid, next_state,
          CASE state WHEN 'Disconnected' THEN 'start' WHEN 'Failed' THEN 'start,restart' WHEN 'Streaming' THEN 'stop,restart' WHEN 'Stopped' THEN '' ELSE 'stop' END AS valid_actions FROM n""",
    "group_profile": """SELECT c_nationkey, coalesce(any_value(n_name), '?') AS group_name, count(*) AS rows, row_number() OVER (ORDER BY c_nationkey) AS place FROM customer
        LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey GROUP BY c_nationkey""",
    "not_normal": "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS state, o_orderpriority FROM orders WHERE o_orderstatus <> 'O'",
    "row_by_key": "SELECT * FROM orders WHERE o_orderkey = 11",
}
