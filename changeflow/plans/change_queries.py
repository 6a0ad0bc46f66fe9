"""Registered queries: change events, before images, current state, duplicates."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from changeflow.operators import changes
from changeflow.operators.ordered import numbered
from changeflow.plans.capture_queries import LINE_KEY, LINE_ORDER, LINE_ORDER_SQL, line_changes
from changeflow.plans.forward import Driver, change_events as build_events
from changeflow.plans.tables import numbered_as_given, read
from changeflow.sources import scan

SINCE = datetime(2024, 1, 3)
WEB = Driver("Web-1", "postgres", "ctx:Web")


def event_changes(spark, sf, since: datetime | None = None):
    """``events`` as a change log: key user_id, errors are deletions, everything else a snapshot."""
    events = read(spark, sf, "events")
    if since is not None:
        events = scan.incremental_scan(events, "ts", since)
    kind = F.when(F.col("event_type") == "error", "Delete").otherwise("Snapshot")
    return scan.raw_changes(events, "public.events", "ts", kind)


def event_order():
    return ["source_ts", F.col("row.event_id")]


def _change_events(spark, sf, hot_rows=None, since=SINCE):
    raw = event_changes(spark, sf, since)
    out = build_events(raw, WEB, ["user_id"], event_order(), detected_at=F.col("source_ts"), sequence=True, hot_rows=hot_rows)
    return out.select(
        F.col("fields.event_id").alias("source_event_id"), "pk.user_id", "source_ts", "change_type", "driver_id", "context",
        F.col("fields.event_type").alias("event_type"), F.col("prev.event_type").alias("prev_event_type"),
        F.col("prev.value").alias("prev_value"), "seq", "subject",
    )


def change_events(spark, sf):
    return _change_events(spark, sf)


def change_events_whole(spark, sf):
    """Without a watermark: the whole table."""
    return _change_events(spark, sf, since=None)


def change_events_split(spark, sf):
    """The same with every key treated as too large for one task."""
    return _change_events(spark, sf, hot_rows=0)


def line_events(spark, sf):
    out = changes.with_history(line_changes(spark, sf), LINE_KEY, LINE_ORDER)
    return out.select(
        "row.l_orderkey", "row.l_linenumber", "source_ts", "row.l_quantity", "change_type",
        F.col("prev.l_quantity").alias("prev_quantity"), F.col("prev.l_shipdate").alias("prev_shipdate"),
    )


def supplied_before_image(spark, sf):
    raw = event_changes(spark, sf)
    row = F.col("row").withField("value", F.lit(-1.0))
    raw = raw.withColumn("prev", F.when(F.col("row.event_type") == "purchase", row))
    out = changes.with_before_image(raw, ["user_id"], event_order())
    return out.select("row.event_id", "change_type", F.col("prev.event_id").alias("prev_id"), F.col("prev.value").alias("prev_value"))


def resolved_kinds(spark, sf):
    raw = event_changes(spark, sf)
    raw = raw.withColumn("change_type", F.when(F.col("row.event_type") == "click", "Update").otherwise(F.col("change_type")))
    return changes.resolve_change_type(raw, ["user_id"], event_order()).select("row.event_id", "change_type")


def forgotten_state(spark, sf):
    raw = event_changes(spark, sf)
    out = changes.with_history(raw, ["user_id"], event_order(), ttl=timedelta(hours=12))
    return out.select("row.event_id", "change_type", F.col("prev.event_id").alias("prev_id"))


def current_state(spark, sf):
    return changes.current_state(line_changes(spark, sf), LINE_KEY, LINE_ORDER).select("entity", "row.*")


def field_diff(spark, sf):
    raw = changes.with_history(event_changes(spark, sf), ["user_id"], event_order())
    out = changes.field_diff(raw)
    shown = F.transform("changed", lambda c: F.concat(c["name"], F.lit(":"), F.coalesce(c["old"], F.lit("∅")), F.lit("►"), c["new"]))
    wanted = F.filter(shown, lambda t: t.startswith("user_id") | t.startswith("event_type") | t.startswith("value"))
    return out.select(
        "row.event_id", F.concat_ws(" ", wanted).alias("changes"), F.concat_ws(",", "unchanged").alias("unchanged"),
        F.size("changed").alias("n_changed"),
    )


def resolve_seen(spark, sf):
    seen = read(spark, sf, "events").filter("ts < '2024-01-10' and event_type = 'signup'").select("user_id")
    raw = event_changes(spark, sf, datetime(2024, 1, 10))
    return changes.resolve_against(raw, seen, ["user_id"]).select("row.event_id", "change_type")


def event_identity(spark, sf):
    raw = event_changes(spark, sf).withColumn("driver_id", F.lit("Web-1"))
    out = changes.with_event_id(raw, ["driver_id", "entity", F.col("row.user_id"), F.col("row.event_id")])
    return out.select(F.col("row.event_id").alias("source_event_id"), "event_id")


def sequence_numbers(spark, sf):
    """One driver per status: three groups that hold the whole table, so the split form is used."""
    orders = read(spark, sf, "orders")
    return numbered(orders, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], "seq", hot_rows=100).select(
        "o_orderkey", "o_orderstatus", "seq"
    )


def _dedup(spark, sf, hours, **options):
    events = read(spark, sf, "events").select("event_id", "user_id", "ts")
    return changes.dedup_requests(events, "user_id", "ts", timedelta(hours=hours), tie=["event_id"], **options)


def dedup_requests(spark, sf):
    return _dedup(spark, sf, 24)


def dedup_requests_split(spark, sf):
    return _dedup(spark, sf, 48, hot_rows=20, fold_rows=20)


def key_history(spark, sf):
    """All changes of one key, newest first."""
    raw = event_changes(spark, sf).withColumn("event_id", F.col("row.event_id"))
    out = changes.key_history(raw, {"user_id": 7}, ["source_ts", "event_id"])
    return numbered_as_given(out.select("event_id", "row.user_id", "source_ts"))


def document_changes(spark, sf):
    """Each event of a user as a document, against the document of the event before; some have a field that others lack."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    flags = F.when(cents % 3 == 0, F.struct(cents.alias("deep")))
    document = F.to_json(F.struct(F.struct(F.col("user_id").alias("id")).alias("user"), F.struct(F.col("event_type").alias("type"), (cents % 5).alias("mark"), flags.alias("flags")).alias("event")))
    rows = read(spark, sf, "events").select("event_id", "user_id", "ts", document.alias("after"))
    before = F.lag("after").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return changes.document_diff(rows.withColumn("before", before), ["event_id"], "after", "before")


QUERIES = {
    f.__name__: f
    for f in (
        document_changes,
        change_events, change_events_whole, change_events_split, line_events, supplied_before_image, resolved_kinds, forgotten_state,
        current_state, field_diff, resolve_seen, event_identity, sequence_numbers, dedup_requests,
        dedup_requests_split, key_history,
    )
}

W = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"
# Every event with its predecessor of the same user; a deleted predecessor leaves no image.
HISTORY_SQL = f"""h AS (
  SELECT *, p_type IS NOT NULL AND p_type <> 'error' AS has_prev FROM (
    SELECT *, lag(event_type) {W} AS p_type, lag(value) {W} AS p_value, lag(event_id) {W} AS p_id, lag(ts) {W} AS p_ts,
           lag(props) {W} AS p_props FROM {{source}}))"""
_KIND = "CASE WHEN event_type = 'error' THEN 'Delete' WHEN has_prev THEN 'Update' ELSE 'Insert' END"
_EVENTS_SQL = f"""WITH e AS (SELECT * FROM events WHERE ts > TIMESTAMP '{{since}}'),
  {HISTORY_SQL.format(source="e")}
  SELECT event_id AS source_event_id, user_id, ts AS source_ts, {_KIND} AS change_type, 'Web-1' AS driver_id,
    'ctx:Web' AS context, event_type, CASE WHEN has_prev THEN p_type END AS prev_event_type,
    CASE WHEN has_prev THEN p_value END AS prev_value, row_number() OVER (ORDER BY ts, event_id) AS seq,
    'cdc.ctx-web.public.events.' || lower({_KIND}) AS subject FROM h"""


def _dedup_sql(hours: int) -> str:
    return f"""WITH RECURSIVE acc AS (
        SELECT user_id, min(ts) AS ts FROM events GROUP BY user_id
        UNION ALL
        SELECT a.user_id, min(e.ts) AS ts FROM acc a JOIN events e
          ON e.user_id = a.user_id AND e.ts >= a.ts + INTERVAL {hours} HOUR GROUP BY a.user_id, a.ts)
      SELECT event_id, user_id, ts, NOT (rn = 1 AND EXISTS (SELECT 1 FROM acc WHERE acc.user_id = e.user_id AND acc.ts = e.ts)) AS duplicate
      FROM (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS rn FROM events) e"""


_LINE_W = f"OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL})"

ORACLE = {
    "document_changes": """WITH d AS (SELECT event_id, user_id, ts, event_type AS t, round(value * 100)::BIGINT AS c FROM events),
        h AS (SELECT *, lag(t) OVER w AS pt, lag(c) OVER w AS pc FROM d WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        f AS (SELECT event_id, unnest(['event.type', 'event.mark', 'event.flags.deep']) AS path,
          unnest(['"' || pt || '"', (pc % 5)::VARCHAR, CASE WHEN pc % 3 = 0 THEN pc::VARCHAR END]) AS old,
          unnest(['"' || t || '"', (c % 5)::VARCHAR, CASE WHEN c % 3 = 0 THEN c::VARCHAR END]) AS new FROM h WHERE pt IS NOT NULL)
        SELECT event_id, path, CASE WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'removed' ELSE 'changed' END AS kind, old, new
        FROM f WHERE old IS DISTINCT FROM new""",
    "change_events": _EVENTS_SQL.format(since="2024-01-03"),
    "change_events_whole": _EVENTS_SQL.format(since="0001-01-01"),
    "change_events_split": _EVENTS_SQL.format(since="2024-01-03"),
    "line_events": f"""SELECT l_orderkey, l_linenumber, l_shipdate AS source_ts, l_quantity,
        CASE WHEN l_returnflag = 'R' THEN 'Delete' WHEN pf IS NOT NULL AND pf <> 'R' THEN 'Update' ELSE 'Insert' END AS change_type,
        CASE WHEN pf <> 'R' THEN pq END AS prev_quantity, CASE WHEN pf <> 'R' THEN ps END AS prev_shipdate
        FROM (SELECT *, lag(l_returnflag) {_LINE_W} AS pf, lag(l_quantity) {_LINE_W} AS pq, lag(l_shipdate) {_LINE_W} AS ps FROM lineitem)""",
    "supplied_before_image": f"""WITH {HISTORY_SQL.format(source="events")}
        SELECT event_id, CASE WHEN event_type = 'error' THEN 'Delete' ELSE 'Snapshot' END AS change_type,
        CASE WHEN event_type = 'purchase' THEN event_id WHEN has_prev THEN p_id END AS prev_id,
        CASE WHEN event_type = 'purchase' THEN -1.0::DOUBLE WHEN has_prev THEN p_value END AS prev_value FROM h""",
    "resolved_kinds": f"""WITH {HISTORY_SQL.format(source="events")}
        SELECT event_id, CASE WHEN event_type = 'click' THEN 'Update' ELSE {_KIND} END AS change_type FROM h""",
    "forgotten_state": f"""WITH {HISTORY_SQL.format(source="events")}, f AS (
          SELECT * REPLACE (has_prev AND ts - p_ts <= INTERVAL 12 HOUR AS has_prev) FROM h)
        SELECT event_id, {_KIND} AS change_type, CASE WHEN has_prev THEN p_id END AS prev_id FROM f""",
    "current_state": f"""SELECT 'public.lineitem' AS entity, * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(c.strip() + " DESC" for c in LINE_ORDER_SQL.split(","))}) AS rn FROM lineitem)
        WHERE rn = 1 AND l_returnflag <> 'R'""",
    "field_diff": f"""WITH {HISTORY_SQL.format(source="events")}
        SELECT event_id,
          CASE WHEN has_prev THEN concat_ws(' ', CASE WHEN p_type <> event_type THEN 'event_type:' || p_type || '►' || event_type END,
            CASE WHEN p_value <> value THEN 'value:' || p_value || '►' || value END) ELSE '' END AS changes,
          CASE WHEN has_prev THEN concat_ws(',', 'user_id', CASE WHEN p_type = event_type THEN 'event_type' END,
            CASE WHEN p_value = value THEN 'value' END, CASE WHEN p_props = props THEN 'props' END) ELSE '' END AS unchanged,
          CASE WHEN has_prev THEN 2 + (p_type <> event_type)::INT + (p_value <> value)::INT + (p_props <> props)::INT ELSE 0 END AS n_changed
        FROM h""",
    "resolve_seen": """SELECT event_id, CASE WHEN event_type = 'error' THEN 'Delete' WHEN user_id IN
          (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_type = 'signup') THEN 'Update' ELSE 'Insert' END AS change_type
        FROM events WHERE ts > TIMESTAMP '2024-01-10'""",
    "event_identity": """SELECT event_id AS source_event_id, printf('%012x', epoch_us(ts) // 1000) ||
        sha256('5:Web-1' || '13:public.events' || length(user_id::VARCHAR) || ':' || user_id || length(event_id::VARCHAR) || ':' || event_id) AS event_id FROM events""",
    "sequence_numbers": """SELECT o_orderkey, o_orderstatus,
        row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS seq FROM orders""",
    "dedup_requests": _dedup_sql(24),
    "dedup_requests_split": _dedup_sql(48),
    "key_history": """SELECT event_id, user_id, ts AS source_ts, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS place
        FROM events WHERE user_id = 7""",
}
