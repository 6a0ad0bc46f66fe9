"""Registered queries: scans, snapshot differences and change feeds."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.text import checkpoint_key, key_text, snapshot_key
from changeflow.functions.values import cold_start, normalise_watermark
from changeflow.operators.changes import current_state
from changeflow.plans.tables import read
from changeflow.sinks.checkpoints import checkpoints, positions, resume, save_checkpoints
from changeflow.sinks.tables import read_version
from changeflow.scratch import shared_path
from changeflow.sources import feeds, scan
from changeflow.spec import Entity

SINCE = datetime(1998, 1, 1)
MID = datetime(2024, 1, 15)

# lineitem as a change log: composite key, returned lines are deletions, all columns order the ties.
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["source_ts", "row"]
LINE_ORDER_SQL = (
    "l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus"
)


def line_changes(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "R", "Delete").otherwise("Snapshot")
    return scan.raw_changes(read(spark, sf, "lineitem"), "public.lineitem", "l_shipdate", kind)


def line_state(changes: DataFrame) -> DataFrame:
    return current_state(changes, LINE_KEY, LINE_ORDER).select("row.*")


def _line_state_sql(where: str = "") -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(c.strip() + " DESC" for c in LINE_ORDER_SQL.split(","))}) AS rn
      FROM lineitem {where}) WHERE rn = 1 AND l_returnflag <> 'R'"""


def incremental_scan(spark, sf):
    orders = read(spark, sf, "orders")
    rows = scan.incremental_scan(orders, "o_orderdate", SINCE)
    return scan.raw_changes(rows, "public.orders", "o_orderdate").select(
        "entity", "change_type", "source_ts", "row.o_orderkey", "row.o_totalprice"
    )


def cold_start_scan(spark, sf):
    start = cold_start(datetime(2001, 8, 1), "P90D")
    return scan.incremental_scan(read(spark, sf, "orders"), "o_orderdate", start).select("o_orderkey", "o_orderdate")


def filtered_scan(spark, sf):
    rows = scan.incremental_scan(read(spark, sf, "orders"), "o_orderdate", SINCE, predicate="o_totalprice > 200000")
    return rows.select("o_orderkey", "o_totalprice")


def watermark_advance(spark, sf):
    orders = read(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("driver_id"), F.lit("public.orders").alias("entity"), "o_orderstatus", "o_orderdate"
    )
    state = (
        orders.filter("o_orderstatus = 'F' and driver_id <> '5-LOW'")
        .groupBy("driver_id", "entity").agg(F.max("o_orderdate").alias("since"))
    )
    return scan.advance_watermark(orders.filter("o_orderstatus = 'O'"), "o_orderdate", state)


def multi_entity_scan(spark, sf):
    tables = [
        (Entity("public.orders", ("o_orderkey",), watermark="o_orderdate"), read(spark, sf, "orders")),
        (Entity("public.lineitem", ("l_orderkey", "l_linenumber"), "l_quantity > 10", "l_shipdate"), read(spark, sf, "lineitem")),
        (Entity("public.events", ("event_id",), watermark="ts"), read(spark, sf, "events")),
    ]
    since = {"public.orders": SINCE, "public.lineitem": datetime(1999, 1, 1), "public.events": MID}
    return scan.scan_all(tables, since).select("entity", "change_type", "source_ts", "pk")


def shared_scan(spark, sf):
    events = read(spark, sf, "events").withColumnRenamed("event_type", "entity")
    state = events.filter("value > 50").groupBy("entity").agg(F.min("ts").alias("since"))
    return scan.scan_shared(events, "ts", state).select("entity", "event_id", "ts")


def watermark_kinds(spark, sf):
    events = read(spark, sf, "events")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    forms = {
        "epoch_ms": (F.unix_millis(F.col("ts").cast("timestamp")), "epoch_ms"),
        "local_text": (text, "local"),
        "zoned_text": (F.concat(text, F.lit("+00:00")), "zoned"),
        "other": (F.col("event_type"), "unknown"),
    }
    return events.select(
        "event_id",
        *[F.date_format(normalise_watermark(c, k), "yyyy-MM-dd HH:mm:ss.SSS").alias(n) for n, (c, k) in forms.items()],
    )


def key_texts(spark, sf):
    talks = read(spark, sf, "conversations")
    part = F.nullif(F.col("role"), F.lit("user"))
    return talks.select(
        "conv_id", "turn",
        key_text(["conv_id", "turn", part]).alias("key_text"),
        snapshot_key(F.lit("public.talks"), ["conv_id", "turn", part]).alias("snapshot_key"),
        checkpoint_key(F.lit("Driver A:1"), F.concat(F.lit("a\\b/"), "role", F.lit("=é#"), "conv_id")).alias("checkpoint_key"),
    )


def late_overlap(spark, sf):
    orders = read(spark, sf, "orders")
    emitted = orders.filter("o_orderstatus = 'F'")
    rows = scan.incremental_scan(
        orders, "o_orderdate", SINCE, overlap=timedelta(days=30), emitted=emitted, key=["o_orderkey"]
    )
    return rows.select("o_orderkey", "o_orderdate", "o_orderstatus")


def anchored_scan(spark, sf):
    events = read(spark, sf, "events")
    stored = scan.anchor_position(events.filter("ts < '2024-01-15'"), "event_id").first()["position"]
    return scan.anchor(events, "event_id", stored).select("event_id", "ts")


def _positions(spark, sf) -> DataFrame:
    return read(spark, sf, "events").select(
        F.lit("web").alias("driver_id"), F.col("event_type").alias("entity"), F.col("ts").alias("source_ts"),
        F.col("ts").alias("detected_at"), F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("event_id"),
    )


def checkpoint_rollup(spark, sf):
    rows = _positions(spark, sf)
    sparse = rows.withColumn("source_ts", F.when(F.col("entity") != "view", F.col("source_ts")))
    return checkpoints(sparse).withColumn("key", checkpoint_key("driver_id", "entity"))


def checkpoint_merge(spark, sf):
    rows = _positions(spark, sf)
    """Positions of all events, then those of a source that was set back for two entities."""
    old = checkpoints(rows)
    new = checkpoints(rows.filter("source_ts < '2024-01-10' and entity in ('click', 'view')"))
    path = shared_path(spark, "checkpoints")
    save_checkpoints(old, path)
    save_checkpoints(new, path)
    return read_version(spark, path).select("driver_id", "entity", "position", "updated_at")


def resume_from_checkpoint(spark, sf):
    rows = _positions(spark, sf)
    stored = checkpoints(rows.filter("source_ts < '2024-01-15' and entity <> 'signup'"))
    return resume(rows, stored, "source_ts", datetime(2024, 1, 25)).select("entity", "event_id", "source_ts")


def resume_by_kind(spark, sf):
    """Positions of three kinds in one checkpoint table: a time, an event id, a version number."""
    rows = _positions(spark, sf).withColumn("event_number", F.col("seq"))
    sparse = rows.withColumn("source_ts", F.when(F.col("entity") == "click", F.col("source_ts")))
    stored = checkpoints(sparse.filter("detected_at < '2024-01-15' and entity in ('click', 'view')"))
    by_time = resume(rows, stored, "source_ts", datetime(2024, 1, 25), id_col="event_number").select("entity", "event_id", F.lit("time").alias("kind"))
    log = _tracking_log(spark, sf).withColumns({"driver_id": F.lit("ct"), "entity": F.col("operation")})
    state = log.groupBy("driver_id", "entity").agg(F.max(F.when(F.col("version") < 1500, F.col("version"))).alias("version"))
    kept = positions(state.filter("entity <> 'D'"), "version")
    path = shared_path(spark, "positions")
    save_checkpoints(stored.select("driver_id", "entity", "position", F.col("updated_at").cast("timestamp").alias("updated_at")), path)
    save_checkpoints(kept, path)
    by_version = resume(log, read_version(spark, path), "version", 2000)
    return by_time.unionByName(by_version.select("entity", F.concat_ws("-", "o_orderkey", "version").alias("event_id"), F.lit("version").alias("kind")))


def snapshot_deletes(spark, sf):
    changes = line_changes(spark, sf)
    before, now = line_state(changes.filter("source_ts < '1999-01-01'")), line_state(changes)
    return scan.snapshot_diff(before, now, LINE_KEY).select(*LINE_KEY, "l_quantity", "l_shipdate")


def snapshot_changes(spark, sf):
    changes = line_changes(spark, sf)
    before, now = line_state(changes.filter("source_ts < '1999-01-01'")), line_state(changes)
    out = scan.snapshot_changes(before, now, LINE_KEY, "l_shipdate", datetime(2000, 1, 1))
    return out.select("phase", "change_type", *LINE_KEY, "l_quantity", "l_shipdate")


def graph_scan(spark, sf):
    customers, nations, orders = (read(spark, sf, n) for n in ("customer", "nation", "orders"))
    nodes = customers.select(
        F.lit("Customer").alias("label"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    ).unionByName(
        nations.select(F.lit("Nation").alias("label"), F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))
    )
    edges = customers.select(
        F.lit("LIVES_IN").alias("type"), F.col("c_custkey").alias("src"), F.col("c_nationkey").cast("bigint").alias("dst")
    ).unionByName(
        orders.select(F.lit("PLACED_BY").alias("type"), F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst"))
    )
    found = scan.graph_scan(nodes, edges, "REL:PLACED_BY").select("type", "src", "dst", F.lit(None).cast("string").alias("name"))
    return found.unionByName(
        scan.graph_scan(nodes, edges, "Customer").select(
            F.col("label").alias("type"), F.col("id").alias("src"), F.lit(None).cast("bigint").alias("dst"), "name"
        )
    )


def _tracking_log(spark, sf) -> DataFrame:
    code = F.when(F.col("l_returnflag") == "N", "I").when(F.col("l_returnflag") == "A", "U").otherwise("D")
    return read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.datediff("l_shipdate", F.lit("1995-01-01")).cast("bigint").alias("version"),
        F.when(F.col("l_linenumber") == 7, "X").otherwise(code).alias("operation"),
    )


def change_tracking_join(spark, sf):
    """All orders; those in status F have keys that the log does not name."""
    key = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") + 1_000_000_000).otherwise(F.col("o_orderkey"))
    table = read(spark, sf, "orders").select(key.alias("o_orderkey"), "o_orderstatus", "o_totalprice")
    return feeds.changes_join_current(_tracking_log(spark, sf), table, ["o_orderkey"], 1000)


def version_advance(spark, sf):
    log = _tracking_log(spark, sf)
    return scan.advance_version(log.filter("version > 1000"), "version", 1000).unionByName(
        scan.advance_version(log.filter("version > 100000000"), "version", 1000)
    )


def _feed(spark, sf) -> DataFrame:
    orders = read(spark, sf, "orders")
    kind = (
        F.when(F.col("o_orderstatus") == "O", F.array(F.lit("insert")))
        .when(F.col("o_orderstatus") == "P", F.array(F.lit("update_preimage"), F.lit("update_postimage")))
        .otherwise(F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("other"))).otherwise(F.array(F.lit("delete"))))
    )
    return orders.withColumn("_change_type", F.explode(kind)).select(
        "o_orderkey",
        F.when(F.col("_change_type") == "update_preimage", "OLD").otherwise(F.col("o_orderpriority")).alias("priority"),
        "_change_type",
        F.datediff("o_orderdate", F.lit("1995-01-01")).cast("bigint").alias("_commit_version"),
        F.col("o_orderdate").alias("_commit_timestamp"),
    )


def change_feed(spark, sf):
    return feeds.read_change_feed(_feed(spark, sf), 365)


def change_feed_latest(spark, sf):
    return feeds.read_change_feed(_feed(spark, sf))


def change_feed_before(spark, sf):
    out = feeds.read_change_feed(_feed(spark, sf), 365, keep_before=True, key=["o_orderkey"])
    return out.select("version", "change_type", "o_orderkey", "priority", F.col("prev.priority").alias("prev_priority"))


def change_feed_position(spark, sf):
    feed = _feed(spark, sf)
    return feeds.next_feed_version(feed, 365).unionByName(feeds.next_feed_version(feed, 10_000_000))


def log_decode(spark, sf):
    orders = read(spark, sf, "orders")
    names = F.array(*map(F.lit, ("o_orderkey", "o_orderstatus", "o_orderpriority")))
    new = F.array(F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    old = F.array(F.col("o_orderkey").cast("string"), F.lit("N"), F.lit(None).cast("string"))
    message = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "insert")
        .when(F.col("o_orderpriority") == "2-HIGH", F.when(F.col("o_orderstatus") == "F", "index_update").otherwise("full_update"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.when(F.col("o_orderstatus") == "F", "begin").otherwise("update"))
        .when(F.col("o_orderstatus") == "F", "key_delete")
        .otherwise("full_delete")
    )
    messages = orders.select(
        message.alias("message"), F.lit("public").alias("namespace"), F.lit("orders").alias("relation"),
        F.col("o_orderdate").alias("server_ts"), names.alias("columns"), new.alias("new_values"), old.alias("old_values"),
        F.array(F.lit("o_orderkey")).alias("key_columns"), F.array(F.col("o_orderkey").cast("string")).alias("key_values"),
    )
    get = lambda m, k: F.try_element_at(F.col(m), F.lit(k))
    return feeds.decode_log_messages(messages).select(
        "entity", "change_type", "source_ts",
        get("row", "o_orderkey").alias("order_key"), get("row", "o_orderstatus").alias("status"),
        get("row", "o_orderpriority").alias("priority"),
        get("prev", "o_orderkey").alias("prev_key"), get("prev", "o_orderstatus").alias("prev_status"),
    )


def debezium_decode(spark, sf):
    orders = read(spark, sf, "orders")
    op = (
        F.when(F.col("o_orderstatus") == "O", F.when(F.col("o_orderpriority") == "5-LOW", "r").otherwise("c"))
        .when(F.col("o_orderstatus") == "P", "u").otherwise("d")
    )
    image = F.struct("o_orderkey", "o_orderpriority")
    before = F.when(F.col("o_orderstatus") != "O", F.struct("o_orderkey", F.lit("?").alias("o_orderpriority")))
    source = F.struct(
        F.lit("2.7.0").alias("version"), F.lit("postgresql").alias("connector"),
        F.concat(F.lit("pg-"), F.lower("o_orderstatus")).alias("name"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
        F.when(op == "r", "true").alias("snapshot"),
        F.when(F.col("o_orderpriority") != "2-HIGH", "sales").alias("schema"), F.lit("orders").alias("table"),
    )
    payload = F.struct(before.alias("before"), F.when(op != "d", image).alias("after"), source.alias("source"), op.alias("op"))
    feed = orders.select(F.to_json(F.struct(payload.alias("payload"))).alias("value"))
    out = feeds.decode_debezium(feed, {"pg-o": "ctx:open", "pg-p": "ctx:pending"})
    get = lambda m, k: F.try_element_at(F.col(m), F.lit(k))
    return out.select(
        "driver_id", "source_type", "context", "entity", "change_type",
        F.date_format("source_ts", "yyyy-MM-dd HH:mm:ss").alias("source_ts"),
        get("row", "o_orderkey").alias("order_key"), get("prev", "o_orderkey").alias("prev_key"),
        get("row", "o_orderpriority").alias("priority"), get("prev", "o_orderpriority").alias("prev_priority"),
        get("meta", "snapshot").alias("snapshot"), get("meta", "debezium_version").alias("version"),
    )


def _catalogue(spark, sf):
    """Orders as tables and their line numbers as key columns, so a key has at most a few columns."""
    orders, lines = read(spark, sf, "orders"), read(spark, sf, "lineitem")
    tables = orders.select(
        F.lower("o_orderpriority").alias("table_schema"), F.concat(F.lit("t"), "o_orderkey").alias("table_name"),
        F.when(F.col("o_orderstatus") != "P", "BASE TABLE").otherwise("VIEW").alias("table_type"),
        F.concat(F.lit("pk_"), "o_orderkey").alias("constraint_name"),
        F.when(F.col("o_totalprice") > 100000, "PRIMARY KEY").otherwise("UNIQUE").alias("constraint_type"), "o_orderkey",
    )
    columns = lines.select("l_orderkey", "l_linenumber").distinct()
    usage = columns.join(tables, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "table_schema", "table_name", "constraint_name",
        F.concat(F.lit("col_"), "l_linenumber").alias("column_name"), F.col("l_linenumber").alias("ordinal_position"),
    )
    return tables, usage


def discover_tables(spark, sf):
    tables, _ = _catalogue(spark, sf)
    return scan.discover_tables(tables, ("5-low", "2-high"))


def discover_keys(spark, sf):
    tables, usage = _catalogue(spark, sf)
    out = scan.discover_keys(
        tables.select("table_schema", "table_name", "constraint_name", "constraint_type"), usage,
        tables.select("table_schema", "table_name", "table_type"),
    )
    return out.select("entity", F.concat_ws(",", "key_columns").alias("key_columns"))


QUERIES = {
    f.__name__: f
    for f in (
        incremental_scan, cold_start_scan, filtered_scan, watermark_advance, multi_entity_scan, shared_scan,
        watermark_kinds, key_texts, late_overlap, anchored_scan, checkpoint_rollup, checkpoint_merge,
        resume_from_checkpoint, resume_by_kind, snapshot_deletes, snapshot_changes, graph_scan, change_tracking_join,
        version_advance, change_feed, change_feed_latest, change_feed_before, change_feed_position, log_decode,
        debezium_decode, discover_tables, discover_keys,
    )
}

_FEED_SQL = """feed AS (
  SELECT o_orderkey, CASE WHEN t = 'update_preimage' THEN 'OLD' ELSE o_orderpriority END AS priority, t,
         date_diff('day', DATE '1995-01-01', o_orderdate::DATE) AS v
  FROM (SELECT *, unnest(CASE WHEN o_orderstatus = 'O' THEN ['insert']
                              WHEN o_orderstatus = 'P' THEN ['update_preimage', 'update_postimage']
                              WHEN o_orderpriority = '1-URGENT' THEN ['other'] ELSE ['delete'] END) AS t FROM orders))"""
_FEED_KIND = "CASE t WHEN 'insert' THEN 'Insert' WHEN 'update_postimage' THEN 'Update' WHEN 'delete' THEN 'Delete' ELSE 'Snapshot' END"
_LOG_SQL = """log AS (
  SELECT l_orderkey AS k, date_diff('day', DATE '1995-01-01', l_shipdate::DATE) AS version,
         CASE WHEN l_linenumber = 7 THEN 'Snapshot' WHEN l_returnflag = 'N' THEN 'Insert'
              WHEN l_returnflag = 'A' THEN 'Update' ELSE 'Delete' END AS kind FROM lineitem)"""
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0'"

ORACLE = {
    "incremental_scan": """SELECT 'public.orders' AS entity, 'Snapshot' AS change_type, o_orderdate AS source_ts,
        o_orderkey, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'""",
    "cold_start_scan": """SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderdate > TIMESTAMP '2001-08-01' - INTERVAL 90 DAY""",
    "filtered_scan": """SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_totalprice > 200000""",
    "watermark_advance": """WITH s AS (SELECT o_orderpriority AS d, max(o_orderdate) AS since FROM orders
          WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' GROUP BY 1),
        n AS (SELECT o_orderpriority AS d, max(o_orderdate) AS m FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
        SELECT coalesce(s.d, n.d) AS driver_id, 'public.orders' AS entity, greatest(since, m) AS since
        FROM s FULL JOIN n ON s.d = n.d""",
    "multi_entity_scan": """SELECT 'public.orders' AS entity, 'Snapshot' AS change_type, o_orderdate AS source_ts,
          '{"o_orderkey":' || o_orderkey || '}' AS pk FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'
        UNION ALL SELECT 'public.lineitem', 'Snapshot', l_shipdate,
          '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}' FROM lineitem
          WHERE l_quantity > 10 AND l_shipdate > TIMESTAMP '1999-01-01'
        UNION ALL SELECT 'public.events', 'Snapshot', ts, '{"event_id":' || event_id || '}' FROM events
          WHERE ts > TIMESTAMP '2024-01-15'""",
    "shared_scan": """SELECT event_type AS entity, event_id, ts FROM events JOIN
          (SELECT event_type AS t, min(ts) AS since FROM events WHERE value > 50 GROUP BY 1) ON event_type = t
        WHERE ts > since""",
    "watermark_kinds": """SELECT event_id, left(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 23) AS epoch_ms,
        left(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 23) AS local_text,
        left(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 23) AS zoned_text, NULL::VARCHAR AS other FROM events""",
    "key_texts": """SELECT conv_id, turn,
        conv_id || '|' || turn || '|' || coalesce(nullif(role, 'user'), '') AS key_text,
        'public.talks:' || conv_id || ':' || turn || ':' || coalesce(nullif(role, 'user'), '∅') AS snapshot_key,
        'driver-a-1.a/b/' || lower(role) || '=é_' || conv_id AS checkpoint_key FROM conversations""",
    "late_overlap": """SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
        WHERE o_orderdate > TIMESTAMP '1998-01-01' - INTERVAL 30 DAY AND o_orderstatus <> 'F'""",
    "anchored_scan": """SELECT event_id, ts FROM events
        WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-15')""",
    "checkpoint_rollup": f"""SELECT 'web' AS driver_id, event_type AS entity,
        arg_max(CASE WHEN event_type <> 'view' THEN {_ISO} ELSE event_id::VARCHAR END, event_id) AS position,
        arg_max(ts, event_id) AS updated_at, 'web.' || event_type AS key FROM events GROUP BY event_type""",
    "checkpoint_merge": f"""SELECT 'web' AS driver_id, event_type AS entity, arg_max({_ISO}, event_id) AS position,
        arg_max(ts, event_id) AS updated_at FROM events
        WHERE event_type NOT IN ('click', 'view') OR ts < TIMESTAMP '2024-01-10'
        GROUP BY event_type""",
    "resume_from_checkpoint": """WITH s AS (SELECT event_type AS t, arg_max(ts, event_id) AS p FROM events
          WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'signup' GROUP BY 1)
        SELECT event_type AS entity, event_id::VARCHAR AS event_id, ts AS source_ts FROM events LEFT JOIN s ON event_type = t
        WHERE ts > coalesce(p, TIMESTAMP '2024-01-25')""",
    "resume_by_kind": f"""WITH {_LOG_SQL}, s AS (SELECT event_type AS t, max(event_id) AS i, arg_max(ts, event_id) AS p FROM events
          WHERE ts < TIMESTAMP '2024-01-15' AND event_type IN ('click', 'view') GROUP BY 1),
        raw AS (SELECT l_orderkey AS k, date_diff('day', DATE '1995-01-01', l_shipdate::DATE) AS version,
          CASE WHEN l_linenumber = 7 THEN 'X' WHEN l_returnflag = 'N' THEN 'I' WHEN l_returnflag = 'A' THEN 'U' ELSE 'D' END AS op FROM lineitem),
        m AS (SELECT op, max(version) FILTER (version < 1500) AS v FROM raw WHERE op <> 'D' GROUP BY 1)
        SELECT event_type AS entity, event_id::VARCHAR AS event_id, 'time' AS kind FROM events LEFT JOIN s ON event_type = t
        WHERE CASE WHEN event_type = 'view' AND t IS NOT NULL THEN event_id > i ELSE ts > coalesce(p, TIMESTAMP '2024-01-25') END
        UNION ALL SELECT raw.op, k || '-' || version, 'version' FROM raw LEFT JOIN m ON raw.op = m.op WHERE version > coalesce(v, 2000)""",
    "snapshot_deletes": f"""WITH b AS ({_line_state_sql("WHERE l_shipdate < TIMESTAMP '1999-01-01'")}), n AS ({_line_state_sql()})
        SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM b
        WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM n)""",
    "snapshot_changes": f"""WITH b AS ({_line_state_sql("WHERE l_shipdate < TIMESTAMP '1999-01-01'")}), n AS ({_line_state_sql()})
        SELECT 0 AS phase, 'Delete' AS change_type, l_orderkey, l_linenumber, l_quantity, l_shipdate FROM b
        WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM n)
        UNION ALL SELECT 1, 'Snapshot', l_orderkey, l_linenumber, l_quantity, l_shipdate FROM n
        WHERE l_shipdate > TIMESTAMP '2000-01-01'""",
    "graph_scan": """SELECT 'PLACED_BY' AS type, o_orderkey AS src, o_custkey AS dst, NULL::VARCHAR AS name FROM orders
        UNION ALL SELECT 'Customer', c_custkey, NULL, c_name FROM customer""",
    "change_tracking_join": f"""WITH {_LOG_SQL} SELECT version, kind AS change_type, k AS o_orderkey,
        CASE WHEN kind <> 'Delete' THEN o_orderstatus END AS o_orderstatus,
        CASE WHEN kind <> 'Delete' THEN o_totalprice END AS o_totalprice
        FROM log LEFT JOIN (SELECT * REPLACE (o_orderkey + CASE WHEN o_orderstatus = 'F' THEN 1000000000 ELSE 0 END AS o_orderkey) FROM orders) ON k = o_orderkey WHERE version > 1000""",
    "version_advance": f"WITH {_LOG_SQL} SELECT max(version) AS position FROM log WHERE version > 1000 UNION ALL SELECT 1000",
    "change_feed": f"""WITH {_FEED_SQL} SELECT v AS version, {_FEED_KIND} AS change_type, o_orderkey, priority FROM feed
        WHERE v >= 365 AND t <> 'update_preimage'""",
    "change_feed_latest": f"""WITH {_FEED_SQL} SELECT v AS version, {_FEED_KIND} AS change_type, o_orderkey, priority FROM feed
        WHERE v >= (SELECT max(v) FROM feed) AND t <> 'update_preimage'""",
    "change_feed_before": f"""WITH {_FEED_SQL} SELECT v AS version, {_FEED_KIND} AS change_type, o_orderkey, priority,
        CASE WHEN t = 'update_postimage' THEN 'OLD' END AS prev_priority FROM feed
        WHERE v >= 365 AND t <> 'update_preimage'""",
    "change_feed_position": f"WITH {_FEED_SQL} SELECT max(v) + 1 AS position FROM feed UNION ALL SELECT 10000000",
    "log_decode": """WITH m AS (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 'insert'
          WHEN o_orderpriority = '2-HIGH' THEN CASE WHEN o_orderstatus = 'F' THEN 'index_update' ELSE 'full_update' END
          WHEN o_orderpriority = '3-MEDIUM' THEN CASE WHEN o_orderstatus = 'F' THEN 'begin' ELSE 'update' END
          WHEN o_orderstatus = 'F' THEN 'key_delete' ELSE 'full_delete' END AS message FROM orders)
        SELECT 'public.orders' AS entity,
          CASE WHEN message = 'insert' THEN 'Insert' WHEN message LIKE '%update' THEN 'Update' ELSE 'Delete' END AS change_type,
          o_orderdate AS source_ts, o_orderkey::VARCHAR AS order_key,
          CASE WHEN message = 'full_delete' THEN 'N' WHEN message <> 'key_delete' THEN o_orderstatus END AS status,
          CASE WHEN message NOT LIKE '%delete' THEN nullif(o_orderpriority, '5-LOW') END AS priority,
          CASE WHEN message IN ('full_update', 'index_update') THEN o_orderkey::VARCHAR END AS prev_key,
          CASE WHEN message = 'full_update' THEN 'N' END AS prev_status
        FROM m WHERE message <> 'begin'""",
    "debezium_decode": """SELECT 'pg-' || lower(o_orderstatus) AS driver_id, 'postgresql' AS source_type,
          CASE o_orderstatus WHEN 'O' THEN 'ctx:open' WHEN 'P' THEN 'ctx:pending' END AS context,
          CASE WHEN o_orderpriority = '2-HIGH' THEN 'public.orders' ELSE 'sales.orders' END AS entity,
          CASE WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderpriority = '5-LOW' THEN 'Snapshot' ELSE 'Insert' END
               WHEN o_orderstatus = 'P' THEN 'Update' ELSE 'Delete' END AS change_type,
          strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS source_ts,
          CASE WHEN o_orderstatus <> 'F' THEN o_orderkey::VARCHAR END AS order_key,
          CASE WHEN o_orderstatus <> 'O' THEN o_orderkey::VARCHAR END AS prev_key,
          CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority,
          CASE WHEN o_orderstatus <> 'O' THEN '?' END AS prev_priority,
          CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'true' ELSE 'false' END AS snapshot,
          '2.7.0' AS version FROM orders""",
    "discover_tables": """SELECT lower(o_orderpriority) || '.t' || o_orderkey AS entity FROM orders
        WHERE o_orderpriority NOT IN ('5-LOW', '2-HIGH')""",
    "discover_keys": """SELECT lower(o_orderpriority) || '.t' || o_orderkey AS entity,
        string_agg('col_' || l_linenumber, ',' ORDER BY l_linenumber) AS key_columns
        FROM orders JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) ON l_orderkey = o_orderkey
        WHERE o_totalprice > 100000 AND o_orderstatus <> 'P' GROUP BY o_orderpriority, o_orderkey""",
}
