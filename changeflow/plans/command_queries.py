"""Registered queries: write commands and echo suppression."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from changeflow.functions.maps import merge_attributes
from changeflow.operators import routing, writeback
from changeflow.plans.reverse import command_columns
from changeflow.plans.tables import read
from changeflow.spec import Target

KEY, ORDER = ["c_custkey"], ["ts", "correlation_id"]

TARGETS = (
    Target("af-1", "historian", ("cmd.element.>", "cmd.*.create")),
    Target("af-2", "historian", ("cmd.element.*",)),
    Target("pg-1", "postgres", ("cmd.>",)),
    Target("off", "postgres", ("cmd.>",), enabled=False),
    Target("read-only", "neo4j", ("cmd.>",), writable=False),
)


def envelopes(spark, sf):
    """``events`` as command envelopes: signup creates, error deletes, the rest updates users."""
    events = read(spark, sf, "events")
    kind = (
        F.when(F.col("event_type") == "signup", "Create").when(F.col("event_type") == "error", "DELETE")
        .when(F.col("event_type") == "view", "Heartbeat").when(F.col("event_type") == "click", "snapshot").otherwise("Update")
    )
    entity = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("element/a/"), "user_id"))
        .when(F.col("event_type") == "error", F.concat(F.lit("/x"), "user_id")).otherwise("element")
    )
    meta = F.create_map(
        F.lit("targetDriverId"), F.when(F.col("event_type") == "click", "AF-1").otherwise(" "),
        F.lit("targetSourceType"), F.when(F.col("event_type") == "purchase", "Postgres"),
        F.lit("originDriverId"), F.when(F.col("event_type") == "error", "pg-1"),
    )
    return events.select(
        F.concat(F.lit("c"), "event_id").alias("event_id"), "ts", kind.alias("change_type"), entity.alias("entity"),
        F.when(F.col("event_type") == "signup", F.create_map(F.lit("name"), F.concat(F.lit("u"), "user_id")))
        .otherwise(F.create_map(F.lit("id"), F.col("user_id").cast("string"))).alias("pk"),
        F.create_map(F.lit("value"), F.col("value").cast("string")).alias("fields"), meta.alias("meta"),
        F.concat(F.lit("cmd.element."), F.lower(kind)).alias("subject"),
    )


def decode_commands(spark, sf):
    out = writeback.decode_commands(envelopes(spark, sf))
    get = lambda k: F.try_element_at("pk", F.lit(k))
    return out.select("correlation_id", "operation", "entity_type", get("name").alias("name"), get("id").alias("id"))


def route_commands(spark, sf):
    out = writeback.route_commands(writeback.decode_commands(envelopes(spark, sf)), TARGETS)
    return out.select("correlation_id", "operation", "driver_id", "source_type")


def route_per_pattern(spark, sf):
    cmds = writeback.decode_commands(envelopes(spark, sf))
    out = writeback.route_commands(cmds, TARGETS, per_pattern=True, skip_origin=True)
    return out.groupBy("driver_id", "operation").agg(F.count(F.lit(1)).alias("deliveries"))


def event_commands(spark, sf):
    """Commands on customers: a field map with explicit names, cleared values included."""
    events = read(spark, sf, "events")
    op = F.when(F.col("event_type") == "signup", "Create").when(F.col("event_type") == "error", "Delete").otherwise("Update")
    fields = (
        F.when(F.col("event_type") == "click", F.create_map(F.lit("c_mktsegment"), F.col("props")))
        .when(F.col("event_type") == "view", F.create_map(F.lit("c_name"), F.lit(None).cast("string"), F.lit("unknown"), F.lit("1")))
        .otherwise(F.create_map(F.lit("c_acctbal"), F.col("value").cast("string")))
    )
    cmds = events.select(
        F.concat(F.lit("c"), "event_id").alias("correlation_id"), "ts", op.alias("operation"),
        F.create_map(F.lit("c_custkey"), F.col("user_id").cast("string")).alias("pk"), fields.alias("fields"),
        F.when(F.col("value") > 110, "pump").otherwise("Element").alias("entity_type"),
    )
    return command_columns(cmds, {"c_custkey": "bigint"}, {"c_acctbal": "double", "c_mktsegment": "string", "c_name": "string"})


def customers(spark, sf):
    """All customers; those without a positive balance have keys that no command names."""
    key = F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).otherwise(F.col("c_custkey") + 100_000_000)
    return read(spark, sf, "customer").select(key.alias("c_custkey"), "c_name", "c_acctbal", "c_mktsegment")


def apply_commands(spark, sf):
    return writeback.apply_commands(customers(spark, sf), event_commands(spark, sf), KEY, ORDER, types=("element",))[0]


def command_results(spark, sf):
    return writeback.apply_commands(customers(spark, sf), event_commands(spark, sf), KEY, ORDER, types=("element",))[1]


def apply_commands_split(spark, sf):
    """The same with every key treated as too large for one task."""
    return writeback.apply_commands(customers(spark, sf), event_commands(spark, sf), KEY, ORDER, types=("element",), hot_rows=0)[0]


def _renames(spark, sf):
    """Each user's first purchase renames the row; views address the new key, all else the old one."""
    events = read(spark, sf, "events")
    first = events.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min(F.struct("ts", "event_id"))["event_id"].alias("first_id"))
    fresh = -1 - F.col("user_id")
    cmds = events.join(first.withColumnRenamed("user_id", "u"), F.col("user_id") == F.col("u"), "left").select(
        F.concat(F.lit("c"), "event_id").alias("correlation_id"), "ts", F.lit("Update").alias("operation"),
        F.when(F.col("event_type") == "view", fresh).otherwise(F.col("user_id")).alias("c_custkey"),
        F.when(F.col("event_id") == F.col("first_id"), fresh).alias("new_key"),
        F.col("value").alias("c_acctbal"), F.lit(None).cast("string").alias("c_name"),
        F.when(F.col("event_type") == "purchase", F.col("props")).alias("c_mktsegment"),
    )
    return writeback.apply_with_renames(customers(spark, sf), cmds, "c_custkey", ORDER)


def rename_commands(spark, sf):
    return _renames(spark, sf)[0]


def rename_results(spark, sf):
    return _renames(spark, sf)[1]


def rename_alternating(spark, sf):
    """Every event renames its user's row from one of two names to the other: as many renames on one key as the user has events."""
    events = read(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    turn = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) % 2
    name = lambda n: F.concat(F.lit("u"), "user_id", F.when(n, "a").otherwise("b"))
    cmds = events.select(
        F.col("event_id").alias("correlation_id"), F.lit("Update").alias("operation"), name(turn == 1).alias("name"), name(turn == 0).alias("new_key"), "ts",
        F.col("value").alias("last_value"), F.lit(None).cast("string").alias("origin"),
    )
    users = events.select("user_id").distinct().select(name(F.lit(True)).alias("name"), F.lit(0.0).alias("last_value"), F.col("user_id").cast("string").alias("origin"))
    return writeback.apply_with_renames(users, cmds, "name", ["ts", "correlation_id"])[0]


def command_targets(spark, sf):
    talks = read(spark, sf, "conversations")
    cmds = talks.select(
        "conv_id", "turn",
        F.create_map(F.lit("name"), F.when(F.col("turn") > 0, F.col("role")).otherwise(""),
                     F.lit("elementPath"), F.when(F.col("turn") == 1, "\\\\db\\x"),
                     F.lit("elementName"), F.when(F.col("turn") < 3, F.concat(F.lit("e"), "conv_id"))).alias("pk"),
        F.create_map(F.lit("name"), F.when(F.col("role") == "user", "n"),
                     F.lit("element"), F.when(F.col("role") == "assistant", "path")).alias("fields"),
    )
    return writeback.resolve_target(cmds).select("conv_id", "turn", "name", "target", "error")


def element_attributes(spark, sf):
    part = read(spark, sf, "part").select(
        "p_partkey",
        F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type")).alias("base"),
        F.create_map(F.lit("type"), F.when(F.col("p_size") > 10, F.lower("p_name")), F.lit("new"), F.lit("x")).alias("patch"),
    )
    out = part.withColumn("merged", merge_attributes("base", "patch", add_missing=False))
    get = lambda k: F.try_element_at("merged", F.lit(k))
    return out.select("p_partkey", get("brand").alias("brand"), get("type").alias("type"), F.size("merged").alias("n"))


def template_attributes(spark, sf):
    spec = lambda t, d, u, c: F.struct(
        t.cast("string").alias("type"), d.cast("string").alias("defaultValue"), u.cast("string").alias("uom"), c.cast("boolean").alias("isConfig")
    )
    none = F.lit(None)
    part = read(spark, sf, "part").select(
        "p_partkey",
        F.create_map(F.lit("size"), spec(F.lit("Int32"), F.col("p_size"), F.lit("cm"), F.lit(True))).alias("base"),
        F.create_map(F.lit("size"), spec(none, F.col("p_retailprice"), none, F.lit(False)),
                     F.col("p_brand"), spec(F.lit("String"), F.col("p_type"), none, none)).alias("patch"),
    )
    merged = part.select("p_partkey", F.explode(merge_attributes("base", "patch", add_missing=True)).alias("name", "v"))
    return merged.select("p_partkey", "name", "v.type", F.col("v.defaultValue").alias("default_value"), "v.uom", F.col("v.isConfig").alias("is_config"))


def point_attributes(spark, sf):
    part = read(spark, sf, "part")
    fields = F.create_map(
        F.lit("descriptor"), F.when(F.col("p_size") > 5, F.col("p_name")).otherwise(""),
        F.lit("engineeringUnits"), F.when(F.col("p_size") > 20, "bar"),
        F.lit("pointType"), F.when(F.col("p_size") > 30, "Int32").when(F.col("p_size") > 15, ""),
    )
    extra = F.when(F.col("p_size") > 40, F.create_map(F.lit("descriptor"), F.col("p_brand"), F.lit("zero"), F.lit("0"), F.lit("span"), F.lit("")))
    out = part.select("p_partkey", fields.alias("f"), extra.alias("x"), F.explode(F.array(F.lit(True), F.lit(False))).alias("on_create"))
    out = out.withColumn(
        "a", F.when(F.col("on_create"), writeback.map_point_attributes("f", "x", True)).otherwise(writeback.map_point_attributes("f", "x", False))
    )
    get = lambda k: F.try_element_at("a", F.lit(k))
    return out.select("p_partkey", "on_create", *[get(k).alias(k) for k in ("descriptor", "engunits", "pointtype", "pointclass", "zero", "span")])


def echo_suppression(spark, sf):
    events = read(spark, sf, "events")
    changes = events.select("event_id", "ts", F.when(F.col("event_type") != "view", F.col("user_id")).alias("replica_session"))
    sessions = events.filter("event_type = 'signup' and value > 40").select(F.col("user_id").alias("replica_session"))
    return writeback.suppress_echo(changes, sessions, ["ts", "event_id"])


def route_by_table(spark, sf):
    """Commands of all customers and events against thousands of subscriptions that suppliers and parts hold."""
    events = read(spark, sf, "events")
    subject = F.concat_ws(".", F.lit("cmd"), F.concat(F.lit("u"), F.col("user_id") % 200), "event_type", F.concat(F.lit("v"), F.floor("value").cast("int") % 10))
    target = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("D"), F.col("event_id") % 40))
    commands = events.select("event_id", subject.alias("subject"), F.when(target.isNotNull(), F.create_map(F.lit("targetDriverId"), target)).alias("meta"))
    return routing.route_by_table(commands, subscriptions(spark, sf)).select("event_id", "subject", "driver_id", "source_type")


def subscriptions(spark, sf):
    """Five patterns per part: whole subjects, ``*`` inside, ``>`` at the end, and some that match nothing."""
    part = read(spark, sf, "part").select(F.col("p_partkey").alias("k"))
    kinds = F.element_at(F.array(*map(F.lit, ("click", "view", "purchase", "signup", "error"))), (F.col("k") % 5 + 1).cast("int"))
    user, value = F.concat(F.lit("u"), F.col("k") % 200), F.concat(F.lit("v"), F.col("k") % 10)
    forms = [
        F.concat_ws(".", F.lit("cmd"), user, kinds, value), F.concat_ws(".", F.lit("cmd"), user, F.lit("*"), value), F.concat_ws(".", F.lit("cmd"), user, F.lit(">")),
        F.concat_ws(".", F.lit("*"), user, kinds, F.lit("*")), F.concat_ws(".", F.lit("cmd"), user, kinds),
    ]
    rows = part.select("k", F.posexplode(F.array(*forms)).alias("n", "pattern")).filter("(k + n) % 3 > 0 or n = 0")
    return rows.select(F.concat(F.lit("d"), F.col("k") % 40).alias("driver_id"), F.lit("pg").alias("source_type"), "pattern")


QUERIES = {
    f.__name__: f
    for f in (
        decode_commands, route_commands, route_per_pattern, route_by_table, apply_commands, command_results, apply_commands_split,
        rename_commands, rename_results, rename_alternating, command_targets, element_attributes, template_attributes, point_attributes, echo_suppression,
    )
}

_CMDS = """d AS (SELECT *, 'c' || event_id AS correlation_id,
    CASE event_type WHEN 'signup' THEN 'Create' WHEN 'error' THEN 'Delete' ELSE 'Update' END AS operation,
    CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' WHEN 'click' THEN 'snapshot' ELSE 'update' END AS tail
    FROM events WHERE event_type <> 'view')"""
_ROUTES = f"""{_CMDS}, r AS (
    SELECT *, 'af-1' AS driver_id, 'historian' AS source_type, 1 + (tail = 'create')::INT AS hits FROM d WHERE event_type <> 'purchase'
    UNION ALL SELECT *, 'af-2', 'historian', 1 FROM d WHERE event_type NOT IN ('purchase', 'click')
    UNION ALL SELECT *, 'pg-1', 'postgres', 1 FROM d WHERE event_type <> 'click')"""
# Whether a key exists before a command, then its outcome and its segment.
_APPLY = """c AS (SELECT *, 'c' || event_id AS correlation_id, value <= 110 AS valid,
    CASE event_type WHEN 'signup' THEN 'Create' WHEN 'error' THEN 'Delete' ELSE 'Update' END AS op FROM events),
  t AS (SELECT c_custkey + CASE WHEN c_acctbal > 0 THEN 0 ELSE 100000000 END AS c_custkey, c_name, c_acctbal, c_mktsegment FROM customer),
  e AS (SELECT c.*, coalesce(last_value(CASE WHEN valid AND op = 'Create' THEN true WHEN valid AND op = 'Delete' THEN false END IGNORE NULLS)
      OVER (PARTITION BY user_id ORDER BY ts, correlation_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), t.c_custkey IS NOT NULL) AS here
    FROM c LEFT JOIN t ON user_id = c_custkey),
  p AS (SELECT *, CASE WHEN NOT valid THEN 'unsupported entity type pump' WHEN op = 'Create' AND here THEN 'already exists'
      WHEN op = 'Update' AND NOT here THEN 'not found' END AS message FROM e)"""
_FINAL = f"""WITH {_APPLY}, s AS (
    SELECT *, sum((op <> 'Update')::INT) OVER (PARTITION BY user_id ORDER BY ts, correlation_id) AS seg FROM p WHERE message IS NULL),
  g AS (SELECT user_id, max(seg) AS seg, arg_max(op, (ts, correlation_id)) FILTER (op <> 'Update') AS last_op FROM s GROUP BY user_id),
  l AS (SELECT s.user_id, any_value(g.seg) AS seg, any_value(last_op) AS last_op,
      arg_max(value, (ts, correlation_id)) FILTER (event_type IN ('signup', 'purchase')) AS bal,
      arg_max(props, (ts, correlation_id)) FILTER (event_type = 'click') AS segm,
      count(*) FILTER (event_type = 'view') AS cleared
    FROM s JOIN g ON s.user_id = g.user_id AND s.seg = g.seg GROUP BY s.user_id)
  SELECT coalesce(c_custkey, user_id) AS c_custkey,
    CASE WHEN user_id IS NULL OR (l.seg = 0 AND cleared = 0) THEN c_name END AS c_name,
    CASE WHEN bal IS NOT NULL THEN bal WHEN coalesce(l.seg, 0) = 0 THEN c_acctbal END AS c_acctbal,
    CASE WHEN segm IS NOT NULL THEN segm WHEN coalesce(l.seg, 0) = 0 THEN c_mktsegment END AS c_mktsegment
  FROM t FULL JOIN l ON c_custkey = user_id
  WHERE CASE WHEN last_op IS NOT NULL THEN last_op = 'Create' ELSE c_custkey IS NOT NULL END"""

_RENAMES = """t AS (SELECT c_custkey + CASE WHEN c_acctbal > 0 THEN 0 ELSE 100000000 END AS c_custkey, c_name, c_acctbal, c_mktsegment FROM customer),
  f AS (SELECT user_id AS u, min((ts, event_id)) AS first_at FROM events WHERE event_type = 'purchase' GROUP BY 1),
  c AS (SELECT e.*, c_custkey IS NOT NULL AS known, coalesce((ts, event_id) > first_at, false) AS moved, coalesce((ts, event_id) = first_at, false) AS move
    FROM events e LEFT JOIN f ON u = user_id LEFT JOIN t ON c_custkey = user_id),
  r AS (SELECT *, known AND CASE WHEN event_type = 'view' THEN moved ELSE NOT moved END AS success FROM c)"""

ORACLE = {
    "rename_alternating": """SELECT 'u' || user_id || CASE WHEN count(*) % 2 = 0 THEN 'a' ELSE 'b' END AS name,
        arg_max(value, (ts, event_id)) AS last_value, user_id::VARCHAR AS origin FROM events GROUP BY user_id""",
    "route_by_table": r"""WITH p AS (SELECT p_partkey AS k, ['click', 'view', 'purchase', 'signup', 'error'][p_partkey % 5 + 1] AS kind, 'u' || p_partkey % 200 AS u, 'v' || p_partkey % 10 AS v FROM part),
        forms AS (SELECT k, unnest(['cmd.' || u || '.' || kind || '.' || v, 'cmd.' || u || '.*.' || v, 'cmd.' || u || '.>', '*.' || u || '.' || kind || '.*', 'cmd.' || u || '.' || kind]) AS pattern,
          unnest([0, 1, 2, 3, 4]) AS n FROM p),
        subs AS (SELECT DISTINCT 'd' || k % 40 AS driver_id, pattern, '^' || replace(replace(replace(pattern, '.', '\.'), '*', '[^.]+'), '>', '.+') || '$' AS re FROM forms WHERE (k + n) % 3 > 0 OR n = 0),
        c AS (SELECT event_id, 'cmd.u' || user_id % 200 || '.' || event_type || '.v' || floor(value)::INT % 10 AS subject, CASE WHEN event_id % 11 = 0 THEN 'd' || event_id % 40 END AS target FROM events),
        hits AS (SELECT DISTINCT s.subject, driver_id FROM (SELECT DISTINCT subject FROM c) s JOIN subs ON regexp_matches(s.subject, re))
        SELECT event_id, subject, driver_id, 'pg' AS source_type FROM c JOIN hits USING (subject) WHERE target IS NULL OR target = driver_id""",
    "rename_commands": f"""WITH {_RENAMES}, l AS (SELECT user_id, max((move AND success)::INT) AS gone, arg_max(value, (ts, event_id)) FILTER (success) AS bal,
          arg_max(props, (ts, event_id)) FILTER (success AND event_type = 'purchase') AS segm FROM r GROUP BY 1)
        SELECT CASE WHEN gone = 1 THEN -1 - c_custkey ELSE c_custkey END AS c_custkey, c_name, coalesce(bal, c_acctbal) AS c_acctbal,
          coalesce(segm, c_mktsegment) AS c_mktsegment FROM t LEFT JOIN l ON c_custkey = user_id""",
    "rename_results": f"""WITH {_RENAMES} SELECT 'c' || event_id AS correlation_id, 'Update' AS operation,
        CASE WHEN event_type = 'view' THEN -1 - user_id ELSE user_id END AS c_custkey, CASE WHEN move THEN -1 - user_id END AS new_key,
        success, CASE WHEN NOT success THEN 'not found' END AS error_message FROM r""",
    "decode_commands": f"""WITH {_CMDS} SELECT correlation_id, operation,
        CASE event_type WHEN 'error' THEN '/x' || user_id ELSE 'element' END AS entity_type,
        CASE event_type WHEN 'signup' THEN 'u' || user_id WHEN 'click' THEN 'a/' || user_id WHEN 'error' THEN '/x' || user_id ELSE 'element' END AS name,
        CASE WHEN event_type <> 'signup' THEN user_id::VARCHAR END AS id FROM d""",
    "route_commands": f"WITH {_ROUTES} SELECT correlation_id, operation, driver_id, source_type FROM r",
    "route_per_pattern": f"""WITH {_ROUTES} SELECT driver_id, operation, sum(hits)::BIGINT AS deliveries FROM r
        WHERE NOT (driver_id = 'pg-1' AND event_type = 'error') GROUP BY 1, 2""",
    "apply_commands": _FINAL,
    "command_results": f"""WITH {_APPLY} SELECT correlation_id, op AS operation, user_id AS c_custkey, message IS NULL AS success,
        message AS error_message FROM p""",
    "apply_commands_split": _FINAL,
    "command_targets": """SELECT conv_id, turn, n AS name, t AS target,
        CASE WHEN n IS NULL THEN 'command has no name' WHEN t IS NULL THEN 'target element not found' END AS error FROM (
          SELECT conv_id, turn, CASE WHEN turn > 0 THEN role WHEN role = 'user' THEN 'n' END AS n,
            CASE WHEN turn = 1 THEN '\\\\db\\x' WHEN turn < 3 THEN 'e' || conv_id WHEN role = 'assistant' THEN 'path' END AS t FROM conversations)""",
    "element_attributes": """SELECT p_partkey, p_brand AS brand, CASE WHEN p_size > 10 THEN lower(p_name) END AS type, 2 AS n FROM part""",
    "template_attributes": """SELECT p_partkey, 'size' AS name, 'Int32' AS type, p_retailprice::VARCHAR AS default_value, 'cm' AS uom, false AS is_config FROM part
        UNION ALL SELECT p_partkey, p_brand, 'String', p_type, NULL, NULL FROM part""",
    "point_attributes": """SELECT p_partkey, on_create,
        CASE WHEN p_size > 40 THEN p_brand WHEN p_size > 5 THEN p_name WHEN NOT on_create THEN '' END AS descriptor,
        CASE WHEN p_size > 20 THEN 'bar' END AS engunits,
        CASE WHEN p_size > 30 THEN 'Int32' WHEN p_size > 15 THEN NULL WHEN on_create THEN 'Float32' END AS pointtype,
        CASE WHEN on_create THEN 'classic' END AS pointclass,
        CASE WHEN p_size > 40 THEN '0' END AS zero, CASE WHEN p_size > 40 AND NOT on_create THEN '' END AS span
        FROM part, (VALUES (true), (false)) v(on_create)""",
    "echo_suppression": """WITH c AS (SELECT event_id, ts, CASE WHEN event_type <> 'view' THEN user_id END AS replica_session FROM events),
        f AS (SELECT arg_min(event_id, (ts, event_id)) AS event_id FROM c WHERE replica_session IN
          (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 40) GROUP BY replica_session)
        SELECT * FROM c WHERE event_id NOT IN (SELECT event_id FROM f)""",
}
