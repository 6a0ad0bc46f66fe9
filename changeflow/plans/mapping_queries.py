"""Registered queries: rule mapping, casts, concepts, metadata, request checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.functions.maps import merge_metadata
from changeflow.functions.values import type_json_fields
from changeflow.operators import mapping
from changeflow.operators.changes import with_history
from changeflow.plans.change_queries import HISTORY_SQL, event_changes, event_order
from changeflow.plans.tables import read
from changeflow.sources.scan import raw_changes
from changeflow.spec import Rule

CONCEPTS = {"click": "pid:Click", "purchase": "pid:Purchase", "ERROR": "pid:Error"}


def field_mapping(spark, sf):
    rules = [
        Rule("C_CUSTKEY", target="id", type="string", is_key=True),
        Rule("c_name", target="customerName"),
        Rule("c_nationkey", exclude=True),
        Rule("c_mktsegment", target="segment", concepts={"BUILDING": "seg:Building", "MACHINERY": "seg:Machinery"}),
        Rule("origin", static="crm"),
        Rule("c_acctbal", static="0"),
    ]
    raw = raw_changes(read(spark, sf, "customer"), "public.customer")
    return mapping.apply_mapping(raw, rules, ["c_custkey"]).select("pk.*", "fields.*")


def key_routing(spark, sf):
    """A key column with a rule but no key flag goes to the fields; one without a rule to the key."""
    raw = raw_changes(read(spark, sf, "conversations"), "public.talks")
    out = mapping.apply_mapping(raw, [Rule("turn", target="turn_no"), Rule("text", exclude=True)], ["CONV_ID", "turn"])
    return out.select(F.col("pk.conv_id").alias("key_conv_id"), F.col("fields.turn_no").alias("turn_no"), F.col("fields.role").alias("role"))


_CASTS = [
    Rule("p_size", type="string"),
    Rule("p_retailprice", target="price", type="int"),
    Rule("p_name", type="double"),
    Rule("p_type", type="bool"),
    Rule("p_brand", type="date"),
    Rule("p_partkey", type="number"),
]


def cast_or_keep(spark, sf):
    return mapping.apply_mapping(raw_changes(read(spark, sf, "part"), "public.part"), _CASTS).select("fields.*")


def cast_as_text(spark, sf):
    raw = raw_changes(read(spark, sf, "part"), "public.part")
    return mapping.apply_mapping(raw, _CASTS, failed_casts="text").select("fields.*")


def concept_map(spark, sf):
    rules = [Rule("event_type", concepts=CONCEPTS), Rule("user_id", target="user", type="string", concepts={"7": "pid:Seven"})]
    return mapping.apply_mapping(event_changes(spark, sf), rules).select("fields.event_id", "fields.event_type", "fields.user")


def concept_table(spark, sf):
    value = F.when(F.col("n_nationkey") == 3, "x3").otherwise(F.col("n_nationkey").cast("string"))
    nations = read(spark, sf, "nation").select(value.alias("value"), F.concat(F.lit("geo:"), "n_name").alias("concept"))
    customers = read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return mapping.map_concepts(customers, "c_nationkey", nations, "nation")


def previous_mapping(spark, sf):
    rules = [Rule("event_type", target="kind", concepts=CONCEPTS), Rule("props", exclude=True), Rule("event_id", is_key=True),
             Rule("channel", static="web")]
    raw = with_history(event_changes(spark, sf), ["user_id"], event_order())
    out = mapping.apply_mapping(raw, rules, ["user_id"])
    names = ",".join(out.schema["prev"].dataType.names)
    return out.select(
        "pk.event_id", F.col("fields.kind").alias("kind"), F.col("fields.channel").alias("channel"),
        F.col("prev.kind").alias("prev_kind"), F.col("prev.value").alias("prev_value"), F.lit(names).alias("prev_names"),
    )


def json_typing(spark, sf):
    """Customers as JSON objects, and the kind and text of every property."""
    customers = read(spark, sf, "customer")
    value = F.to_json(
        F.struct(
            F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
            (F.col("c_acctbal") > 0).alias("solvent"), F.lit(None).cast("string").alias("note"),
            F.struct(F.col("c_nationkey").alias("nation")).alias("home"), F.array("c_nationkey").alias("list"),
        ),
        {"ignoreNullFields": "false"},
    )
    props = customers.select("c_custkey", F.explode(type_json_fields(value)).alias("name", "v"))
    return props.select(
        "c_custkey", "name", "v.kind", F.when(F.col("v.kind") != "double", F.col("v.text")).alias("text"),
        F.when(F.col("v.kind") == "double", F.col("v.text").cast("double")).alias("number"),
    )


def metadata_merge(spark, sf):
    events = read(spark, sf, "events").withColumn(
        "meta", F.when(F.col("event_type") != "view", F.create_map(F.lit("Source"), F.col("event_type"), F.lit("k"), F.col("props")))
    )
    out = events.withColumn("meta", merge_metadata("meta", {"source": "web", "x": "1"}))
    get = lambda k: F.try_element_at("meta", F.lit(k))
    return out.select(
        "event_id", get("Source").alias("upper"), get("source").alias("lower"), get("k").alias("k"), get("x").alias("x"),
        F.size("meta").alias("entries"),
    )


def scoped_mapping(spark, sf):
    raw = raw_changes(read(spark, sf, "orders"), "public.orders").withColumn("driver_id", F.col("row.o_orderpriority"))
    scopes = {
        "*": [Rule("o_orderdate", exclude=True), Rule("o_orderstatus", target="status")],
        "1-URGENT": [Rule("o_orderstatus", target="status", concepts={"O": "open"}), Rule("o_custkey", exclude=True)],
        "5-LOW": [Rule("o_totalprice", target="price")],
    }
    out = mapping.apply_scoped_mapping(raw, scopes, ["o_orderkey"])
    fields = "status string, o_custkey bigint, price double, o_totalprice double, o_orderdate string"
    out = out.select(F.from_json("pk", "o_orderkey bigint").alias("p"), F.from_json("fields", fields).alias("f"))
    return out.select("p.o_orderkey", "f.*")


def request_checks(spark, sf):
    talks = read(spark, sf, "conversations")
    requests = talks.select(
        "conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("requestId"),
        F.when(F.col("turn") > 0, F.col("role")).otherwise("  ").alias("driverId"),
        F.lit("postgres").alias("sourceType"), F.nullif("role", F.lit("user")).alias("entityPath"),
        F.when(F.col("turn") == 0, "Insert").when(F.col("turn") == 1, "upsert").when(F.col("turn") == 2, "Snapshot").alias("changeType"),
        F.lit("2026-05-13T10:00:00Z").alias("detectedAt"), F.create_map(F.lit("id"), F.col("conv_id")).alias("primaryKey"),
        F.when(F.col("role") != "system", F.create_map(F.lit("t"), F.col("text"))).alias("fields"),
    )
    good, bad = mapping.split_valid(mapping.check_request(requests))
    return good.unionByName(bad).select("conv_id", "turn", F.concat_ws("; ", "errors").alias("errors"))


def concept_resolvers(spark, sf):
    raw = event_changes(spark, sf).select("entity", "row.*")
    out = mapping.resolve_concepts(
        raw,
        [
            ("public.events", "event_type = 'purchase' and value > 100", "pid:BigSale", "ctx:sales"),
            ("public.events", "event_type = 'purchase'", "pid:Sale", "ctx:sales"),
            ("public.other", "true", "pid:Other", "ctx:other"),
            ("public.events", "event_type like 'c%'", "pid:Click", "ctx:web"),
        ],
        {"asset": "asset:{user_id}/{event_type}"},
        "1.4.0",
    )
    return out.select("event_id", "concept", "context", "asset", "ontology_version", F.concat_ws(";", "errors").alias("errors"))


QUERIES = {
    f.__name__: f
    for f in (
        field_mapping, key_routing, cast_or_keep, cast_as_text, concept_map, concept_table, previous_mapping, json_typing,
        metadata_merge, scoped_mapping, request_checks, concept_resolvers,
    )
}

_CONCEPT = "CASE {0} WHEN 'click' THEN 'pid:Click' WHEN 'purchase' THEN 'pid:Purchase' ELSE {0} END"
_PRICE = "p_retailprice = floor(p_retailprice)"

ORACLE = {
    "field_mapping": """SELECT c_custkey::VARCHAR AS id, c_name AS customerName, c_acctbal, 'crm' AS origin,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'seg:Building' WHEN 'MACHINERY' THEN 'seg:Machinery' ELSE c_mktsegment END AS segment
        FROM customer""",
    "key_routing": "SELECT conv_id AS key_conv_id, turn AS turn_no, role FROM conversations",
    "cast_or_keep": f"""SELECT p_partkey, p_size::VARCHAR AS p_size, CASE WHEN {_PRICE} THEN p_retailprice::INT END AS price,
        CASE WHEN NOT {_PRICE} THEN p_retailprice::VARCHAR END AS price__raw, NULL::DOUBLE AS p_name, p_name AS p_name__raw,
        NULL::BOOLEAN AS p_type, p_type AS p_type__raw, NULL::DATE AS p_brand, p_brand AS p_brand__raw FROM part""",
    "cast_as_text": f"""SELECT p_partkey, p_size::VARCHAR AS p_size,
        CASE WHEN {_PRICE} THEN p_retailprice::INT::VARCHAR ELSE p_retailprice::VARCHAR END AS price, p_name, p_type, p_brand FROM part""",
    "concept_map": f"""SELECT event_id, {_CONCEPT.format("event_type")} AS event_type,
        CASE user_id WHEN 7 THEN 'pid:Seven' ELSE user_id::VARCHAR END AS "user" FROM events""",
    "concept_table": """SELECT c_custkey, c_nationkey, CASE WHEN n_nationkey <> 3 THEN 'geo:' || n_name ELSE c_nationkey::VARCHAR END AS nation
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "previous_mapping": f"""WITH {HISTORY_SQL.format(source="events")}
        SELECT event_id, {_CONCEPT.format("event_type")} AS kind, 'web' AS channel,
        CASE WHEN has_prev THEN {_CONCEPT.format("p_type")} END AS prev_kind, CASE WHEN has_prev THEN p_value END AS prev_value,
        'ts,kind,value' AS prev_names FROM h""",
    "json_typing": """SELECT c_custkey, 'key' AS name, 'long' AS kind, c_custkey::VARCHAR AS text, NULL::DOUBLE AS number FROM customer
        UNION ALL SELECT c_custkey, 'name', 'string', c_name, NULL FROM customer
        UNION ALL SELECT c_custkey, 'balance', 'double', NULL, c_acctbal FROM customer
        UNION ALL SELECT c_custkey, 'solvent', 'bool', (c_acctbal > 0)::VARCHAR, NULL FROM customer
        UNION ALL SELECT c_custkey, 'note', 'null', NULL, NULL FROM customer
        UNION ALL SELECT c_custkey, 'home', 'json', '{"nation":' || c_nationkey || '}', NULL FROM customer
        UNION ALL SELECT c_custkey, 'list', 'json', '[' || c_nationkey || ']', NULL FROM customer""",
    "metadata_merge": """SELECT event_id, CASE WHEN event_type <> 'view' THEN 'web' END AS upper,
        CASE WHEN event_type = 'view' THEN 'web' END AS lower, CASE WHEN event_type <> 'view' THEN props END AS k, '1' AS x,
        CASE WHEN event_type = 'view' THEN 2 ELSE 3 END AS entries FROM events""",
    "scoped_mapping": """SELECT o_orderkey,
        CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'open' ELSE o_orderstatus END AS status,
        CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS o_custkey,
        CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END AS price,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS o_totalprice, NULL::VARCHAR AS o_orderdate FROM orders""",
    "request_checks": """SELECT conv_id, turn, concat_ws('; ', CASE WHEN turn = 0 THEN 'driverId is required' END,
        CASE WHEN role = 'user' THEN 'entityPath is required' END, CASE WHEN turn > 2 THEN 'changeType is required' END,
        CASE WHEN role = 'system' THEN 'fields is required' END,
        CASE WHEN turn = 1 THEN 'changeType must be one of: Insert, Update, Delete, Snapshot' END) AS errors FROM conversations""",
    "concept_resolvers": """SELECT event_id, CASE WHEN event_type = 'purchase' THEN CASE WHEN value > 100 THEN 'pid:BigSale' ELSE 'pid:Sale' END
          WHEN event_type LIKE 'c%' THEN 'pid:Click' END AS concept,
        CASE WHEN event_type = 'purchase' THEN 'ctx:sales' WHEN event_type LIKE 'c%' THEN 'ctx:web' END AS context,
        'asset:' || user_id || '/' || event_type AS asset, '1.4.0' AS ontology_version,
        CASE WHEN event_type = 'purchase' OR event_type LIKE 'c%' THEN '' ELSE 'concept is required' END AS errors FROM events""",
}
