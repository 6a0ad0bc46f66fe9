"""Registered queries: document changes, delta pages, samples and asset trees, built from the tables as JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.functions.values import document_fields, type_json_fields
from changeflow.plans.tables import read
from changeflow.sources import documents


def _document_feed(spark, sf):
    """``events`` as document change-stream records; views are another collection, each type an operation."""
    e = read(spark, sf, "events")
    kind = (
        F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "purchase", "replace")
        .when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "click", F.when(F.col("value") > 50, "update").otherwise("drop"))
        .otherwise("insert")
    )
    oid = F.struct(F.lpad(F.lower(F.hex("event_id")), 24, "0").alias("$oid"))
    document = F.struct(
        oid.alias("_id"), F.col("user_id").alias("user"),
        F.struct(F.col("value").cast("decimal(12,2)").cast("string").alias("$numberDecimal")).alias("amount"),
        F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("$date")).alias("seenAt"),
        F.struct(F.lit(True).alias("$undefined")).alias("gone"), F.struct(F.col("event_type").alias("t")).alias("nested"),
    )
    record = F.struct(
        F.struct(F.col("event_id").cast("string").alias("_data")).alias("_id"), kind.alias("operationType"),
        F.struct(F.when(F.col("event_type") == "view", "views").otherwise("actions").alias("coll")).alias("ns"),
        F.struct(F.struct(F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"), F.lit(1).alias("i")).alias("$timestamp")).alias("clusterTime"),
        F.when(kind != "delete", document).alias("fullDocument"),
        F.when(kind == "update", F.struct(F.lit(-1).alias("user"))).alias("fullDocumentBeforeChange"),
        F.struct(oid.alias("_id")).alias("documentKey"),
    )
    return e.select(F.to_json(record).alias("value"))


def document_changes(spark, sf):
    out = documents.decode_document_changes(_document_feed(spark, sf), ["actions"])
    out = out.withColumn("d", document_fields("row", {"_id": "text", "user": "text"}))
    return out.select(
        "entity", "change_type", F.date_format("source_ts", "yyyy-MM-dd HH:mm:ss").alias("source_ts"),
        F.try_element_at("meta", F.lit("resumeToken")).alias("token"), F.col("d._id").alias("id"),
        F.col("d.user").alias("user_id"), F.get_json_object("prev", "$.user").alias("prev_user"),
    )


def document_values(spark, sf):
    rows = documents.decode_document_changes(_document_feed(spark, sf)).filter("change_type <> 'Delete'")
    kinds = {"amount": "double", "seenAt": "date", "gone": "text", "nested": "text"}
    return rows.withColumn("d", document_fields("row", kinds)).select(
        F.try_element_at("meta", F.lit("resumeToken")).alias("token"), "entity", "d.amount",
        F.date_format("d.seenAt", "yyyy-MM-dd HH:mm:ss.SSS").alias("seen_at"), "d.gone", "d.nested",
    )


def _pages(spark, sf):
    """Delta pages of up to 50 consecutive orders per priority; finished orders are deleted items."""
    orders = read(spark, sf, "orders")
    item = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.struct(F.lit("deleted").alias("state"))).alias("deleted"),
    )
    pages = orders.groupBy(F.col("o_orderpriority").alias("entity"), F.floor(F.col("o_orderkey") / 50).alias("page_no")).agg(
        F.collect_list(item).alias("value")
    )
    page = F.struct(
        "value", F.when(F.col("page_no") % 3 == 0, F.concat(F.lit("delta-"), "page_no")).alias("@odata.deltaLink"),
        F.when(F.col("page_no") % 3 != 2, F.concat(F.lit("next-"), "page_no")).alias("@odata.nextLink"),
    )
    return pages.select("entity", "page_no", F.to_json(page).alias("value"))


def _items(decoded):
    props = F.col("props")
    get = lambda k: F.try_element_at(props, F.lit(k))["text"]
    return decoded.withColumn("props", type_json_fields("row")).select(
        "entity", "page_no", "change_type", get("id").cast("bigint").alias("id"), get("status").alias("status"), get("deleted").alias("deleted"),
        F.try_element_at("meta", F.lit("source")).alias("source"),
    )


def delta_pages(spark, sf):
    return _items(documents.decode_delta_pages(_pages(spark, sf)))


def delta_pages_updates(spark, sf):
    return _items(documents.decode_delta_pages(_pages(spark, sf), detect_deletes=False, source="sap"))


def page_cursors(spark, sf):
    pages = _pages(spark, sf)
    both = documents.page_cursors(pages).withColumn("links", F.lit("both"))
    return both.unionByName(documents.page_cursors(pages, next_links=False).withColumn("links", F.lit("delta")))


def _responses(spark, sf, items, time, sample):
    """Responses of up to 50 consecutive events per user: values as numbers, texts or objects by type."""
    e = read(spark, sf, "events")
    at = F.when(F.col("event_type") != "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    one = F.concat(
        F.lit('{"id":'), "event_id",
        F.when(at.isNotNull(), F.concat(F.lit(f',"{time}":"'), at, F.lit('"'))).otherwise(""),
        F.when(F.col("event_type") == "error", "").otherwise(F.concat(F.lit(f',"{sample}":'), F.when(F.col("event_type") == "click", F.col("props"))
                                                                      .when(F.col("event_type") == "signup", F.lit('"on"')).otherwise(F.col("value").cast("string")))),
        F.lit("}"),
    )
    return e.groupBy(F.concat(F.lit("sig-"), "user_id").alias("signal"), F.floor(F.col("event_id") / 50).alias("page")).agg(
        F.min(F.date_trunc("hour", "ts")).alias("since"), F.max("ts").alias("until"),
        F.concat(F.lit(f'{{"{items}":['), F.concat_ws(",", F.sort_array(F.collect_list(one))), F.lit("]}")).alias("value")
    )


def samples(spark, sf):
    out = documents.decode_samples(
        _responses(spark, sf, "samples", "key", "value"), "samples", "key", "value", F.col("since").cast("timestamp"), "seeq"
    )
    return out.select(
        "signal", F.date_format("source_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("source_ts"), "change_type",
        F.regexp_replace("sample_value", r"[ ]", "").alias("sample_value"),
    )


def sample_positions(spark, sf):
    """Next start per signal: newest sample, or the end of the requested window."""
    responses = _responses(spark, sf, "Items", "Timestamp", "Value")
    out = documents.decode_samples(responses, "Items", "Timestamp", "Value")
    newest = documents.sample_watermark(out).withColumn("rule", F.lit("newest"))
    window = documents.sample_watermark(responses, F.col("until").cast("timestamp")).withColumn("rule", F.lit("window"))
    return newest.unionByName(window).select("signal", "rule", F.date_format("since", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("since"))


def asset_changes(spark, sf):
    """Events as a tree's change log; customers, suppliers and parts are its elements, templates and attributes."""
    customers, suppliers, parts, events = (read(spark, sf, n) for n in ("customer", "supplier", "part", "events"))
    none = F.lit(None).cast("string")
    objects = (
        customers.select(F.col("c_custkey").alias("object_id"), F.lit("element").alias("object_type"), F.col("c_name").alias("name"),
                         F.concat(F.lit("\\\\AF\\db\\"), "c_name").alias("path"), none.alias("owner"))
        .unionByName(suppliers.select(F.col("s_suppkey").alias("object_id"), F.lit("elementTemplate").alias("object_type"),
                                      F.col("s_name").alias("name"), none.alias("path"), none.alias("owner")))
        .unionByName(parts.select(F.col("p_partkey").alias("object_id"), F.lit("attribute").alias("object_type"), F.col("p_name").alias("name"),
                                  none.alias("path"), F.when(F.col("p_size") > 5, F.col("p_brand")).alias("owner")))
    )
    kind = F.when(F.col("event_type").isin("click", "signup"), "element").when(F.col("event_type") == "view", "elementTemplate").otherwise("attribute")
    log = events.select(
        F.col("user_id").alias("object_id"), kind.alias("object_type"),
        F.when(F.col("value") < 20, "Added").when(F.col("value") < 60, "Updated").when(F.col("value") < 90, "Removed").otherwise("CheckedOut").alias("action"),
        F.col("ts").alias("change_ts"),
    )
    types = documents.watched_types(["ELEMENT", None, "elementTemplate", "attribute"])
    return documents.decode_asset_changes(log, objects, types).select("entity", "change_type", "source_ts", "unique_id", F.col("row.name").alias("name"))


def nest_attributes(spark, sf):
    """Orders as objects: one attribute per line number (the latest shipped), ship flags as categories."""
    orders, lines = read(spark, sf, "orders"), read(spark, sf, "lineitem")
    objects = orders.select(F.col("o_orderkey").alias("object_id"), "o_orderstatus")
    attributes = lines.select(
        F.col("l_orderkey").alias("object_id"), F.concat(F.lit("line"), "l_linenumber").alias("name"),
        F.concat_ws("/", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int")).alias("value"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity").alias("ordinal"),
    )
    categories = lines.select(F.col("l_orderkey").alias("object_id"), F.col("l_returnflag").alias("name"))
    out = documents.nest_attributes(objects, attributes, categories)
    shown = F.transform(F.map_entries("attributes"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.select("object_id", "o_orderstatus", F.concat_ws(",", shown).alias("attributes"), F.concat_ws(",", "categories").alias("categories"))


QUERIES = {
    f.__name__: f
    for f in (
        document_changes, document_values, delta_pages, delta_pages_updates, page_cursors, samples, sample_positions, asset_changes,
        nest_attributes,
    )
}

_OID = "lpad(lower(to_hex(event_id)), 24, '0')"
_PAGE = "o_orderkey // 50"
_ITEMS = """SELECT o_orderpriority AS entity, {page} AS page_no, {kind} AS change_type, o_orderkey AS id, o_orderstatus AS status,
        CASE WHEN o_orderstatus = 'F' THEN '{{"state":"deleted"}}' END AS deleted, '{source}' AS source FROM orders"""
_US = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"

ORACLE = {
    "document_changes": f"""SELECT 'actions' AS entity,
        CASE event_type WHEN 'signup' THEN 'Insert' WHEN 'error' THEN 'Delete' ELSE 'Update' END AS change_type,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS source_ts, event_id::VARCHAR AS token, {_OID} AS id,
        CASE WHEN event_type <> 'error' THEN user_id::VARCHAR END AS user_id, CASE WHEN event_type = 'click' THEN '-1' END AS prev_user
        FROM events WHERE event_type <> 'view' AND (event_type <> 'click' OR value > 50)""",
    "document_values": """SELECT event_id::VARCHAR AS token, CASE WHEN event_type = 'view' THEN 'views' ELSE 'actions' END AS entity,
        value AS amount, left(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 23) AS seen_at, NULL::VARCHAR AS gone, '{"t":"' || event_type || '"}' AS nested
        FROM events WHERE event_type <> 'error' AND (event_type <> 'click' OR value > 50)""",
    "delta_pages": _ITEMS.format(page=_PAGE, kind="CASE WHEN o_orderstatus = 'F' THEN 'Delete' ELSE 'Update' END", source="sharepoint"),
    "delta_pages_updates": _ITEMS.format(page=_PAGE, kind="'Update'", source="sap"),
    "page_cursors": f"""WITH p AS (SELECT DISTINCT o_orderpriority AS entity, {_PAGE} AS page_no FROM orders),
        l AS (SELECT entity, page_no, CASE WHEN page_no % 3 = 0 THEN 'delta-' || page_no END AS d,
            CASE WHEN page_no % 3 <> 2 THEN 'next-' || page_no END AS n FROM p)
        SELECT entity, arg_max(coalesce(d, n), page_no) FILTER (coalesce(d, n) IS NOT NULL) AS cursor, 'both' AS links FROM l GROUP BY entity
        UNION ALL SELECT entity, arg_max(d, page_no) FILTER (d IS NOT NULL), 'delta' FROM l GROUP BY entity""",
    "samples": f"""SELECT 'sig-' || user_id AS signal,
        CASE WHEN event_type = 'view' THEN {_US.format("min(date_trunc('hour', ts)) OVER (PARTITION BY user_id, event_id // 50)")} ELSE {_US.format("ts")} END AS source_ts,
        'Snapshot' AS change_type, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN replace(props, ' ', '') WHEN 'signup' THEN '"on"'
          ELSE CASE WHEN value = floor(value) THEN value::BIGINT::VARCHAR ELSE value::VARCHAR END END AS sample_value FROM events""",
    "sample_positions": f"""SELECT 'sig-' || user_id AS signal, 'newest' AS rule,
        {_US.format("max(CASE WHEN event_type <> 'view' THEN ts END)")} AS since FROM events GROUP BY user_id
        UNION ALL SELECT 'sig-' || user_id, 'window', {_US.format("max(ts)")} FROM events GROUP BY user_id""",
    "asset_changes": """WITH g AS (SELECT user_id AS id, ts, CASE WHEN event_type IN ('click', 'signup') THEN 'element' WHEN event_type = 'view' THEN 'elementTemplate' ELSE 'attribute' END AS t,
          CASE WHEN value < 20 THEN 'Insert' WHEN value < 60 THEN 'Update' WHEN value < 90 THEN 'Delete' END AS k FROM events),
        o AS (SELECT c_custkey AS oid, 'element' AS ot, '\\\\AF\\db\\' || c_name AS w, c_name AS name FROM customer
          UNION ALL SELECT s_suppkey, 'elementTemplate', s_name, s_name FROM supplier
          UNION ALL SELECT p_partkey, 'attribute', CASE WHEN p_size > 5 THEN p_brand ELSE '' END || '/' || p_name, p_name FROM part)
        SELECT t || '/' || CASE WHEN k = 'Delete' THEN id::VARCHAR ELSE w END AS entity, k AS change_type, ts AS source_ts,
          id::VARCHAR AS unique_id, name FROM g LEFT JOIN o ON oid = id AND ot = t AND k <> 'Delete'
        WHERE k = 'Delete' OR (k IS NOT NULL AND oid IS NOT NULL)""",
    "nest_attributes": """WITH a AS (SELECT l_orderkey AS k, l_linenumber AS n,
          arg_max(l_partkey || '/' || l_suppkey || '/' || l_quantity::INT, (l_shipdate, l_partkey, l_suppkey, l_quantity)) AS v FROM lineitem GROUP BY 1, 2),
        m AS (SELECT k, string_agg('line' || n || '=' || v, ',' ORDER BY n) AS attributes FROM a GROUP BY k),
        c AS (SELECT l_orderkey AS k, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS categories FROM lineitem GROUP BY 1)
        SELECT o_orderkey AS object_id, o_orderstatus, coalesce(attributes, '') AS attributes, coalesce(categories, '') AS categories
        FROM orders LEFT JOIN m ON m.k = o_orderkey LEFT JOIN c ON c.k = o_orderkey""",
}
