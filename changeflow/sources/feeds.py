"""Change feeds: version logs, change-data feeds, replication logs and change envelopes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.maps import text_map
from changeflow.operators.lookup import lookup

# Operation codes of the feeds and the change kinds they mean.
TRACKING_KINDS = {"I": "Insert", "U": "Update", "D": "Delete"}
FEED_KINDS = {"insert": "Insert", "update_postimage": "Update", "delete": "Delete"}
ENVELOPE_KINDS = {"c": "Insert", "u": "Update", "d": "Delete", "r": "Snapshot"}
FEED_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp", "_change_type_sequence")
# Log messages, the change they mean, and which parts hold the new and the old row.
LOG_MESSAGES = {
    "insert": ("Insert", "new", None),
    "full_update": ("Update", "new", "old"),
    "index_update": ("Update", "new", "key"),
    "update": ("Update", "new", None),
    "key_delete": ("Delete", "key", None),
    "full_delete": ("Delete", "old", None),
}


def kind_of(code: str | Column, kinds: Mapping[str, str], other: str | None = "Snapshot") -> Column:
    """A change kind from a feed's code; ``other`` for codes that are not listed."""
    code = F.col(code) if isinstance(code, str) else code
    out = F.lit(other).cast("string")
    for value, kind in kinds.items():
        out = F.when(code == value, F.lit(kind)).otherwise(out)
    return out


def changes_join_current(
    log: DataFrame, table: DataFrame, key: Sequence[str], since: int, version: str = "version", operation: str = "operation"
) -> DataFrame:
    """Version-log rows after ``since`` with the current row of their key.

    Key values come from the log side. A Delete keeps the key columns only. The log is filtered
    before the join; the table holds a key once, the log may hold it very often.
    """
    if not key:
        raise ValueError("change tracking needs key columns")
    rest = [c for c in table.columns if c.lower() not in {k.lower() for k in key}]
    side = table.select(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(key)], *rest)
    kind = kind_of(operation, TRACKING_KINDS)
    wanted = log.filter(F.col(version) > since).select(*key, version, operation)
    joined = lookup(wanted, side, list(key), [f"__t{i}" for i in range(len(key))])
    return joined.select(
        version,
        kind.alias("change_type"),
        *key,
        *[F.when(kind != "Delete", F.col(c)).alias(c) for c in rest],
    )


def read_change_feed(
    feed: DataFrame, start: int | None = None, keep_before: bool = False, key: Sequence[str] = ()
) -> DataFrame:
    """Feed rows from a commit version on, without the feed's own columns.

    Pre-images are dropped, or joined to their post-image as ``prev`` when ``keep_before`` is set.
    Without a start version only the latest commit is read.
    """
    begin = F.lit(start) if start is not None else feed.agg(F.max("_commit_version")).first()[0]
    rows = feed.filter(F.col("_commit_version") >= begin)
    data = [c for c in feed.columns if c not in FEED_COLUMNS]
    out = rows.filter(F.col("_change_type") != "update_preimage").withColumns(
        {"change_type": kind_of("_change_type", FEED_KINDS), "version": F.col("_commit_version")}
    )
    if not keep_before:
        return out.select("version", "change_type", *data)
    if not key:
        raise ValueError("before images are paired by key")
    before = rows.filter(F.col("_change_type") == "update_preimage").select(
        *[F.col(k).alias(f"__b{i}") for i, k in enumerate(key)],
        F.col("_commit_version").alias("__bv"),
        F.struct(*data).alias("prev"),
    )
    on = [F.col(k) == F.col(f"__b{i}") for i, k in enumerate(key)]
    on += [F.col("version") == F.col("__bv"), F.col("change_type") == "Update"]
    return out.join(before, on, "left").select("version", "change_type", *data, "prev")


def next_feed_version(feed: DataFrame, start: int) -> DataFrame:
    """Where the next read begins; it moves only when rows were read."""
    seen = F.max(F.when(F.col("_commit_version") >= start, F.col("_commit_version")))
    return feed.agg(F.coalesce(seen + 1, F.lit(start).cast("bigint")).alias("position"))


def typed_rows(df: DataFrame, schema: str) -> DataFrame:
    """``row`` and ``prev`` of a decoded feed as typed structs; they may be JSON text or text maps.

    A value that does not parse as its type is NULL. After this a feed can be tracked, mapped and
    published like any scanned table.
    """
    fields = T.StructType.fromDDL(schema).fields

    def typed(name: str) -> Column:
        if isinstance(df.schema[name].dataType, T.StringType):
            return F.from_json(name, schema)
        parts = [F.try_element_at(F.col(name), F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in fields]
        return F.when(F.size(name) > 0, F.struct(*parts))

    return df.withColumns({c: typed(c) for c in ("row", "prev") if c in df.columns})


def decode_log_messages(df: DataFrame) -> DataFrame:
    """Decoded replication messages as raw changes.

    Input: message, namespace, relation, server_ts, columns ARRAY<STRING>, new_values, old_values
    (ARRAY<STRING>) and key_columns/key_values. A value that was not sent is NULL. Messages that are
    no row change are skipped.
    """
    maps = {
        "new": F.map_from_arrays("columns", "new_values"),
        "old": F.map_from_arrays("columns", "old_values"),
        "key": F.map_from_arrays("key_columns", "key_values"),
    }
    kind = F.lit(None).cast("string")
    row = prev = F.lit(None).cast("map<string,string>")
    for message, (change, new, old) in LOG_MESSAGES.items():
        hit = F.col("message") == message
        kind = F.when(hit, F.lit(change)).otherwise(kind)
        row = F.when(hit, maps[new]).otherwise(row)
        if old:
            prev = F.when(hit, maps[old]).otherwise(prev)
    return df.filter(F.col("message").isin(*LOG_MESSAGES)).select(
        F.concat_ws(".", "namespace", "relation").alias("entity"),
        kind.alias("change_type"),
        F.col("server_ts").alias("source_ts"),
        row.alias("row"),
        prev.alias("prev"),
        F.lit(None).cast("map<string,string>").alias("meta"),
    )


def decode_debezium(
    df: DataFrame, contexts: Mapping[str, str] | None = None, value: str = "value", driver: str | None = None
) -> DataFrame:
    """Change envelopes in JSON as raw changes with driver, source type and context.

    Row images stay MAP<STRING,STRING>, since each table has its own columns.
    """
    schema = (
        "payload struct<before: map<string,string>, after: map<string,string>, op: string, "
        "source: struct<version: string, connector: string, name: string, ts_ms: bigint, "
        "snapshot: string, schema: string, table: string>>"
    )
    p, source = F.col("__p"), F.col("__p.source")
    name = F.lit(driver) if driver else source["name"]
    # A generator keeps later filters above the parse, so that each record is parsed once.
    parsed = df.withColumn("__p", F.explode(F.array(F.from_json(F.col(value), schema)["payload"])))
    return parsed.select(
        *[c for c in df.columns if c != value],
        name.alias("driver_id"),
        source["connector"].alias("source_type"),
        F.try_element_at(text_map(dict(contexts or {})), name).alias("context"),
        F.concat_ws(".", F.coalesce(source["schema"], F.lit("public")), source["table"]).alias("entity"),
        kind_of(p["op"], ENVELOPE_KINDS).alias("change_type"),
        F.timestamp_millis(source["ts_ms"]).alias("source_ts"),
        p["after"].alias("row"),
        p["before"].alias("prev"),
        F.create_map(
            F.lit("debezium_version"), source["version"],
            F.lit("snapshot"), F.coalesce(source["snapshot"], F.lit("false")),
        ).alias("meta"),
    )
