"""Watermark scans, snapshot differences, resume anchors and discovery.

Watermark predicates are plain comparisons with literals, so they reach the Parquet or JDBC scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.values import moment
from changeflow.operators.lookup import lookup
from changeflow.sinks.tables import read_version, write_version
from changeflow.spec import Entity

# Schemas that hold no user tables.
SYSTEM_SCHEMAS = ("pg_catalog", "information_schema")


def incremental_scan(
    df: DataFrame,
    wm: str,
    since: datetime | Column,
    overlap: timedelta | None = None,
    emitted: DataFrame | None = None,
    key: Sequence[str] = (),
    predicate: str | None = None,
) -> DataFrame:
    """Rows with ``wm > since``; rows without a watermark never qualify.

    With ``overlap`` the scan starts that much earlier, and rows whose (key, wm) is in ``emitted``
    are left out: late rows are found without repeating the others.
    """
    dtype = df.schema[wm].dataType
    if predicate:
        df = df.filter(F.expr(predicate))
    if overlap is None:
        return df.filter(F.col(wm) > moment(since, dtype))
    if emitted is None or not key:
        raise ValueError("an overlap scan needs the emitted rows and the key")
    start = since - overlap
    seen = emitted.filter(F.col(wm) > moment(start, dtype)).select(*key, wm)
    return df.filter(F.col(wm) > moment(start, dtype)).join(seen, [*key, wm], "left_anti")


def raw_changes(
    df: DataFrame,
    entity: str,
    wm: str | None = None,
    change_type: str | Column = "Snapshot",
    source_ts: bool = True,
    meta: Column | None = None,
) -> DataFrame:
    """Rows of one table in the raw change shape; ``source_ts`` is the row's own watermark or NULL."""
    row = F.struct(*[F.col(c) for c in df.columns])
    ts = F.col(wm) if wm and source_ts else F.lit(None).cast("timestamp")
    kind = F.lit(change_type) if isinstance(change_type, str) else change_type
    return df.select(
        F.lit(entity).alias("entity"),
        kind.alias("change_type"),
        ts.alias("source_ts"),
        row.alias("row"),
        (meta if meta is not None else F.lit(None).cast("map<string,string>")).alias("meta"),
    )


def advance_watermark(df: DataFrame, wm: str, state: DataFrame) -> DataFrame:
    """``max(since, max(wm))`` per (driver_id, entity); an entity without new rows keeps its value.

    ``state`` has columns driver_id, entity, since. The maximum is taken map-side first.
    """
    new = df.groupBy("driver_id", "entity").agg(F.max(wm).alias("__max"))
    return (
        state.join(new, ["driver_id", "entity"], "full")
        .withColumn("since", F.greatest(F.col("since"), F.col("__max")))
        .drop("__max")
    )


def advance_version(df: DataFrame, version: str, start: int | None = None) -> DataFrame:
    """Next position of a version log: the greatest version read, else where the scan began."""
    return df.agg(F.coalesce(F.max(version), F.lit(start).cast("bigint")).alias("position"))


def scan_all(
    tables: Sequence[tuple[Entity, DataFrame]], since: Mapping[str, datetime] | datetime
) -> DataFrame:
    """All watched entities after their own watermark, as one table with the row as JSON text.

    Each entity keeps its typed scan and pushed-down predicate; only the projection differs.
    """
    out = None
    for entity, df in tables:
        start = since[entity.name] if isinstance(since, Mapping) else since
        rows = incremental_scan(df, entity.watermark, start, predicate=entity.filter)
        key = F.struct(*entity.key) if entity.key else F.struct(*df.columns)
        part = rows.select(
            F.lit(entity.name).alias("entity"),
            F.lit("Snapshot").alias("change_type"),
            F.col(entity.watermark).alias("source_ts"),
            F.to_json(key).alias("pk"),
            F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row"),
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no entities to scan")
    return out


def scan_shared(df: DataFrame, wm: str, state: DataFrame, entity: str = "entity") -> DataFrame:
    """Several entities in one table, each after its own watermark from a small state table."""
    table = state.select(F.col("entity").alias("__e"), F.col("since").alias("__since"))
    return lookup(df, table, [entity], ["__e"], "inner").filter(F.col(wm) > F.col("__since")).drop("__e", "__since")


def graph_scan(nodes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """Edges of a type for ``REL:TYPE``, otherwise nodes of a label."""
    if name.upper().startswith("REL:"):
        return edges.filter(F.col("type") == name[4:])
    return nodes.filter(F.col("label") == name)


def snapshot_diff(prev: DataFrame | None, cur: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of the previous snapshot whose key vanished. The first cycle has none.

    Joined on the real key columns (NULL-safe), so key texts cannot collide.
    """
    if not key:
        raise ValueError("a snapshot difference needs key columns")
    if prev is None:
        return cur.limit(0)
    now = cur.select(*[F.col(k).alias(f"__c{i}") for i, k in enumerate(key)])
    on = [F.col(k).eqNullSafe(F.col(f"__c{i}")) for i, k in enumerate(key)]
    return prev.join(now, on, "left_anti")


def snapshot_changes(
    prev: DataFrame | None, cur: DataFrame, key: Sequence[str], wm: str, since: datetime
) -> DataFrame:
    """Deletes (phase 0) with the last known row, then rows after the watermark (phase 1)."""
    gone = snapshot_diff(prev, cur, key)
    fresh = incremental_scan(cur, wm, since)
    return gone.withColumns({"phase": F.lit(0), "change_type": F.lit("Delete")}).unionByName(
        fresh.withColumns({"phase": F.lit(1), "change_type": F.lit("Snapshot")})
    )


def snapshot_cycle(cur: DataFrame, path: str, key: Sequence[str], wm: str, since: datetime) -> DataFrame:
    """One poll of a snapshot source: changes against the stored snapshot, which is then replaced."""
    spark = cur.sparkSession
    before = read_version(spark, path)
    now = spark.read.parquet(f"{path}/v={write_version(cur, path)}")
    return snapshot_changes(before, now, key, wm, since)


def anchor(df: DataFrame, pos: str, stored: object | None = None) -> DataFrame:
    """Changes after a stored position; without one everything that exists now is discarded.

    ``anchor_position`` gives the value to store for the next run.
    """
    if stored is None:
        return df.limit(0)
    return df.filter(F.col(pos) > F.lit(stored).cast(df.schema[pos].dataType))


def anchor_position(df: DataFrame, pos: str) -> DataFrame:
    return df.agg(F.max(pos).alias("position"))


def discover_tables(catalogue: DataFrame, system: Sequence[str] = SYSTEM_SCHEMAS) -> DataFrame:
    """``schema.table`` of every table outside the system schemas; input has table_schema, table_name."""
    return catalogue.filter(~F.col("table_schema").isin(*system)).select(
        F.concat_ws(".", "table_schema", "table_name").alias("entity")
    )


def catalogue_tables(spark: SparkSession) -> DataFrame:
    """Spark's own catalogue, all schemas, in the shape ``discover_tables`` reads."""
    schemas = [d.name for d in spark.catalog.listDatabases()]
    found = {(t.namespace[0] if t.namespace else "", t.name) for d in schemas for t in spark.catalog.listTables(d)}
    rows = sorted(found)
    return spark.createDataFrame(rows, "table_schema string, table_name string")


def discover_keys(constraints: DataFrame, usage: DataFrame, tables: DataFrame) -> DataFrame:
    """Base tables with a primary key and their key columns in position order.

    constraints: table_schema, table_name, constraint_name, constraint_type; usage: constraint_name,
    table_schema, table_name, column_name, ordinal_position; tables: table_schema, table_name,
    table_type. A key has few columns, so the gathered list is short.
    """
    on = ["table_schema", "table_name"]
    keys = constraints.filter(F.col("constraint_type") == "PRIMARY KEY").select(*on, "constraint_name")
    columns = F.sort_array(F.collect_list(F.struct("ordinal_position", "column_name")))
    return (
        keys.join(usage.select(*on, "constraint_name", "column_name", "ordinal_position"), [*on, "constraint_name"])
        .join(tables.filter(F.col("table_type") == "BASE TABLE").select(*on), on)
        .groupBy(*on)
        .agg(F.transform(columns, lambda c: c["column_name"]).alias("key_columns"))
        .select(F.concat_ws(".", *on).alias("entity"), "key_columns")
    )


def read_jdbc(
    spark: SparkSession, url: str, entity: Entity, since: datetime | None = None, fetch_size: int = 10_000, **options: str
) -> DataFrame:
    """A JDBC table; the watermark and the entity predicate are sent to the database.

    Pass partitionColumn, lowerBound, upperBound and numPartitions to read a big first load in parallel.
    """
    df = (
        spark.read.format("jdbc")
        .options(url=url, dbtable=entity.name, fetchsize=str(fetch_size), **options)
        .load()
    )
    if entity.filter:
        df = df.filter(F.expr(entity.filter))
    return df if since is None else incremental_scan(df, entity.watermark, since)

