"""Landed JSON: document changes, delta pages, samples and asset-tree changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.maps import text_map
from changeflow.operators.lookup import lookup
from changeflow.sources.feeds import kind_of

# Operations of document streams and of the asset tree, and the change kinds they mean.
DOCUMENT_KINDS = {"insert": "Insert", "update": "Update", "replace": "Update", "delete": "Delete"}
ASSET_KINDS = {"Added": "Insert", "Updated": "Update", "Removed": "Delete"}
# Object types of the asset tree.
ASSET_TYPES = ("element", "elementTemplate", "attribute")


def decode_document_changes(df: DataFrame, collections: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Document change-stream records as raw changes; documents stay JSON text.

    Other operations are dropped, and other collections when some are listed. A delete without a
    document carries the document key. Cluster time is in epoch seconds.
    """
    # One parse per record, also when filters follow: those are not moved below a generator. The parts
    # that stay JSON text are declared as strings.
    schema = (
        "_id string, operationType string, ns struct<coll: string>, clusterTime string, fullDocument string, "
        "fullDocumentBeforeChange string, documentKey string"
    )
    part = lambda name: F.col(f"__r.{name}")
    out = df.select(F.explode(F.array(F.from_json(F.col(value), schema))).alias("__r")).withColumns(
        {
            "entity": F.coalesce(part("ns.coll"), F.lit("unknown")),
            "change_type": kind_of(part("operationType"), DOCUMENT_KINDS, None),
        }
    )
    if collections:
        out = out.filter(F.col("entity").isin(*collections))
    seconds = F.coalesce(
        F.get_json_object(part("clusterTime"), "$.$timestamp.t"), part("clusterTime")
    ).try_cast("bigint")
    token = F.coalesce(F.get_json_object(part("_id"), "$._data"), part("_id"), F.lit(""))
    full = part("fullDocument")
    return out.filter(F.col("change_type").isNotNull()).select(
        "entity",
        "change_type",
        F.timestamp_seconds(seconds).alias("source_ts"),
        F.when((F.col("change_type") == "Delete") & (F.coalesce(full, F.lit("{}")) == "{}"), part("documentKey"))
        .otherwise(full)
        .alias("row"),
        part("fullDocumentBeforeChange").alias("prev"),
        F.create_map(F.lit("resumeToken"), token).alias("meta"),
    )


def decode_delta_pages(
    df: DataFrame, detect_deletes: bool = True, source: str = "sharepoint", value: str = "value"
) -> DataFrame:
    """Items of delta pages as raw changes; the item stays JSON text, see ``type_json_fields``.

    Input: entity, page_no and the page text. An item with a ``deleted`` property is a Delete where
    ``detect_deletes`` is set, every other item an Update.
    """
    items = F.from_json(F.get_json_object(F.col(value), "$.value"), "array<variant>")
    deleted = F.try_variant_get(F.col("__item"), "$.deleted", "variant").isNotNull()  # also a JSON null counts
    kind = F.when(deleted, "Delete").otherwise("Update") if detect_deletes else F.lit("Update")
    return df.withColumn("__item", F.explode(items)).select(
        "entity",
        "page_no",
        kind.alias("change_type"),
        F.lit(None).cast("timestamp").alias("source_ts"),
        F.to_json("__item").alias("row"),
        text_map({"source": source}).alias("meta"),
    )


def page_link(value: str = "value", next_links: bool = True) -> Column:
    """The cursor of a page: its delta link, else its next link."""
    links = [F.get_json_object(F.col(value), "$['@odata.deltaLink']")]
    if next_links:
        links.append(F.get_json_object(F.col(value), "$['@odata.nextLink']"))
    return F.coalesce(*links)


def page_cursors(df: DataFrame, next_links: bool = True, value: str = "value") -> DataFrame:
    """Cursor per entity after a set of pages: the last link wins, pages without a link keep it."""
    link = page_link(value, next_links)
    return (
        df.select("entity", "page_no", link.alias("link"))
        .groupBy("entity")
        .agg(F.max_by("link", F.when(F.col("link").isNotNull(), F.col("page_no"))).alias("cursor"))
    )


def decode_samples(
    df: DataFrame, items: str, time: str, sample: str, since: Column | None = None, source: str = "samples", value: str = "value"
) -> DataFrame:
    """Samples of time-series responses as raw changes.

    Input: signal and the response text. ``items``, ``time`` and ``sample`` name the JSON properties.
    The value is raw JSON text; a sample without a time gets ``since``.
    """
    array = F.from_json(F.get_json_object(F.col(value), f"$.{items}"), "array<map<string,variant>>")
    at = F.try_to_timestamp(F.try_variant_get(F.try_element_at(F.col("__s"), F.lit(time)), "$", "string"))
    at = F.coalesce(at, since) if since is not None else at
    keep = [c for c in df.columns if c != value]
    return df.withColumn("__s", F.explode(array)).select(
        *keep,
        F.lit("Snapshot").alias("change_type"),
        at.alias("source_ts"),
        F.to_json(F.try_element_at(F.col("__s"), F.lit(sample))).alias("sample_value"),
        text_map({"source": source}).alias("meta"),
    )


def sample_watermark(df: DataFrame, at: str | Column = "source_ts") -> DataFrame:
    """Next start per signal: the newest time ``at``.

    Pass decoded samples to go on after the newest sample, or the responses with the end of their
    requested window to go on there; then responses without samples count too.
    """
    return df.groupBy("signal").agg(F.max(at).alias("since"))


def watched_types(filters: Sequence[str | None]) -> tuple[str, ...]:
    """Object types to watch: all without entities; an entity without a type means elements."""
    if not filters:
        return ASSET_TYPES
    return tuple(dict.fromkeys((f or "").strip() or "element" for f in filters))


def decode_asset_changes(
    log: DataFrame, objects: DataFrame, types: Sequence[str] = ASSET_TYPES, source: str = "asset-tree"
) -> DataFrame:
    """Asset-tree changes as raw changes.

    log: object_id, object_type, action, change_ts; objects: object_id, object_type, name, path,
    owner and further columns. Deletes are addressed by id and carry only that; other changes need
    their object and are skipped when it is gone. Types are matched without case.
    """
    wanted = [t.lower() for t in types]
    kind = kind_of("action", ASSET_KINDS, None)
    log = log.withColumn("change_type", kind).filter(
        F.col("change_type").isNotNull() & F.lower("object_type").isin(*wanted)
    )
    row = F.struct(*[F.col(c) for c in objects.columns if c != "object_type"])
    found = objects.select(
        F.col("object_id").alias("__id"), F.lower("object_type").alias("__type"), row.alias("row"),
        F.when(F.lower("object_type") == "element", F.col("path"))
        .when(F.lower("object_type") == "attribute", F.concat_ws("/", F.coalesce("owner", F.lit("")), "name"))
        .otherwise(F.col("name"))
        .alias("__where"),
    )
    # Deletes look for no object: their id is made NULL for the join.
    wanted = F.when(F.col("change_type") != "Delete", F.col("object_id"))
    meta = F.create_map(F.lit("source"), F.lit(source), F.lit("entityType"), F.col("object_type"))
    kept = lookup(log, found, [wanted, F.lower("object_type")], ["__id", "__type"]).filter(
        (F.col("change_type") == "Delete") | F.col("__id").isNotNull()
    )
    tail = F.when(F.col("change_type") == "Delete", F.col("object_id").cast("string")).otherwise(F.col("__where"))
    return kept.select(
        F.concat(F.col("object_type"), F.lit("/"), tail).alias("entity"),
        "change_type",
        F.col("change_ts").alias("source_ts"),
        F.col("object_id").cast("string").alias("unique_id"),
        "row",
        meta.alias("meta"),
    )


def nest_attributes(objects: DataFrame, attributes: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Objects with their attributes as a map and their category names as a sorted list.

    attributes: object_id, name, value (text, or a struct for templates). Equal names are reduced to
    the last in ``ordinal`` (or any, when absent) by a partial aggregate before a map is built, so a
    map holds each attribute once; categories are made distinct the same way.
    """
    rank = "ordinal" if "ordinal" in attributes.columns else "name"
    one = attributes.groupBy("object_id", "name").agg(F.max_by("value", rank).alias("value"))
    maps = one.groupBy("object_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "value")))).alias("attributes")
    )
    out = objects.join(maps, "object_id", "left")
    if categories is not None:
        lists = categories.groupBy("object_id").agg(F.sort_array(F.collect_set("name")).alias("categories"))
        out = out.join(lists, "object_id", "left").withColumn(
            "categories", F.coalesce("categories", F.array().cast("array<string>"))
        )
    return out
