"""Map columns: merging metadata and nested attributes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_map(values: Mapping[str, str | Column]) -> Column:
    """A map literal; an empty mapping gives an empty MAP<STRING,STRING>."""
    if not values:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    pairs = [x for k, v in values.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v))]
    return F.create_map(*pairs)


def merge_metadata(base: str | Column, headers: Mapping[str, str]) -> Column:
    """Configured headers win over existing entries; names ignore case and keep their first spelling."""
    base = F.col(base) if isinstance(base, str) else base
    base = F.coalesce(base, text_map({}))
    return merge_ignoring_case(base, text_map(headers)) if headers else base


def merge_ignoring_case(base: Column, extra: Column) -> Column:
    """Entries of ``extra`` replace those of ``base`` under any spelling of the name; the first spelling stays."""
    entries = F.map_entries(extra)
    named = lambda k: F.filter(entries, lambda e: F.lower(e["key"]) == F.lower(k))
    kept = F.transform_values(
        base, lambda k, v: F.when(F.size(named(k)) > 0, F.try_element_at(named(k), F.lit(-1))["value"]).otherwise(v)
    )
    present = F.transform(F.map_keys(base), F.lower)
    added = F.map_filter(extra, lambda k, v: ~F.array_contains(present, F.lower(k)))
    return F.map_concat(kept, added)


def override(base: Column, extra: str | Column) -> Column:
    """Entries of ``extra`` replace entries of ``base`` with the same name."""
    extra = F.coalesce(F.col(extra) if isinstance(extra, str) else extra, text_map({}))
    kept = F.map_filter(base, lambda k, v: ~F.map_contains_key(extra, k))
    return F.map_concat(kept, extra)


def merge_attributes(base: str | Column, patch: str | Column, add_missing: bool) -> Column:
    """Set attributes from a patch.

    ``add_missing=False``: MAP<STRING,STRING>, only attributes that exist are set, others are ignored.
    ``add_missing=True``: MAP<STRING,STRUCT<type,defaultValue,uom,isConfig>>, missing attributes are
    added and the parts that the patch supplies are set.
    """
    base = F.col(base) if isinstance(base, str) else base
    patch = F.col(patch) if isinstance(patch, str) else patch
    if not add_missing:
        return F.when(patch.isNull(), base).otherwise(
            F.transform_values(
                base, lambda k, v: F.when(F.map_contains_key(patch, k), F.try_element_at(patch, k)).otherwise(v)
            )
        )
    parts = ("type", "defaultValue", "uom", "isConfig")
    merged = F.map_zip_with(
        base, patch, lambda k, b, p: F.struct(*[F.coalesce(p[n], b[n]).alias(n) for n in parts])
    )
    return F.coalesce(merged, base, patch)
