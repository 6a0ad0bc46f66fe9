"""The forward plan: raw changes → change events → publishable events and dead letters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.maps import merge_metadata
from changeflow.operators.addressing import to_envelope, with_headers, with_subject
from changeflow.operators.changes import with_event_id, with_history, with_sequence
from changeflow.operators.mapping import apply_mapping
from changeflow.operators.ordered import numbered
from changeflow.spec import Rule

_PLACE = "__place"


@dataclass(frozen=True)
class Driver:
    """Settings of one source."""

    driver_id: str
    source_type: str
    context: str = ""
    rules: Sequence[Rule] = ()
    headers: Mapping[str, str] = field(default_factory=dict)
    subject: str | None = None
    template: str | None = None
    prefix: str = "cdc"


def change_events(
    raw: DataFrame,
    driver: Driver,
    key: Sequence[str],
    order: Sequence[str | Column],
    detected_at: Column | None = None,
    sequence: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Raw changes as change events with before image, kind, mapped fields, id, sequence and subject.

    State operators run on raw column names, before the mapping. ``sequence=True`` adds the
    per-driver number (else NULL), which costs an ordered pass over all rows of a driver.
    """
    raw, order = without_excluded(raw, driver.rules, key, order)
    if sequence:
        raw = with_numbers(raw, driver, order, hot_rows)
    history = with_history(raw, key, order, hot_rows=hot_rows)
    out = finish_events(history, driver, key, order, detected_at, 0 if sequence else None, hot_rows)
    return out.drop(*[c for c in order if isinstance(c, str) and c.startswith("__order")])


def without_excluded(
    raw: DataFrame, rules: Sequence[Rule], key: Sequence[str], order: Sequence[str | Column]
) -> tuple[DataFrame, Sequence[str | Column]]:
    """Raw changes without the fields that rules exclude, so that they are neither read nor shuffled.

    Key fields stay until the mapping. Order columns that are expressions are computed first, since
    they may use an excluded field.
    """
    gone = {r.source.lower() for r in rules if r.exclude} - {k.lower() for k in key}
    fields = {c: [f.name for f in raw.schema[c].dataType.fields] for c in ("row", "prev") if c in raw.columns and isinstance(raw.schema[c].dataType, T.StructType)}
    if not any(n.lower() in gone for names in fields.values() for n in names):
        return raw, order
    named = {f"__order{i}": c for i, c in enumerate(order) if not isinstance(c, str)}
    out = raw.withColumns(named)
    for c, names in fields.items():
        kept = F.struct(*[F.col(f"{c}.`{n}`").alias(n) for n in names if n.lower() not in gone])
        out = out.withColumn(c, F.when(F.col(c).isNotNull(), kept))
    return out, [c if isinstance(c, str) else f"__order{i}" for i, c in enumerate(order)]


def with_numbers(raw: DataFrame, driver: Driver, order: Sequence[str | Column], hot_rows: int | None = None) -> DataFrame:
    """Raw changes of one driver with their place in order, which ``finish_events`` takes as the sequence number.

    All rows of a driver are one group. Numbered first, only bare rows meet in one task; images, mapping and envelopes
    are made by key afterwards.
    """
    named = raw.withColumn("__driver", F.lit(driver.driver_id))
    return numbered(named, ["__driver"], order, _PLACE, hot_rows).drop("__driver")


def finish_events(
    history: DataFrame,
    driver: Driver,
    key: Sequence[str],
    order: Sequence[str | Column],
    detected_at: Column | None = None,
    after: int | None = 0,
    hot_rows: int | None = None,
) -> DataFrame:
    """Everything of an event that follows from its own row; numbers continue ``after`` the last one.

    Rows that ``with_numbers`` numbered keep their order; others are numbered here.
    """
    out = history.withColumns(
        {
            "source_type": F.lit(driver.source_type),
            "driver_id": F.lit(driver.driver_id),
            "context": F.lit(driver.context),
            "detected_at": detected_at if detected_at is not None else F.current_timestamp(),
            "meta": merge_metadata("meta", driver.headers),
        }
    )
    out = with_event_id(out, ["driver_id", "entity", *[F.col(f"row.`{k}`") for k in key], *order])
    if after is None:
        out = out.withColumn("seq", F.lit(None).cast("bigint"))
    elif _PLACE in out.columns:
        out = out.withColumn("seq", F.col(_PLACE) + after).drop(_PLACE)
    else:
        out = with_sequence(out, order, hot_rows=hot_rows).withColumn("seq", F.col("seq") + after)
    out = apply_mapping(out, driver.rules, key)
    return with_subject(out, driver.subject, driver.template, driver.prefix)


def publishable(events: DataFrame, numbers: str = "exact") -> DataFrame:
    """Events with envelope and headers, ready for ``split_dead_letters`` and a sink."""
    return with_headers(to_envelope(events, numbers))
