"""Event addresses, envelopes, headers and subscriptions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.maps import override, text_map
from changeflow.functions.text import context_segment, sanitise_path, subject_matches, template_parts
from changeflow.functions.values import iso_text

# Envelope field names and the event columns they come from.
ENVELOPE_FIELDS = {
    "event_id": "event_id",
    "detected_at": "detected_at",
    "source_timestamp": "source_ts",
    "source_type": "source_type",
    "driver_id": "driver_id",
    "context": "context",
    "entity_path": "entity",
    "change_type": "change_type",
    "primary_key": "pk",
    "fields": "fields",
    "previous_fields": "prev",
    "metadata": "meta",
    "sequence_number": "seq",
}


def default_subject(prefix: str = "cdc") -> Column:
    """``prefix.context.entity.change``, or ``prefix.source.driver.change`` without a context."""
    change = F.lower("change_type")
    with_context = F.concat_ws(".", F.lit(prefix), context_segment("context"), sanitise_path("entity"), change)
    without = F.lower(F.concat_ws(".", F.lit(prefix), F.col("source_type"), F.col("driver_id"), change))
    return F.when(F.coalesce(F.col("context"), F.lit("")) != "", with_context).otherwise(without)


def subject_from_template(template: str) -> Column:
    """An address from a template; an unknown token fails when the plan is built."""
    tokens = {
        "{context}": context_segment("context"),
        "{entityPath}": sanitise_path("entity"),
        "{changeType}": F.lower("change_type"),
        "{driverId}": F.col("driver_id"),
        "{sourceType}": F.col("source_type"),
    }
    return F.concat(*[F.coalesce(tokens[p], F.lit("")) if p in tokens else F.lit(p) for p in template_parts(template)])


def with_subject(
    df: DataFrame, override: str | None = None, template: str | None = None, prefix: str = "cdc"
) -> DataFrame:
    """Fixed address, else template, else the default."""
    if override is not None:
        return df.withColumn("subject", F.lit(override))
    return df.withColumn("subject", subject_from_template(template) if template is not None else default_subject(prefix))


def encode_values(value: Column, dtype: T.DataType, numbers: str = "exact") -> Column:
    """Values as they go into the envelope: ISO text for times; numbers exact, or all as doubles."""
    if isinstance(dtype, T.StructType):
        parts = [encode_values(value[f.name], f.dataType, numbers).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*parts)) if parts else value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: encode_values(x, dtype.elementType, numbers))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda k, v: encode_values(v, dtype.valueType, numbers))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(value, dtype)
    if isinstance(dtype, T.NumericType):
        return value.cast("double") if numbers == "double" else value
    if isinstance(dtype, (T.BooleanType, T.VariantType, T.NullType)):
        return value
    return value.cast("string")


def to_envelope(df: DataFrame, numbers: str = "exact") -> DataFrame:
    """Add ``envelope``: the 13-field record as JSON text.

    Source time and previous fields are left out when absent; NULL values inside them are kept.
    """
    parts = []
    for name, source in ENVELOPE_FIELDS.items():
        dtype = df.schema[source].dataType
        nested = isinstance(dtype, (T.StructType, T.MapType))
        value = encode_values(F.col(source), dtype, numbers if nested else "exact")
        if isinstance(dtype, T.StructType):
            value = F.to_variant_object(value)
        parts.append(value.alias(name))
    return df.withColumn("envelope", F.to_json(F.struct(*parts)))


def with_headers(
    df: DataFrame, extra: Mapping[str, str] | str | None = None, content_type: str = "application/json"
) -> DataFrame:
    """Add ``headers``; extra entries (literals or a map column) override."""
    base = text_map(
        {
            "eventId": F.col("event_id"),
            "driverId": F.col("driver_id"),
            "context": F.col("context"),
            "sourceType": F.col("source_type"),
            "changeType": F.col("change_type"),
            "content-type": content_type,
        }
    )
    if extra is None:
        return df.withColumn("headers", base)
    more = F.col(extra) if isinstance(extra, str) else text_map(dict(extra))
    return df.withColumn("headers", override(base, more))


def subscribe(df: DataFrame, pattern: str, preview: bool = False) -> DataFrame:
    """Events whose subject matches; ``preview`` adds the first four fields as text."""
    out = df.filter(subject_matches("subject", pattern))
    if not preview:
        return out
    names = [f.name for f in df.schema["fields"].dataType.fields][:4]
    shown = [F.concat(F.lit(f"{n}="), F.coalesce(F.col(f"fields.`{n}`").cast("string"), F.lit("null"))) for n in names]
    more = F.lit(", ..." if len(df.schema["fields"].dataType.fields) > 4 else "")
    return out.withColumn("preview", F.concat(F.concat_ws(", ", *shown), more))
