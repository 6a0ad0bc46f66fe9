"""Typed values: durations, watermarks, casts, JSON typing, document values."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.maps import text_map

DEFAULT_LOOKBACK = timedelta(hours=1)
# Cast names of mapping rules and the Spark types they mean.
CAST_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

_DURATION = re.compile(
    r"^(?P<sign>-?)P(?=.)(?:(?P<Y>\d+)Y)?(?:(?P<M>\d+)M)?(?:(?P<D>\d+)D)?"
    r"(?:T(?=.)(?:(?P<h>\d+)H)?(?:(?P<m>\d+)M)?(?:(?P<s>\d+(?:\.\d+)?)S)?)?$"
)
_INTEGER = r"^\s*[+-]?\d+\s*$"
_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DAY = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"


def parse_duration(text: str | None) -> timedelta:
    """An ISO-8601 duration; text that is none means one hour. Years are 365 days, months 30."""
    match = _DURATION.match(text or "")
    if not match:
        return DEFAULT_LOOKBACK
    n = {k: float(v or 0) for k, v in match.groupdict().items() if k != "sign"}
    span = timedelta(days=n["Y"] * 365 + n["M"] * 30 + n["D"], hours=n["h"], minutes=n["m"], seconds=n["s"])
    return -span if match["sign"] else span


def cold_start(now: datetime, lookback: str | None = "PT1H") -> datetime:
    """Where the first scan of an entity begins."""
    return now - parse_duration(lookback)


def moment(value: datetime | Column, dtype: T.DataType) -> Column:
    """A point in time as a literal of the given type, whatever the time zone of this process."""
    if isinstance(value, Column):
        return value.cast(dtype)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc)
        if isinstance(dtype, T.TimestampNTZType):
            value = value.replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast(dtype)


def iso_text(value: str | Column, dtype: T.DataType) -> Column:
    """Round-trip ISO text: seven fraction digits, and an offset for zoned timestamps."""
    value = F.col(value) if isinstance(value, str) else value
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS")
    if isinstance(dtype, T.TimestampType):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSxxx")
    return value.cast("string")


def normalise_watermark(value: str | Column, kind: str) -> Column:
    """A watermark property as a timestamp; any kind not listed never counts as changed (NULL)."""
    value = F.col(value) if isinstance(value, str) else value
    if kind == "epoch_ms":
        return F.timestamp_millis(value.cast("bigint"))
    if kind == "zoned":
        return F.try_to_timestamp(value.cast("string"))
    if kind == "local":  # taken as UTC
        return F.try_to_timestamp(F.concat(value.cast("string"), F.lit("Z")))
    return F.lit(None).cast("timestamp")


def plain_text(value: Column, dtype: T.DataType) -> Column:
    """A value as culture-neutral text: whole numbers without a fraction, True/False in title case."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e15))
        return F.when(whole, value.try_cast("bigint").cast("string")).otherwise(value.cast("string"))
    if isinstance(dtype, T.BooleanType):
        return F.initcap(value.cast("string"))
    return value.cast("string")


def cast_value(value: str | Column, name: str, dtype: T.DataType) -> Column:
    """The value in the named type, NULL where its text does not parse as that type."""
    value = F.col(value) if isinstance(value, str) else value
    name = name.lower()
    text = plain_text(value, dtype)
    if name == "string":
        return text
    if dtype == CAST_TYPES[name]:
        return value
    if name in ("int", "long"):
        return F.when(text.rlike(_INTEGER), F.trim(text).try_cast(CAST_TYPES[name]))
    if name == "double":
        return F.when(text.rlike(_DECIMAL), F.trim(text).try_cast("double"))
    if name == "bool":
        word = F.lower(F.trim(text))
        return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))
    if name == "date" and isinstance(dtype, T.StringType):
        return F.when(text.rlike(_DAY), F.trim(text).try_cast("date"))
    return value.try_cast(CAST_TYPES[name])


def cast_or_keep(value: str | Column, name: str, dtype: T.DataType) -> tuple[Column, Column]:
    """The typed value, and the original text where the cast failed."""
    value = F.col(value) if isinstance(value, str) else value
    typed = cast_value(value, name, dtype)
    return typed, F.when(typed.isNull() & value.isNotNull(), value.cast("string"))


def map_concept(value: Column, dtype: T.DataType, concepts: Mapping[str, str]) -> Column:
    """The concept of a value, else its text. Names are matched exactly; NULL stays NULL."""
    text = plain_text(value, dtype)
    return F.coalesce(F.try_element_at(text_map(dict(concepts)), text), text)


def type_json_fields(text: str | Column) -> Column:
    """A JSON object as MAP<name, STRUCT<kind, text>>.

    kind is string, long (whole numbers that fit 64 bits), double, bool, null or json; the text of
    nested values is raw JSON.
    """
    text = F.col(text) if isinstance(text, str) else text
    raw = F.from_json(text, "map<string,variant>")

    def typed(_, v):
        shape = F.schema_of_variant(v)
        value = F.try_variant_get(v, "$", "string")
        kind = (
            F.when(shape == "STRING", "string")
            .when(shape == "BOOLEAN", "bool")
            .when(shape == "VOID", "null")
            .when(shape.startswith("OBJECT") | shape.startswith("ARRAY"), "json")
            .when(shape == "BIGINT", "long")
            .otherwise("double")
        )
        return F.struct(kind.alias("kind"), F.when(kind != "null", value).alias("text"))

    return F.transform_values(raw, typed)


def document_fields(document: str | Column, kinds: Mapping[str, str]) -> Column:
    """Properties of an extended-JSON document as a struct; ``kinds`` gives text, double or date for each.

    Wrapped values are unwrapped: ``$oid`` to text, ``$numberDecimal``/``$numberLong``/… to the number,
    ``$date`` (ISO text or epoch milliseconds) to a timestamp, ``$undefined`` to NULL. The document
    is parsed once for all properties; a wrapper is parsed only where there is one.
    """
    document = F.col(document) if isinstance(document, str) else document
    parsed = F.from_json(document, T.StructType([T.StructField(n, T.StringType()) for n in kinds]))
    return once(parsed, lambda d: F.struct(*[_unwrapped(d[n], kind).alias(n) for n, kind in kinds.items()]))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with an expensive value evaluated once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _unwrapped(raw: Column, kind: str) -> Column:
    names = ("$oid", "$numberDecimal", "$numberDouble", "$numberLong", "$numberInt", "$undefined")
    wrapper = F.from_json(raw, T.StructType([T.StructField(n, T.StringType()) for n in names]))
    if kind == "date":
        date = F.from_json(raw, "`$date` string")["$date"]
        text = F.when(date.startswith("{"), F.get_json_object(date, "$.$numberLong")).otherwise(date)
        return once(text, lambda t: F.coalesce(F.timestamp_millis(t.try_cast("bigint")), F.try_to_timestamp(t)))
    inner = once(
        wrapper, lambda w: F.coalesce(*[w[n] for n in names[:5]], F.when(w["$undefined"].isNull(), raw))
    )
    value = F.when(raw.startswith('{"$'), inner).otherwise(raw)
    return value.try_cast("double") if kind == "double" else value
