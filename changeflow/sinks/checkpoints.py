"""Positions per (driver, entity): rollup, resume, save."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.values import iso_text, moment
from changeflow.operators.lookup import lookup
from changeflow.sinks.tables import read_version, write_version


def checkpoints(events: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Position of the last written event (not the greatest): its source time in ISO form, else its id.

    ``order`` names the columns in whose order events were written. A missing value there is an error:
    without an order there is no last event, and a position that is lost would start the source over.
    """
    position = F.coalesce(iso_text("source_ts", events.schema["source_ts"].dataType), F.col("event_id"))
    missing = F.lit(False)
    for c in order:
        missing = missing | F.col(c).isNull()
    rank = F.when(missing, F.raise_error(F.lit(f"a checkpoint needs {', '.join(order)}"))).otherwise(F.struct(*order))
    return events.groupBy("driver_id", "entity").agg(
        F.max_by(position, rank).alias("position"), F.max_by("detected_at", rank).alias("updated_at")
    )


def positions(state: DataFrame, position: str, updated_at: Column | None = None) -> DataFrame:
    """Positions of any kind (versions, links, tokens, numbers, times) as rows of the checkpoint table."""
    dtype = state.schema[position].dataType
    return state.select(
        "driver_id", "entity", iso_text(position, dtype).alias("position"),
        (updated_at if updated_at is not None else F.current_timestamp()).alias("updated_at"),
    )


def position_of(stored: DataFrame, dtype: T.DataType | str) -> DataFrame:
    """The stored positions of one kind, read back as that type."""
    return stored.withColumn("position", F.col("position").cast(dtype))


def _typed(position: Column, dtype: T.DataType) -> Column:
    """A position as a value of the watermark's type, NULL when it is none; a bare number is not a time."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        position = F.when(position.rlike(r"^[+-]?[0-9]+-[0-9]{2}-[0-9]{2}"), position)
    return position.try_cast(dtype)


def resume(
    df: DataFrame, stored: DataFrame, wm: str, start: datetime | Column | int | str, id_col: str | None = None
) -> DataFrame:
    """Rows after the stored position of their (driver, entity); ``start`` where nothing is stored.

    Positions are read as the type of the watermark (a time, a number or a text), so the comparison is
    not on text unless the watermark is. A position that is no such value is an event id; the source
    resumes after that id in ``id_col``, and without it that is an error, since starting over would repeat rows.
    """
    dtype = df.schema[wm].dataType
    table = stored.select(
        F.col("driver_id").alias("__d"), F.col("entity").alias("__e"), F.col("position").alias("__text"),
        _typed(F.col("position"), dtype).alias("__p"),
    )
    begin = moment(start, dtype) if isinstance(start, (datetime, Column)) else F.lit(start).cast(dtype)
    foreign = F.col("__text").isNotNull() & F.col("__p").isNull()
    if id_col is None:
        after = F.raise_error(F.concat(F.lit("position is no watermark: "), F.col("__text"))).cast("boolean")
    else:
        after = F.col(id_col) > F.col("__text").cast(df.schema[id_col].dataType)
    return (
        lookup(df, table, ["driver_id", "entity"], ["__d", "__e"])
        .filter(F.when(foreign, after).otherwise(F.col(wm) > F.coalesce(F.col("__p"), begin)))
        .drop("__d", "__e", "__text", "__p")
    )


def merge_checkpoints(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Upsert by (driver, entity); the new position wins."""
    both = new.withColumn("__n", F.lit(1))
    if old is not None:
        both = both.unionByName(old.withColumn("__n", F.lit(0)))
    rest = [c for c in new.columns if c not in ("driver_id", "entity")]
    return (
        both.groupBy("driver_id", "entity")
        .agg(F.max_by(F.struct(*rest), "__n").alias("__row"))
        .select("driver_id", "entity", "__row.*")
    )


def save_checkpoints(new: DataFrame, path: str) -> int:
    """Store positions as a new version of the checkpoint table."""
    return write_version(merge_checkpoints(read_version(new.sparkSession, path), new), path)
