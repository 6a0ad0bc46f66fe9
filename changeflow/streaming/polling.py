"""Polled sources: one scan of all entities per interval, with stored watermarks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.values import cold_start
from changeflow.sinks.tables import read_version, write_version
from changeflow.sources.scan import advance_watermark, scan_all
from changeflow.spec import Entity
from changeflow.streaming.micro import write_batch

_STATE = "driver_id string, entity string, since bigint"
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _aware(at: datetime) -> datetime:
    """A naive time is meant in UTC, as everywhere in the settings."""
    return at if at.tzinfo is not None else at.replace(tzinfo=timezone.utc)


def scan_step(
    spark: SparkSession,
    driver_id: str,
    entities: Sequence[Entity],
    load: Callable[[Entity], DataFrame],
    path: str,
    lookback: str = "PT1H",
    now: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> Callable[[int], None]:
    """A scan to hand to ``poll``.

    Scan n writes ``path/changes`` and version n of ``path/watermarks``. An entity without a stored
    watermark starts ``lookback`` before now. Run again, a scan starts from the same watermarks.
    """

    def step(number: int) -> None:
        stored = read_version(spark, f"{path}/watermarks", before=number)
        # One row per configured entity.
        own = stored.filter(F.col("driver_id") == driver_id).select("entity", F.unix_micros("since").alias("at")) if stored else None
        # Microseconds of the epoch: a collected timestamp would be a naive time of this process's zone.
        known = {r["entity"]: _EPOCH + timedelta(microseconds=r["at"]) for r in own.collect() if r["at"] is not None} if own else {}
        start = cold_start(now(), lookback)
        since = {e.name: known.get(e.name) or _aware(start) for e in entities}
        found = scan_all([(e, load(e)) for e in entities], since)
        write_batch(found.withColumns({"driver_id": F.lit(driver_id), "source_ts": F.col("source_ts").cast("timestamp")}),
                    f"{path}/changes", number)
        rows = [(driver_id, name, (_aware(at) - _EPOCH) // timedelta(microseconds=1)) for name, at in since.items()]
        state = spark.createDataFrame(rows, _STATE).withColumn("since", F.timestamp_micros("since"))
        done = spark.read.parquet(f"{path}/changes/v={number}")
        write_version(advance_watermark(done, "source_ts", state), f"{path}/watermarks", number)

    return step
