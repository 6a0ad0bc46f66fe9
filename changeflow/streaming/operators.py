"""Streaming forms of the forward path, write-back, duplicate, echo and heartbeat operators."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.changes import with_history
from changeflow.operators.monitor import heartbeats
from changeflow.operators.writeback import apply_planned, plan_commands
from changeflow.plans.forward import Driver, finish_events, publishable, with_numbers
from changeflow.sinks.checkpoints import checkpoints, merge_checkpoints
from changeflow.sinks.tables import MAX_BYTES, dead_letter_reason, drop_versions, read_version, write_version
from changeflow.streaming.micro import KeyedState, read_batches, run, write_batch
from changeflow.streaming.state import rocksdb, with_accepted, with_newest, without_first


_OWN = "__own"


def _seeded(stream: DataFrame, key: Sequence[str], order: Sequence[str], keep: timedelta | None) -> DataFrame:
    """A stream of raw changes with the last change per key of all earlier micro-batches before a key's own, marked in ``__own``."""
    names = [f"__k{i}" for i in range(len(key))]
    keyed = stream.withColumns({n: F.col(f"row.`{k}`") for n, k in zip(names, key)})
    return with_newest(keyed, ["entity", *names], order, ["source_ts", "row"], _OWN, keep=keep)


def _history(batch: DataFrame, key: Sequence[str], order: Sequence[str], ttl: timedelta | None, hot_rows: int | None) -> DataFrame:
    """Before images and kinds of a micro-batch's own rows."""
    out = with_history(batch, key, [_OWN, *order], hot_rows=hot_rows, ttl=ttl)
    return out.filter(_OWN).drop(_OWN, *[f"__k{i}" for i in range(len(key))])


def _check_interval(keep: timedelta | None, every: str | None) -> None:
    if keep is not None and every is None:
        raise ValueError("a state that expires by the clock needs an interval: pass every")


@contextmanager
def _held(batch: DataFrame):
    """A micro-batch that is read more than once: its stateful part runs once."""
    batch = batch.persist(StorageLevel.DISK_ONLY)
    try:
        yield batch
    finally:
        batch.unpersist()


def track_changes(
    stream: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    path: str,
    ttl: timedelta | None = None,
    every: str | None = None,
    hot_rows: int | None = None,
    keep: timedelta | None = None,
) -> StreamingQuery:
    """Before images and change kinds on a stream of raw changes, the same as in one run over everything.

    ``order`` names columns of the raw change table. The last change per key is kept in Spark's state store until a Delete clears it. With ``ttl`` a
    state older than that, against the change that reads it, counts as absent; with ``keep`` the store also drops it that long after its last
    change. Output: ``path/events``.
    """

    def step(batch: DataFrame, number: int) -> None:
        with _held(batch) as rows:
            write_batch(_history(rows, key, order, ttl, hot_rows), f"{path}/events", number)

    _check_interval(keep, every)
    with rocksdb(stream.sparkSession):
        return run(_seeded(stream, key, order, keep), step, f"{path}/checkpoint", every)


def publish_changes(
    stream: DataFrame,
    driver: Driver,
    key: Sequence[str],
    order: Sequence[str],
    path: str,
    detected_at: Column | None = None,
    max_bytes: int = MAX_BYTES,
    every: str | None = None,
    hot_rows: int | None = None,
    keep: timedelta | None = None,
) -> StreamingQuery:
    """The whole forward path on a stream.

    ``path/events`` gets publishable events and dead letters side by side, in folders by column
    ``outcome``; ``path/checkpoints`` the positions, which also pass dead letters. Sequence numbers
    continue over batches and restarts; ``path/numbers`` has the last one per driver.
    """
    spark = stream.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        known = read_version(spark, f"{path}/numbers", before=number)
        after = known.agg(F.max("seq")).first()[0] if known is not None else None
        with _held(batch) as rows:
            own = with_numbers(rows.filter(_OWN), driver, order, hot_rows)
            rows = own.unionByName(rows.filter(~F.col(_OWN)), allowMissingColumns=True)
            events = finish_events(_history(rows, key, order, None, hot_rows), driver, key, order, detected_at, after or 0, hot_rows)
            marked = publishable(events).withColumn("reason", dead_letter_reason(max_bytes, kind="change_type"))
            marked = marked.withColumn("outcome", F.when(F.col("reason").isNull(), "published").otherwise("dead_lettered"))
            marked.write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/events/v={number}")
        done = spark.read.parquet(f"{path}/events/v={number}")
        last = done.groupBy("driver_id").agg(F.max("seq").alias("seq"))
        last = last if known is None else last.unionByName(known).groupBy("driver_id").agg(F.max("seq").alias("seq"))
        write_version(last, f"{path}/numbers", number)
        old = read_version(spark, f"{path}/checkpoints", before=number)
        write_version(merge_checkpoints(old, checkpoints(done)), f"{path}/checkpoints", number)
        for table in ("numbers", "checkpoints"):
            drop_versions(spark, f"{path}/{table}", number - 1)

    _check_interval(keep, every)
    with rocksdb(spark):
        return run(_seeded(stream, key, order, keep), step, f"{path}/checkpoint", every)


class CommandTable:
    """A table that write commands change batch by batch, kept as a keyed state with marks for deleted rows."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str]):
        self.key = list(key)
        self.state = KeyedState(spark, path, key)

    def load(self, rows: DataFrame) -> None:
        self.state.load(rows.withColumn("__gone", F.lit(False)))

    def read(self, before: int = 2**62, keys: DataFrame | None = None) -> DataFrame:
        """The rows, as they were before a batch; of the given keys or all."""
        rows = self.state.before(before, keys)
        if rows is None:
            raise ValueError(f"no rows were loaded into {self.state.path}")
        return rows.filter("not __gone").drop("__gone")

    def write(self, after: DataFrame, touched: DataFrame, batch: int) -> None:
        """Store the rows of the touched keys; touched keys without a row are deleted."""
        rows = after.withColumn("__gone", F.lit(False))
        keys = touched.select(*self.key).distinct().join(after.select(*self.key), self.key, "left_anti")
        gone = keys.withColumn("__gone", F.lit(True))
        self.state.write(rows.unionByName(gone, allowMissingColumns=True), batch, live="not __gone")


def apply_command_stream(
    stream: DataFrame, table: CommandTable, order: Sequence[str], path: str,
    types: Sequence[str] | None = None, every: str | None = None, hot_rows: int | None = None,
) -> StreamingQuery:
    """Write commands on a stream, applied to a table; ``path/results`` gets the commands with their results.

    A batch reads and writes only the rows its commands name.
    """
    spark = stream.sparkSession
    key = table.key

    def step(batch: DataFrame, number: int) -> None:
        current = table.read(number, batch)
        write_batch(plan_commands(current, batch, key, order, types, hot_rows), f"{path}/results", number)
        planned = spark.read.parquet(f"{path}/results/v={number}")
        table.write(apply_planned(current, planned, key, order), planned, number)

    return run(stream, step, f"{path}/checkpoint", every)


def dedup_stream(
    stream: DataFrame,
    request: str,
    ts: str,
    path: str,
    ttl: timedelta = timedelta(minutes=5),
    tie: Sequence[str] = (),
    every: str | None = None,
    keep: timedelta | None = None,
) -> StreamingQuery:
    """Idempotent intake on a stream: ``path/requests`` gets every row with ``duplicate``.

    The last accepted time per request id is the state, kept in Spark's state store; a row that arrives after a later accepted
    one is a duplicate. The store finds the accepted times, the first row in ``tie`` of each is accepted.
    ``drop_within_watermark`` is the cheaper built-in form.
    """
    rows = stream.withColumn("__at", F.unix_micros(F.col(ts).cast("timestamp")))

    def step(batch: DataFrame, number: int) -> None:
        with _held(batch) as held:
            accepted = held.filter("__accepted").select(F.col(request).alias("__r"), F.col("__at").alias("__t"))
            own = held.filter("not __accepted").drop("__accepted")
            first = F.row_number().over(Window.partitionBy(request, "__at").orderBy(*tie or ["__at"]))
            joined = own.withColumn("__n", first).join(accepted, F.col(request).eqNullSafe(F.col("__r")) & (F.col("__at") == F.col("__t")), "left")
            taken = F.col("__t").isNotNull() & (F.col("__n") == 1)
            write_batch(joined.withColumn("duplicate", ~taken).drop("__r", "__t", "__n", "__at"), f"{path}/requests", number)

    _check_interval(keep, every)
    with rocksdb(stream.sparkSession):
        return run(with_accepted(rows, request, "__at", "__accepted", ttl, keep), step, f"{path}/checkpoint", every)


def drop_within_watermark(stream: DataFrame, request: str, ts: str, ttl: str = "5 minutes") -> DataFrame:
    """First row per request id, remembered for at least ``ttl`` of event time."""
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark([request])


def suppress_echo_stream(
    stream: DataFrame, sessions: DataFrame, order: Sequence[str], path: str,
    session: str = "replica_session", every: str | None = None, keep: timedelta | None = None,
) -> StreamingQuery:
    """Echo suppression on a stream: the first change of each session that an applied command opened is dropped, once. Output: ``path/changes``.

    ``sessions`` is a stream too, so that sessions open while the query runs, or a table of sessions that are open from the start.
    Which are open, and which used up, is kept in Spark's state store. Session names ignore case.
    """
    _check_interval(keep, every)
    with rocksdb(stream.sparkSession):
        kept = without_first(stream, sessions, session, order, keep)
        return run(kept, lambda df, n: write_batch(df, f"{path}/changes", n), f"{path}/checkpoint", every)


def heartbeat_stream(
    stream: DataFrame, path: str, size: str = "30 seconds", ts: str = "ts", every: str | None = None
) -> StreamingQuery:
    """Each batch's share of the heartbeat windows; ``read_heartbeats`` adds the shares up.

    There is no watermark: a row that comes late is counted in its own window, however late it is.
    """
    return run(stream, lambda df, n: write_batch(heartbeats(df, size, ts), f"{path}/windows", n), f"{path}/checkpoint", every)


def read_heartbeats(spark: SparkSession, path: str) -> DataFrame:
    """The heartbeat windows over all batches."""
    rows = read_batches(spark, f"{path}/windows")
    return rows.groupBy("window_start", "window_end", "driver_id").agg(
        F.sum("events").alias("events"), F.max("last_event_at").alias("last_event_at")
    )
