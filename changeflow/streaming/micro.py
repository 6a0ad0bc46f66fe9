"""Micro-batch runs with exactly-once output folders and state tables.

A micro-batch is a bounded DataFrame, so the batch operators run on it unchanged, with the same
protection against one huge key. Every batch writes its output and its state change under its own
batch number; a batch that is run again after a failure overwrites its own folders only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.scratch import remove
from changeflow.sinks.tables import drop_versions, newest_version, versions

Step = Callable[[DataFrame, int], None]


def run(
    stream: DataFrame, step: Step, checkpoint: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Start a query; without ``every`` it takes what is available now and stops."""
    writer = stream.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def poll(spark: SparkSession, scan: Callable[[int], None], checkpoint: str, every: str = "30 seconds") -> StreamingQuery:
    """Run a scan of a polled source every interval, for ever; a rate source is the clock."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return run(clock, lambda _, batch: scan(batch), checkpoint, every)


def write_batch(df: DataFrame, path: str, batch: int) -> None:
    """Output of one micro-batch, in its own folder."""
    df.write.mode("overwrite").parquet(f"{path}/v={batch}")


def read_batches(
    spark: SparkSession, path: str, before: int | None = None, after: int | None = None
) -> DataFrame | None:
    """Completed batches in (after, before), with their number in column ``v``."""
    known = versions(spark, path, before, after)
    if not known:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path}/v={v}" for v in known])


class KeyedState:
    """The newest row per key as a base table plus one small change set per micro-batch.

    Every ``compact_every`` batches they are folded into a new base. Both lie in folders by a hash of the
    key: a read for some keys opens only the folders these keys fall into.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], compact_every: int = 20, buckets: int = 16):
        self.spark, self.path, self.key, self.compact_every, self.buckets = spark, path, list(key), compact_every, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.key]), F.lit(self.buckets)).cast("int")

    def _store(self, rows: DataFrame, folder: str) -> None:
        """Write rows by bucket. An extra folder without rows keeps the schema when there are none; the mark of a complete write comes last."""
        path = f"{self.path}/{folder}"
        remove(self.spark, path)
        self.spark.createDataFrame([], rows.schema).write.parquet(f"{path}/__b=-1")
        rows.withColumn("__b", self._bucket()).hint("rebalance", "__b").write.mode("append").partitionBy("__b").parquet(path)

    def before(self, batch: int, keys: DataFrame | None = None) -> DataFrame | None:
        """State as it was before a batch, of the given keys or of all."""
        return self._read(batch, newest_version(self.spark, f"{self.path}/base", batch), keys)

    def _read(self, batch: int, start: int | None, keys: DataFrame | None = None) -> DataFrame | None:
        changes = read_batches(self.spark, f"{self.path}/delta", batch, start)
        base = None
        if start is not None:
            base = self.spark.read.parquet(f"{self.path}/base/v={start}").withColumn("v", F.lit(start))
        parts = [p for p in (base, changes) if p is not None]
        if not parts:
            return None
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if keys is not None:
            # At most one number per bucket comes to the driver; the filter prunes folders.
            wanted = [r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect()]
            both = both.filter(F.col("__b").isin(wanted))
            here = keys.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(self.key)]).distinct()
            on = [F.col(k).eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(self.key)]
            both = both.join(here, on, "left_semi")
        newest = Window.partitionBy(*self.key).orderBy(F.desc("v"))
        return both.drop("__b").withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n", "v")

    def load(self, rows: DataFrame) -> None:
        """Begin with given rows, one per key, as the base before the first batch."""
        self._store(rows, "base/v=-1")

    def write(self, changes: DataFrame, batch: int, live: str | None = None) -> None:
        """Store a batch's changed keys; ``live`` is the condition under which a row is kept for good.

        After folding, what the base before the new one already covers is deleted: a batch that is
        run again never reads further back than that.
        """
        self._store(changes, f"delta/v={batch}")
        if (batch + 1) % self.compact_every == 0:
            older = newest_version(self.spark, f"{self.path}/base", batch)
            state = self._read(batch + 1, older)
            self._store(state.filter(live) if live else state, f"base/v={batch}")
            if older is not None:
                drop_versions(self.spark, f"{self.path}/delta", older + 1)
                drop_versions(self.spark, f"{self.path}/base", older)
