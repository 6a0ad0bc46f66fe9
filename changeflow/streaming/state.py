"""Values per key in Spark's own state store (RocksDB), for the streaming operators.

The store keeps one value per key and is read and committed with its micro-batch. Rows only pass through: what needs order inside a
micro-batch is left to the batch operators, which split a hot key. A processor holds one or two rows of a key at a time, or the different times of a request
id in one micro-batch, which the trigger bounds. A value may be given a time to live in processing time (``keep``), after which the store drops it; such a query runs on by the clock and needs an interval.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Rows without a key share no state; they are dealt to so many groups.
NO_KEY_GROUPS = 1024
# The newest rows lie in maps by key, one map for all keys of a slot: a call of the processor costs more than a key does.
KEY_SLOTS = 512


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; a query takes the setting when it starts."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def place(values: Sequence[Any]) -> tuple:
    """Order columns as something Python compares the way Spark sorts: nulls first, NaN last."""
    return tuple((0,) if v is None else (2,) if isinstance(v, float) and v != v else (1, v) for v in values)


def _stateful(rows: DataFrame, key: Sequence[str], processor: StatefulProcessor, out: T.StructType, keep: timedelta | None) -> DataFrame:
    return rows.groupBy(*key).transformWithState(processor, out, "append", "processingTime" if keep else "none")


class _Value(StatefulProcessor):
    """One value per key, dropped ``keep`` after its last change."""

    def __init__(self, schema: T.StructType, keep: timedelta | None):
        self.schema, self.keep_ms = schema, int(keep.total_seconds() * 1000) if keep else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("value", self.schema, self.keep_ms)

    def stored(self) -> tuple | None:
        return self.value.get() if self.value.exists() else None

    def close(self) -> None:
        pass


def _same(value: Any) -> Any:
    """A key value as Spark groups it (one zero, one NaN)."""
    return (float("nan") if value != value else value + 0.0) if isinstance(value, float) else value


def _hashable(value: Any) -> Any:
    if isinstance(value, dict):
        return tuple((n, _hashable(v)) for n, v in value.items())
    if isinstance(value, (list, tuple)):
        return tuple(_hashable(v) for v in value)
    return ("NaN",) if isinstance(value, float) and value != value else value


class _Newest(StatefulProcessor):
    """The newest row per key of the keys of one slot, given out when the key has rows again; a row of an ending kind clears it."""

    def __init__(self, key: Sequence[str], keys: T.StructType, schema: T.StructType, order: Sequence[str], kind: str, ends: str, keep: timedelta | None):
        self.key, self.keys, self.schema, self.order, self.kind, self.ends = list(key), keys, schema, list(order), kind, ends
        self.keep_ms = int(keep.total_seconds() * 1000) if keep else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getMapState("value", self.keys, self.schema, self.keep_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        newest: dict[Any, tuple] = {}
        for row in rows:
            own, rank = tuple(_same(row[c]) for c in self.key), place([row[c] for c in self.order])
            known = newest.get(name := _hashable(own))
            if known is None or rank >= known[0]:
                newest[name] = rank, own, row
        for _, own, row in newest.values():
            stored = self.value.getValue(own)
            if stored is not None:
                yield Row(**dict(zip(self.schema.names, stored)))
            if row[self.kind] != self.ends:
                self.value.updateValue(own, tuple(row[n] for n in self.schema.names))
            elif stored is not None:
                self.value.removeKey(own)

    def close(self) -> None:
        pass


def with_newest(
    stream: DataFrame, key: Sequence[str], order: Sequence[str], stored: Sequence[str], flag: str,
    kind: str = "change_type", ends: str = "Delete", keep: timedelta | None = None,
) -> DataFrame:
    """The rows of a stream with ``flag`` true, and per key and micro-batch the newest row of all earlier batches with ``flag`` false.

    Of the newest row the ``stored`` columns are kept, the others are null. The rows themselves go beside the store, not through it, so
    both read the same source rows: columns of the stream must follow from them, not from chance.
    """
    own = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema if f.name in {*key, *order, *stored, kind}])
    keys = T.StructType([T.StructField(n, stream.schema[n].dataType) for n in key])
    slots = stream.select(*own.names, F.pmod(F.xxhash64(*key), F.lit(KEY_SLOTS)).alias("__slot"))
    newest = _stateful(slots, ["__slot"], _Newest(key, keys, own, order, kind, ends, keep), own, keep)
    return stream.withColumn(flag, F.lit(True)).unionByName(newest.withColumn(flag, F.lit(False)), allowMissingColumns=True)


class _Accepted(_Value):
    """All rows, and one row more per accepted time; the last of them is the state."""

    def __init__(self, names: Sequence[str], key: str, at: str, flag: str, micros: int, keep: timedelta | None):
        super().__init__(T.StructType([T.StructField("at", T.LongType())]), keep)
        self.names, self.key, self.at, self.flag, self.micros = list(names), key, at, flag, micros

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        stored = self.stored()
        last, times = (stored[0] if stored else None), set()
        for row in rows:
            if row[self.at] is not None:
                times.add(row[self.at])  # different times of one id in one micro-batch
            yield Row(**{n: row[n] for n in self.names}, **{self.flag: False})
        for at in sorted(times):
            if last is None or at - last >= self.micros:
                last = at
                yield Row(**(dict.fromkeys(self.names) | {self.key: key[0], self.at: at}), **{self.flag: True})
        if last is not None:
            self.value.update((last,))


def with_accepted(stream: DataFrame, key: str, at: str, flag: str, ttl: timedelta, keep: timedelta | None = None) -> DataFrame:
    """The rows of a stream with ``flag`` false, and a row (key, at) with ``flag`` true for every time accepted.

    ``at`` is in microseconds. A time is accepted when it is ``ttl`` or more after the last accepted one of its key, in this batch or before.
    """
    out = T.StructType([*(T.StructField(f.name, f.dataType) for f in stream.schema), T.StructField(flag, T.BooleanType())])
    return _stateful(stream, [key], _Accepted(stream.columns, key, at, flag, int(ttl.total_seconds() * 1_000_000), keep), out, keep)


class _DropFirst(_Value):
    """Of an opened key the first row is dropped, once; openings come as rows of the same stream."""

    def __init__(self, names: Sequence[str], order: Sequence[str], opens: str, keep: timedelta | None):
        super().__init__(T.StructType([T.StructField("used", T.BooleanType())]), keep)
        self.names, self.order, self.opens = list(names), list(order), opens

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        stored = self.stored()
        opened, used = stored is not None, stored is not None and stored[0]
        first, at = None, None
        for row in rows:
            if row[self.opens]:
                opened = True
                continue
            if used or key[0] is None:
                yield Row(**{n: row[n] for n in self.names})
                continue
            rank = place([row[c] for c in self.order])
            if first is not None and rank >= at:
                yield Row(**{n: row[n] for n in self.names})
                continue
            if first is not None:
                yield Row(**{n: first[n] for n in self.names})
            first, at = row, rank
        if first is not None and not opened:
            yield Row(**{n: first[n] for n in self.names})
        if opened and not used and (stored is None or first is not None):
            self.value.update((first is not None,))


def without_first(stream: DataFrame, opened: DataFrame, key: str, order: Sequence[str], keep: timedelta | None = None) -> DataFrame:
    """A stream without the first row of each opened key, once per key.

    ``opened`` is a stream of keys, or a table of them, which counts as opened before the first batch. An opening counts for the
    rows of its own micro-batch and later ones. Rows without key stay.
    """
    names, spread = stream.columns, F.pmod(F.xxhash64(*[c for c in stream.columns if not isinstance(stream.schema[c].dataType, (T.MapType, T.VariantType))]), F.lit(NO_KEY_GROUPS))

    def grouped(df: DataFrame, opens: Column) -> DataFrame:
        return df.withColumns({"__key": F.lower(F.col(key).cast("string")), "__opens": opens})

    rows = grouped(stream, F.lit(False)).withColumn("__spread", F.when(F.col("__key").isNull(), spread))
    keys = grouped(opened.select(key), F.lit(True)).filter("__key is not null")
    processor, out = _DropFirst(names, order, "__opens", keep), T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
    mode = "processingTime" if keep else "none"
    if not opened.isStreaming:
        known = keys.select("__key", F.lit(None).cast("int").alias("__spread")).distinct()
        return rows.groupBy("__key", "__spread").transformWithState(_Opened(names, order, "__opens", keep), out, "append", mode, known.groupBy("__key", "__spread"))
    both = rows.unionByName(keys.select("__key", "__opens"), allowMissingColumns=True)
    return both.groupBy("__key", "__spread").transformWithState(processor, out, "append", mode)


class _Opened(_DropFirst):
    """Keys that are opened before the first micro-batch."""

    def handleInitialState(self, key: Any, initialState: Any, timerValues: Any) -> None:
        self.value.update((False,))
