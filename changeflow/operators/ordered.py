"""Running values over ordered groups that stay parallel when one group is huge.

A window function sends a whole group to one task. That is fine for ordinary keys, but a key that
holds a large share of the rows would make one task do most of the work. So groups are measured
first: rows and bytes per key hash, counted exactly and summed before the shuffle, name the groups
above ``HOT_ROWS`` rows or ``HOT_BYTES`` bytes. All other groups take the plain window. The hot ones are range-partitioned by
(key, order), written once to the shared folder with a row position, and computed per partition;
the partitions are then stitched with a carry table of one row per (key, partition).

Both ways give the same values; the measurement only decides how a group is computed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.scratch import shared_path, small

HOT_ROWS = 5_000_000
HOT_BYTES = 1 << 30

_POS, _PART, _HASH = "__pos", "__part", "__hash"

ColumnLike = Column | str
# So many hot groups are named in a filter; more stay in a table.
LISTED = 1_000


@dataclass(frozen=True)
class HotTable:
    """Many hot groups: a written table of their key hashes, and how many rows they hold."""

    path: str
    rows: int


# A threshold in rows (None: the default), or groups that were measured already.
Hot = int | dict[int, int] | HotTable | None


def hot_groups(df: DataFrame, key: Sequence[ColumnLike], hot_rows: int | None = None) -> dict[int, int]:
    """Key hash → rows of every group above ``hot_rows`` rows (default HOT_ROWS, or HOT_BYTES bytes).

    Without an explicit threshold small inputs are not measured: they cannot hold a large group. The
    groups found are at most the table's size divided by the limit. At a low threshold they may be as many as the keys; ``measured`` keeps them in a table then.
    """
    large = _large(df, key, hot_rows)
    return {} if large is None else {r[_HASH]: r["rows"] for r in large.collect()}


def measured(df: DataFrame, key: Sequence[ColumnLike], hot_rows: Hot = None) -> dict[int, int] | HotTable:
    """``hot_groups`` for the passes: above ``LISTED`` groups only a table of them is kept. Several passes over the same key can share one by passing it on."""
    if isinstance(hot_rows, (dict, HotTable)):
        return hot_rows
    if hot_rows is None:
        return hot_groups(df, key)
    spark, path = df.sparkSession, shared_path(df.sparkSession, "hot")
    _large(df, key, hot_rows).write.parquet(path)
    large = spark.read.parquet(path)
    groups, rows = large.agg(F.count(F.lit(1)), F.sum("rows")).first()
    return HotTable(path, rows) if groups > LISTED else {r[_HASH]: r["rows"] for r in large.collect()}


def _large(df: DataFrame, key: Sequence[ColumnLike], hot_rows: int | None) -> DataFrame | None:
    """(key hash, rows) of the hot groups; None for a small input without a threshold."""
    if hot_rows is None and small(df):
        return None
    columns = [F.xxhash64(*key).alias(_HASH)] + ([_row_bytes(df.schema).alias("__bytes")] if hot_rows is None else [])
    groups = df.select(*columns).groupBy(_HASH)
    if hot_rows is not None:
        large = groups.agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > hot_rows)
    else:
        large = groups.agg(F.count(F.lit(1)).alias("rows"), F.sum("__bytes").alias("bytes")).filter(
            (F.col("rows") > HOT_ROWS) | (F.col("bytes") > HOT_BYTES)
        )
    return large.select(_HASH, "rows")


def _row_bytes(schema: T.StructType) -> Column:
    """About how many bytes a row takes: the lengths of its texts, and a fixed size for everything else."""
    fixed, texts = 0, []

    def visit(field_type: T.DataType, value: Column) -> None:
        nonlocal fixed
        if isinstance(field_type, (T.StringType, T.BinaryType)):
            texts.append(F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint"))
        elif isinstance(field_type, T.StructType):
            for f in field_type.fields:
                visit(f.dataType, value.getField(f.name))
        elif isinstance(field_type, (T.ArrayType, T.MapType)):
            texts.append(F.greatest(F.size(value), F.lit(0)).cast("bigint") * 32)
        else:
            fixed += 8

    for f in schema.fields:
        visit(f.dataType, F.col(f"`{f.name}`"))
    total = F.lit(fixed).cast("bigint")
    for t in texts:
        total = total + t
    return total


@dataclass(frozen=True)
class Step:
    """Values over the earlier rows of a group, in ascending order, and columns derived from them.

    ``previous``: the value in the row just before. ``last``: the most recent non-null value.
    ``total``: the sum (0 before the first row). ``derive``: further columns, which may use the
    values and which later steps may use.
    """

    previous: Mapping[str, ColumnLike] = field(default_factory=dict)
    last: Mapping[str, ColumnLike] = field(default_factory=dict)
    total: Mapping[str, ColumnLike] = field(default_factory=dict)
    derive: Mapping[str, Column] = field(default_factory=dict)


def running(
    df: DataFrame,
    key: Sequence[ColumnLike],
    order: Sequence[ColumnLike],
    previous: Mapping[str, ColumnLike] | None = None,
    last: Mapping[str, ColumnLike] | None = None,
    total: Mapping[str, ColumnLike] | None = None,
    hot_rows: Hot = None,
) -> DataFrame:
    """One ``Step`` over each group."""
    return running_steps(df, key, order, [Step(previous or {}, last or {}, total or {})], hot_rows)


def running_steps(
    df: DataFrame, key: Sequence[ColumnLike], order: Sequence[ColumnLike], steps: Sequence[Step], hot_rows: Hot = None
) -> DataFrame:
    """Steps one after the other over the same groups in the same order, with one shuffle.

    ``order`` must be unique within a group for repeatable results. Columns given by name are used
    in place, so that calls on the same key share a shuffle and wide rows are not copied.
    """
    made: dict[str, Column] = {}
    keys, orders = _names(df, key, "__k", made), _names(df, order, "__o", made)
    columns = [*df.columns, *(n for s in steps for n in (*s.previous, *s.last, *s.total, *s.derive))]
    wide = df.withColumns(made)
    hot = measured(wide, keys, hot_rows)
    if not hot:
        return _plain_steps(wide, keys, orders, steps).select(*columns)
    calm, rows = _apart(wide, keys, orders, hot)
    for step in steps:
        rows = _split_step(rows, keys, step).withColumns(dict(step.derive))
    return _plain_steps(calm, keys, orders, steps).select(*columns).unionByName(rows.select(*columns))


def _names(df: DataFrame, values: Sequence[ColumnLike], prefix: str, made: dict[str, Column]) -> list[str]:
    """Column names of the values; those that are no plain column are added to ``made``."""
    out = []
    for i, v in enumerate(values):
        if isinstance(v, str) and v in df.columns:
            out.append(v)
        else:
            made[f"{prefix}{i}"] = F.col(v) if isinstance(v, str) else v
            out.append(f"{prefix}{i}")
    return out


def _values(df: DataFrame, step: Step):
    """The step's inputs as columns of the table: (table, previous, last, total) by result name."""
    made: dict[str, Column] = {}
    groups = zip((step.previous, step.last, step.total), ("__p", "__l", "__t"))
    named = [dict(zip(g, _names(df, list(g.values()), p, made))) for g, p in groups]
    return df.withColumns(made), *named


def _plain_steps(df, keys, orders, steps):
    for step in steps:
        df, previous, last, total = _values(df, step)
        df = _plain(df, keys, orders, previous, last, total).withColumns(dict(step.derive))
    return df


def numbered(
    df: DataFrame, key: Sequence[ColumnLike], order: Sequence[ColumnLike], name: str, hot_rows: Hot = None
) -> DataFrame:
    """Number the rows of each group 1, 2, 3 … in order.

    In a hot group the number follows from the row's position, so its rows move only once.
    """
    made: dict[str, Column] = {}
    keys, orders = _names(df, key, "__k", made), _names(df, order, "__o", made)
    columns = [*(c for c in df.columns if c != name), name]
    wide = df.withColumns(made)
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*orders)).cast("bigint")
    hot = measured(wide, keys, hot_rows)
    if not hot:
        return wide.withColumn(name, plain).select(*columns)
    calm, rows = _apart(wide, keys, orders, hot)
    ends = rows.groupBy(*keys, _PART).agg(F.count(F.lit(1)).alias("__n"), F.min(_POS).alias("__first"))
    rows = rows.join(*_carried(ends, keys, {"__before": F.sum("__n")}, ["__first"]), "left").withColumn(
        name, F.coalesce("__before", F.lit(0)) + F.col(_POS) - F.col("__first") + 1
    )
    return calm.withColumn(name, plain).select(*columns).unionByName(rows.select(*columns))


def _plain(df, keys, orders, previous, last, total):
    window = Window.partitionBy(*keys).orderBy(*orders)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns(
        {n: F.lag(v).over(window) for n, v in previous.items()}
        | {n: F.last(F.col(v), ignorenulls=True).over(before) for n, v in last.items()}
        | {n: F.coalesce(F.sum(v).over(before), F.lit(0)) for n, v in total.items()}
    )


def _apart(df, keys, orders, hot):
    """Rows of ordinary groups, and rows of hot groups written in order with their position."""
    spark = df.sparkSession
    if isinstance(hot, HotTable):
        table, hashed = spark.read.parquet(hot.path).select(_HASH), df.withColumn(_HASH, F.xxhash64(*keys))
        inside, outside = (hashed.join(table, _HASH, how).select(*df.columns) for how in ("left_semi", "left_anti"))
        total = hot.rows
    else:
        is_hot = F.xxhash64(*keys).isin(list(hot))
        inside, outside, total = df.filter(is_hot), df.filter(~is_hot), sum(hot.values())
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // HOT_ROWS))
    path = shared_path(spark, "ordered")
    # monotonically_increasing_id is (partition << 33) + row; writing it out fixes it for good.
    (
        inside.repartitionByRange(parts, *keys, *orders)
        .sortWithinPartitions(*keys, *orders)
        .withColumn(_POS, F.monotonically_increasing_id())
        .write.parquet(path)
    )
    return outside, spark.read.parquet(path).withColumn(_PART, F.shiftright(_POS, 33))


def _carried(ends, keys, values, keep=()):
    """For a join on (key, partition): what the earlier partitions of the key amount to.

    The table has one row per range partition and hot group in it; its rows may be wide, so Spark decides by its
    measured size whether it is broadcast.
    """
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        *[F.col(k).alias(f"__c{i}") for i, k in enumerate(keys)],
        F.col(_PART).alias("__cpart"),
        *keep,
        *[v.over(earlier).alias(n) for n, v in values.items()],
    )
    same = F.col(_PART) == F.col("__cpart")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__c{i}"))
    return carry, same


def _split_step(rows, keys, step):
    """One step inside each (key, partition), then what earlier partitions of the key carry over."""
    columns = rows.columns
    rows, previous, last, total = _values(rows, step)
    # A preceding value may be NULL, so it travels in a struct; then it is a last non-null value.
    boxes = {f"__b{i}": F.struct(F.col(v).alias("v")) for i, v in enumerate(previous.values())}
    rows = rows.withColumns(boxes)
    last = dict(zip((f"__x{i}" for i in range(len(boxes))), boxes)) | last

    inside = _plain(rows, [*keys, _PART], [_POS], {}, last, total)
    ends = rows.groupBy(*keys, _PART).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col(_POS))).alias(f"__e{n}") for n, v in last.items()],
        *[F.sum(v).alias(f"__e{n}") for n, v in total.items()],
    )
    values = {f"__c{n}": F.last(F.col(f"__e{n}"), ignorenulls=True) for n in last}
    values |= {f"__c{n}": F.sum(f"__e{n}") for n in total}
    joined = inside.join(*_carried(ends, keys, values), "left").withColumns(
        {n: F.coalesce(F.col(n), F.col(f"__c{n}")) for n in last}
        | {n: F.col(n) + F.coalesce(F.col(f"__c{n}"), F.lit(0)) for n in total}
    )
    named = joined.withColumns({n: F.col(f"__x{i}.v") for i, n in enumerate(previous)})
    return named.select(*columns, *step.previous, *step.last, *step.total)
