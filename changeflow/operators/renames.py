"""Commands that rename keys, decided per connected group of keys in one ordered pass.

Keys that renames connect, however indirectly, form a component. Commands on different components cannot affect each other, and within one
they run strictly in order. So components are found first (labels spread and jump, in a number of rounds that grows with the logarithm of the longest
chain of keys), then the rows and commands of each go sorted through one task, which holds the component's live rows and one batch of commands, not
its history.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from changeflow.scratch import shared_path


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of all linked nodes; the component is its smallest node."""
    spark, path = links.sparkSession, shared_path(links.sparkSession, "components")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    one = links.select(F.col(left).alias("u"), F.col(right).alias("v"))
    both = kept(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    label = kept(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.min("u")).alias("component")), "0")
    step = 0
    while True:
        step += 1
        near = both.join(label, F.col("v") == F.col("node")).groupBy(F.col("u").alias("node")).agg(F.min("component").alias("near"))
        seen = label.join(near, "node", "left").select("node", F.col("component").alias("old"), F.least("component", "near").alias("now"))
        jump = label.select(F.col("node").alias("now"), F.col("component").alias("further"))
        moved = seen.join(jump, "now", "left").select("node", "old", F.least("now", "further").alias("component"))
        moved = kept(moved, str(step))
        label = moved.select("node", "component")
        if moved.filter("old <> component").isEmpty():
            return label


class _Fold:
    """The rows of one component, changed by its commands in order."""

    def __init__(self, values: Sequence[str]):
        self.values, self.rows = values, {}

    def apply(self, cmd: dict) -> str | None:
        """Carry a command out, or say why it cannot be."""
        key, new, op, rows = cmd["key"], cmd["new_key"], cmd["operation"], self.rows
        if cmd["error"] is not None:
            return cmd["error"]
        renames = op == "Update" and new is not None and new != key
        if op == "Create" and key in rows or renames and key in rows and new in rows:
            return "already exists"
        if op == "Update" and key not in rows:
            return "not found"
        if op not in ("Create", "Update", "Delete"):
            return f"unknown operation {op}"
        if op == "Delete":
            rows.pop(key, None)
            return None
        given = {c: v for c, v in cmd["values"].items() if (v is not None if cmd["set"] is None else c in cmd["set"])}
        old = dict.fromkeys(self.values) if op == "Create" else rows.pop(key)
        rows[new if renames else key] = old | given
        return None


def fold_components(rows: DataFrame, cmds: DataFrame, key: str, new_key: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows and results of commands whose keys carry a ``component``: the rows afterwards, and one result per command.

    A command says with ``set`` which columns it supplies (without it those that are not NULL), and with ``error`` that it cannot be carried out.
    """
    spark, path = rows.sparkSession, shared_path(rows.sparkSession, "folded")
    values = [c for c in rows.columns if c not in (key, "component")]
    given = F.struct(*[F.col(c).cast(rows.schema[c].dataType).alias(c) for c in values]).alias("values")
    optional = lambda c, kind: F.col(c) if c in cmds.columns else F.lit(None).cast(kind)
    command = F.struct(
        "correlation_id", "operation", F.col(key).alias("key"), F.col(new_key).alias("new_key"), optional("error", "string").alias("error"),
        optional("set", "array<string>").alias("set"), given,
    )
    rank = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    stored = rows.select("component", F.lit(None).cast(_type(cmds, rank)).alias("rank"), F.col(key).alias("key"), given, F.lit(None).cast(_type(cmds, command)).alias("cmd"))
    steps = cmds.select("component", rank.alias("rank"), F.lit(None).cast(rows.schema[key].dataType).alias("key"), F.lit(None).cast(_type(rows, given)).alias("values"), command.alias("cmd"))
    kinds = {c: cmds.schema[c].dataType for c in ("correlation_id", "operation", new_key)}
    out = T.StructType([
        T.StructField("correlation_id", kinds["correlation_id"]), T.StructField("operation", kinds["operation"]), T.StructField("key", rows.schema[key].dataType),
        T.StructField("new_key", kinds[new_key]), T.StructField("success", T.BooleanType()), T.StructField("error_message", T.StringType()),
        T.StructField("values", T.StructType([T.StructField(c, rows.schema[c].dataType) for c in values])),
    ])
    shape = to_arrow_schema(out)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, _Fold(values)
        for batch in batches:
            done: list[dict] = []
            for r in batch.to_pylist():
                if current != (r["component"],):
                    done += _live(state)
                    current, state = (r["component"],), _Fold(values)
                if (cmd := r["cmd"]) is None:
                    state.rows[r["key"]] = r["values"]
                    continue
                fault = state.apply(cmd)
                done.append({n: cmd[n] for n in ("correlation_id", "operation", "key", "new_key")} | {"success": fault is None, "error_message": fault, "values": None})
            yield pa.RecordBatch.from_pylist(done, schema=shape)
        yield pa.RecordBatch.from_pylist(_live(state), schema=shape)

    both = stored.unionByName(steps).repartition("component").sortWithinPartitions("component", F.col("rank").asc_nulls_first())
    both.mapInArrow(fold, out).write.parquet(path)
    folded = spark.read.parquet(path)
    after = folded.filter("success is null").select(F.col("key").alias(key), "values.*").select(key, *values)
    results = folded.filter("success is not null").select(
        "correlation_id", "operation", F.col("key").alias(key), F.col("new_key").alias(new_key), "success", "error_message"
    )
    return after, results


def _live(state: _Fold) -> list[dict]:
    none = dict.fromkeys(("correlation_id", "operation", "new_key", "success", "error_message"))
    return [none | {"key": k, "values": v} for k, v in state.rows.items()]


def _type(df: DataFrame, column) -> T.DataType:
    return df.select(column.alias("c")).schema["c"].dataType
