"""Running values: plain and split form against a plain Python loop, with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators import ordered


def make_rows(n=600, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "c", None, "d"])
        rows.append((key, rnd.randrange(8), i, rnd.choice([None, 1, 2, 3]), rnd.randrange(5)))
    rnd.shuffle(rows)
    return rows


def expected(rows):
    state, out = {}, {}
    for key, t, i, mark, n in sorted(rows, key=lambda r: (r[1], r[2])):
        prev, last, total, count = state.get(key, (None, None, 0, 0))
        out[i] = (prev, last, total, count + 1)
        state[key] = (mark, last if mark is None else mark, total + n, count + 1)
    return out


@pytest.mark.parametrize("hot_rows", [None, 0, 100])
@pytest.mark.parametrize("parts", [1, 7])
def test_running(spark, hot_rows, parts):
    rows = make_rows()
    df = spark.createDataFrame(rows, "key string, t int, i int, mark int, n int").repartition(parts)
    out = ordered.running(
        df, ["key"], ["t", F.col("i")], previous={"prev": "mark"}, last={"last": F.col("mark") + 0}, total={"total": "n"}, hot_rows=hot_rows
    )
    assert out.columns == ["key", "t", "i", "mark", "n", "prev", "last", "total"]
    out = ordered.numbered(out, ["key"], ["t", "i"], "seq", hot_rows=hot_rows)
    got = {r.i: (r.prev, r.last, r.total, r.seq) for r in out.collect()}
    assert got == expected(rows)


def test_one_group_in_all(spark):
    df = spark.range(5000).select(F.lit("x").alias("key"), F.col("id"))
    out = ordered.numbered(df, ["key"], ["id"], "seq", hot_rows=10)
    assert out.filter("seq <> id + 1").count() == 0
    assert out.agg(F.max("seq")).first()[0] == 5000


def test_hot_groups_are_found(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"))
    found = ordered.hot_groups(df, ["key"], 5_000)
    assert list(found.values()) == [10_000]
    assert ordered.hot_groups(df, ["key"]) == {}  # a small input is not measured


def test_every_hot_group_is_found(spark, monkeypatch):
    df = spark.range(9_000).select((F.col("id") % 3_000).alias("key"))
    assert len(ordered.hot_groups(df, ["key"], 2)) == 3_000
    wide = spark.range(3_000).select((F.col("id") % 30).alias("key"), F.when(F.col("id") % 30 == 7, F.repeat(F.lit("x"), 5_000)).alias("text"))
    monkeypatch.setattr(ordered, "small", lambda df: False)
    monkeypatch.setattr(ordered, "HOT_BYTES", 100_000)
    assert list(ordered.hot_groups(wide, ["key"]).values()) == [100]


def test_no_row_values_are_broadcast(spark):
    df = spark.range(2_000).select(F.lit(1).alias("key"), "id", F.struct("id").alias("row"))
    out = ordered.running(df, ["key"], ["id"], previous={"p": "row"}, hot_rows=0)
    assert "broadcast" not in out._jdf.queryExecution().optimizedPlan().toString().lower()


def test_split_spreads_the_hot_group(spark):
    """No partition of the split form holds the whole group, and numbering moves its rows once."""
    df = spark.range(8_000).select(F.lit(1).alias("key"), "id")
    calm, rows = ordered._apart(df, ["key"], ["id"], ordered.hot_groups(df, ["key"], 0))
    assert calm.count() == 0
    sizes = [r["count"] for r in rows.groupBy("__part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2_000 and sum(sizes) == 8_000
    plan = ordered.numbered(df, ["key"], ["id"], "seq", hot_rows=0).filter("seq > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1  # only the small carry table: the calm side is empty by its constant key


def test_shared_shuffle(spark):
    """Two passes over the same key and order plan one shuffle."""
    df = spark.range(100).select((F.col("id") % 5).alias("key"), "id")
    once = ordered.running(df, ["key"], ["id"], previous={"p": "id"})
    twice = ordered.running(once, ["key"], ["id"], total={"s": "id"})
    plan = twice._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_many_hot_groups_stay_in_a_table(spark):
    """Every key above a low threshold: the plan does not name them all, and the values are those of a plain window."""
    df = spark.range(9_000).select((F.col("id") % 3_000).alias("key"), "id")
    out = ordered.running(df, ["key"], ["id"], previous={"p": "id"}, hot_rows=2)
    assert " INSET " not in out._jdf.queryExecution().optimizedPlan().toString()
    want = ordered.running(df, ["key"], ["id"], previous={"p": "id"})
    assert out.exceptAll(want).count() == 0 and out.count() == 9_000
    assert isinstance(ordered.measured(df, ["key"], 2), ordered.HotTable)
    mixed = df.filter("key < 1500 or id < 3000")  # half of the keys stay below the threshold
    assert ordered.numbered(mixed, ["key"], ["id"], "n", hot_rows=2).groupBy("n").count().orderBy("n").collect() == [(1, 3_000), (2, 1_500), (3, 1_500)]
