"""Commands applied by Spark against the same commands applied one by one in Python."""

import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators import routing, writeback
from changeflow.spec import Target

COLUMNS = "k string, a int, b string"


def by_hand(table, cmds):
    rows = {r[0]: list(r[1:]) for r in table}
    results = {}
    for cid, op, key, new_key, a, b, names in cmds:
        message = None
        if op == "Create":
            if key in rows:
                message = "already exists"
            else:
                rows[key] = [None, None]
        elif op == "Update":
            if key not in rows:
                message = "not found"
            elif new_key is not None and new_key != key and new_key in rows:
                message = "already exists"
        elif op == "Delete":
            rows.pop(key, None)
        else:
            message = f"unknown operation {op}"
        if message is None and op in ("Create", "Update"):
            for i, (name, value) in enumerate((("a", a), ("b", b))):
                if name in names:
                    rows[key][i] = value
            if op == "Update" and new_key is not None and new_key != key:
                rows[new_key] = rows.pop(key)
        results[cid] = message
    return {(k, *v) for k, v in rows.items()}, results


def make(seed, n=150, renames=False):
    rnd = random.Random(seed)
    keys = ["hot"] * 4 + list("abcdef")
    table = [(k, rnd.randrange(9), "old") for k in ("hot", "a", "b", "z")]
    cmds = []
    for i in range(n):
        op = rnd.choice(["Create", "Update", "Update", "Update", "Delete"] + (["Rename"] if rnd.random() < 0.02 else []))
        names = [c for c in ("a", "b") if rnd.random() < 0.6]
        new = rnd.choice(keys) if renames and op == "Update" and rnd.random() < 0.15 else None
        cmds.append((f"c{i:04d}", op, rnd.choice(keys), new, rnd.choice([None, i]), rnd.choice([None, f"v{i}"]), names))
    return table, cmds


SCHEMA = "correlation_id string, operation string, k string, new_key string, a int, b string, set array<string>"


def test_routing_by_a_table_of_subscriptions(spark):
    """The trie gives what one expression per subscription gives."""
    rng = random.Random(4)
    token = lambda *more: rng.choice(["a", "b", "c", "*x", ">y", *more])
    patterns = {".".join([*(token("*", "*") for _ in range(rng.randint(0, 3))), token("*", ">", ">")]) for _ in range(150)}
    subjects = [".".join(token("", "*") for _ in range(rng.randint(1, 5))) for _ in range(300)] + [None, "", ".", "a..", "*"]
    subs = [(f"D{i % 7}", "pg" if i % 2 else "x", p, i % 5 > 0) for i, p in enumerate(sorted(patterns))]
    cmds = spark.createDataFrame([(i, s, {"targetDriverId": "d3"} if i % 4 == 0 else {"originDriverId": "D1"} if i % 4 == 1 else None) for i, s in enumerate(subjects)], "i int, subject string, meta map<string,string>")
    table = spark.createDataFrame(subs, "driver_id string, source_type string, pattern string, enabled boolean")
    by = {}
    for d, t, p, on in subs:
        if on:
            by.setdefault((d, t), []).append(p)
    targets = [Target(d, t, tuple(p)) for (d, t), p in by.items()]
    key = lambda df: sorted((r.i, r.driver_id, r.source_type) for r in df.collect())
    for options in ({}, {"per_pattern": True}, {"skip_origin": True}):
        want = key(writeback.route_commands(cmds, targets, **options))
        assert key(routing.route_by_table(cmds, table, **options)) == want and len(want) > 200
    plan = routing.match_subjects(cmds, table)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert routing.route_by_table(cmds, table.limit(0)).count() == 0
    with pytest.raises(Exception, match="may only end"):
        routing.match_subjects(cmds, spark.createDataFrame([("a.>.b",)], "pattern string")).count()


@pytest.mark.parametrize("hot_rows", [None, 0, 40])
@pytest.mark.parametrize("seed", [1, 2])
def test_apply_commands(spark, seed, hot_rows):
    table, cmds = make(seed)
    df = spark.createDataFrame(cmds, SCHEMA).drop("new_key").repartition(5)
    after, results = writeback.apply_commands(
        spark.createDataFrame(table, COLUMNS), df, ["k"], ["correlation_id"], hot_rows=hot_rows
    )
    rows, messages = by_hand(table, cmds)
    assert {tuple(r) for r in after.collect()} == rows
    assert {r.correlation_id: r.error_message for r in results.collect()} == messages


@pytest.mark.parametrize("seed, most", [(3, 10**6), (4, 10**6), (4, 8)])
def test_apply_with_renames(spark, seed, most):
    """With ``most`` a component of many commands is worked off in rounds."""
    table, cmds = make(seed, n=40, renames=True)
    df = spark.createDataFrame(cmds, SCHEMA).repartition(3)
    after, results = writeback.apply_with_renames(spark.createDataFrame(table, COLUMNS), df, "k", ["correlation_id"], most=most)
    rows, messages = by_hand(table, cmds)
    assert {tuple(r) for r in after.collect()} == rows
    assert {r.correlation_id: r.error_message for r in results.collect()} == messages


def test_jobs_do_not_grow_with_the_renames_of_a_key(spark):
    names, jobs = ["a", "b"], []
    table = spark.createDataFrame([("a", 1, "x"), ("z", 5, "y")], COLUMNS)
    for n in (20, 1000):
        cmds = [(i, "Update", names[i % 2], names[1 - i % 2], i, None) for i in range(n)] + [(n, "Delete", "a", None, None, None), (n + 1, "Create", "b", None, 7, "n")]
        df = spark.createDataFrame(cmds, "correlation_id int, operation string, k string, new_key string, a int, b string")
        spark.sparkContext.setJobGroup(f"renames-{n}", "renames")
        after, results = writeback.apply_with_renames(table, df, "k", ["correlation_id"])
        rows, faults = {tuple(r) for r in after.collect()}, results.filter("not success").count()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"renames-{n}")))
        spark.sparkContext._jsc.clearJobGroup()
        assert rows == {("b", 7, "n"), ("z", 5, "y")} and faults == 0
    assert abs(jobs[0] - jobs[1]) <= 3 and max(jobs) < 60, jobs


def test_faults_do_not_touch_the_table(spark):
    df = spark.createDataFrame(
        [("1", "Delete", "a", "pump", None), ("2", "Delete", "b", "Element", "no name"), ("3", "Update", "a", "ELEMENT", None)],
        "correlation_id string, operation string, k string, entity_type string, error string",
    ).withColumns({"a": F.lit(5), "b": F.lit(None).cast("string")})
    table = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], COLUMNS)
    after, results = writeback.apply_commands(table, df, ["k"], ["correlation_id"], types=("element",))
    assert {tuple(r) for r in after.collect()} == {("a", 5, "x"), ("b", 2, "y")}
    assert [r.error_message for r in results.orderBy("correlation_id").collect()] == ["unsupported entity type pump", "no name", None]


@pytest.mark.parametrize(
    "path, kind, name", [("element/x/y", "element", "x/y"), ("plain", "plain", "plain"), ("/lead", "/lead", "/lead"), ("t/", "t", "")]
)
def test_decode_path(spark, path, kind, name):
    df = spark.createDataFrame([("e", path, "Snapshot")], "event_id string, entity string, change_type string").withColumns(
        {c: F.lit(None).cast("map<string,string>") for c in ("pk", "fields", "meta")}
    )
    r = writeback.decode_commands(df).first()
    assert (r.operation, r.entity_type, r.pk["name"], r.correlation_id) == ("Update", kind, name, "e")


def route(spark, meta, **options):
    targets = [Target("A", "af", ("cmd.>", "cmd.x")), Target("B", "pg", ("cmd.*",))]
    df = spark.createDataFrame([("cmd.x", meta)], "subject string, meta map<string,string>")
    return sorted(r.driver_id for r in writeback.route_commands(df, targets, **options).collect())


def test_routing(spark):
    assert route(spark, None) == ["A", "B"]
    assert route(spark, {}, per_pattern=True) == ["A", "A", "B"]
    assert route(spark, {"targetDriverId": "a"}) == ["A"]
    assert route(spark, {"targetSourceType": "PG", "targetDriverId": "  "}) == ["B"]
    assert route(spark, {"originDriverId": "b"}) == ["A", "B"]
    assert route(spark, {"originDriverId": "b"}, skip_origin=True) == ["A"]
    assert writeback.route_commands(spark.createDataFrame([("s", {})], "subject string, meta map<string,string>"), []).count() == 0


def test_rename_target(spark):
    df = spark.sql(
        "select * from values (map('newName', 'n', 'name', 'm')), (map('newName', '', 'name', 'm')), (map('newName', 'old', 'name', 'm')), "
        "(map('name', 'old')), (map('x', 'y')) t(f)"
    )
    assert [r[0] for r in df.select(writeback.rename_target("f", F.lit("old"))).collect()] == ["n", "m", "m", None, None]


def test_point_attributes(spark):
    df = spark.sql("select map('descriptor', 'd', 'pointType', '') f, map('descriptor', 'x', 'zero', '') x, cast(null as map<string,string>) n")
    create, update, plain = df.select(
        writeback.map_point_attributes("f", "x", True), writeback.map_point_attributes("f", "x", False), writeback.map_point_attributes("f", "n", True)
    ).first()
    assert create == {"pointclass": "classic", "descriptor": "x"}
    assert update == {"descriptor": "x", "zero": ""}
    assert plain == {"descriptor": "d", "pointclass": "classic"}


def test_echo_once_per_session(spark):
    changes = spark.createDataFrame([(1, "s"), (2, "s"), (3, None), (4, "t")], "i int, replica_session string")
    sessions = spark.createDataFrame([("s",), ("s",)], "replica_session string")
    assert sorted(r.i for r in writeback.suppress_echo(changes, sessions, ["i"]).collect()) == [2, 3, 4]
