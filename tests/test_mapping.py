import pytest
from pyspark.sql import functions as F

from changeflow.functions.maps import merge_attributes, merge_metadata
from changeflow.functions.text import sanitise_path, snapshot_key, subject_matches, subject_regex
from changeflow.functions.values import document_fields, type_json_fields
from changeflow.operators import mapping
from changeflow.sources.scan import raw_changes
from changeflow.spec import Rule


def mapped(spark, values, rules, key=(), prev=None, **options):
    row = ", ".join(f"'{k}', {v}" for k, v in values.items())
    sql = f"select named_struct({row}) as row"
    if prev:
        sql += ", named_struct(" + ", ".join(f"'{k}', {v}" for k, v in prev.items()) + ") as prev"
    return mapping.apply_mapping(spark.sql(sql), rules, key, **options).first()


def test_pass_through_splits_key_and_fields(spark):
    r = mapped(spark, {"asset_id": "'A1'", "name": "'Widget'"}, [], ["ASSET_ID"])
    assert r.pk.asDict() == {"asset_id": "A1"} and r.fields.asDict() == {"name": "Widget"}


@pytest.mark.parametrize(
    "rule, fields",
    [
        (Rule("name", exclude=True), {"id": 1}),
        (Rule("NAME", target="title"), {"id": 1, "title": "Widget"}),
        (Rule("origin", static="erp"), {"origin": "erp", "id": 1, "name": "Widget"}),
        (Rule("x", target="name", static="default"), {"name": "Widget", "id": 1}),
        (Rule("name", concepts={"Widget": "pid:Widget"}), {"id": 1, "name": "pid:Widget"}),
        (Rule("name", concepts={"widget": "pid:Widget"}), {"id": 1, "name": "Widget"}),
        (Rule("id", type="string", concepts={"1": "pid:One"}), {"id": "pid:One", "name": "Widget"}),
        (Rule("id", type="unknown"), {"id": 1, "name": "Widget"}),
    ],
)
def test_rules(spark, rule, fields):
    assert mapped(spark, {"id": "1", "name": "'Widget'"}, [rule]).fields.asDict() == fields


def test_mapped_key_column_without_flag_is_a_field(spark):
    r = mapped(spark, {"id": "1", "n": "2"}, [Rule("id", target="no")], ["id"])
    assert r.pk is None and r.fields.asDict() == {"no": 1, "n": 2}


@pytest.mark.parametrize(
    "value, kind, typed, raw",
    [
        ("'42'", "int", 42, None), ("' +5 '", "int", 5, None), ("'3.14'", "double", 3.14, None), ("'1e3'", "double", 1000.0, None),
        ("'true'", "bool", True, None), ("'False'", "bool", False, None), ("'yes'", "bool", None, "yes"),
        ("'99'", "long", 99, None), ("'not-a-number'", "int", None, "not-a-number"), ("'3.7'", "int", None, "3.7"),
        ("''", "int", None, ""), ("'1d'", "double", None, "1d"), ("3.0D", "int", 3, None), ("3.5D", "int", None, "3.5"),
        ("cast(null as string)", "int", None, None), ("'99999999999'", "int", None, "99999999999"),
        ("'2024-02-30'", "date", None, "2024-02-30"), ("'noon'", "timestamp", None, "noon"),
    ],
)
def test_casts(spark, value, kind, typed, raw):
    r = mapped(spark, {"v": value}, [Rule("v", type=kind)])
    assert (r.fields.v, r.fields.v__raw) == (typed, raw)
    text = mapped(spark, {"v": value}, [Rule("v", type=kind)], failed_casts="text").fields.v
    assert text == (raw if typed is None else str(int(typed) if isinstance(typed, float) and typed == int(typed) else typed))


def test_failed_cast_then_concept(spark):
    r = mapped(spark, {"v": "'PUMP'"}, [Rule("v", type="int", concepts={"PUMP": "pid:Pump"})])
    assert r.fields.asDict() == {"v": "pid:Pump"}


def test_previous_drops_key_and_static(spark):
    rules = [Rule("id", is_key=True), Rule("name", target="title"), Rule("s", static="x"), Rule("secret", exclude=True)]
    row = {"id": "1", "name": "'n'", "secret": "'z'", "k2": "7"}
    r = mapped(spark, row, rules, ["k2"], prev={"id": "1", "name": "'o'", "secret": "'y'", "k2": "7"})
    assert r.pk.asDict() == {"id": 1, "k2": 7}
    assert r.prev.asDict() == {"title": "o"}


@pytest.mark.parametrize("rules", [[Rule("")], [Rule("a", exclude=True, is_key=True)], [Rule("a"), Rule("A")]])
def test_bad_rules(spark, rules):
    with pytest.raises(ValueError):
        mapped(spark, {"a": "1"}, rules)


def test_excluded_column_is_not_read(spark):
    from conftest import SMALL

    raw = raw_changes(spark.read.parquet(f"{SMALL}/customer.parquet"), "c")
    out = mapping.apply_mapping(raw, [Rule("c_name", exclude=True), Rule("c_mktsegment", exclude=True)], ["c_custkey"])
    plan = out.select("pk", "fields")._jdf.queryExecution().executedPlan().toString()
    assert "c_custkey" in plan and "c_name:" not in plan.split("ReadSchema")[1]


def test_metadata_names_ignore_case(spark):
    df = spark.sql("select map('Source', 'a', 'k', 'v') as m union all select cast(null as map<string,string>)")
    got = [r[0] for r in df.select(merge_metadata("m", {"source": "b", "new": "n"})).collect()]
    assert got == [{"Source": "b", "k": "v", "new": "n"}, {"source": "b", "new": "n"}]
    assert df.select(merge_metadata("m", {})).first()[0] == {"Source": "a", "k": "v"}


def test_request_checks(spark):
    df = spark.sql(
        "select 'r' requestId, cast(null as string) driverId, 'pg' sourceType, 'e' entityPath, 'Patch' changeType, "
        "'t' detectedAt, map('a', 1) primaryKey, map('a', 1) fields"
    )
    out = mapping.check_request(df)
    assert out.first().errors == ["driverId is required", "changeType must be one of: Insert, Update, Delete, Snapshot"]
    good, bad = mapping.split_valid(out)
    assert (good.count(), bad.count()) == (0, 1)


def test_missing_ontology_version_is_an_error(spark):
    df = spark.sql("select 'e' entity, 1 id")
    out = mapping.resolve_concepts(df, [("e", "id = 1", "c:X", "ctx")], {}, None)
    assert out.first().errors == ["ontology version is required"]


def test_json_typing(spark):
    df = spark.createDataFrame([('{"a":1,"b":1.0,"c":"x","d":true,"e":null,"f":{"z":1},"h":12345678901234567890}',)], "j string")
    got = {k: v.kind for k, v in df.select(type_json_fields("j")).first()[0].items()}
    assert got == {"a": "long", "b": "double", "c": "string", "d": "bool", "e": "null", "f": "json", "h": "double"}


def test_document_fields(spark):
    doc = (
        '{"_id":{"$oid":"ab"},"p":{"$numberDecimal":"1.50"},"d":{"$date":"2024-01-02T03:04:05Z"},'
        '"e":{"$date":{"$numberLong":"1000"}},"u":{"$undefined":true},"n":{"x":1},"t":"{text","z":null}'
    )
    kinds = {"_id": "text", "p": "double", "d": "date", "e": "date", "u": "text", "n": "text", "t": "text", "z": "text", "no": "text"}
    r = spark.createDataFrame([(doc,)], "j string").select(document_fields("j", kinds).alias("d")).first().d
    assert (r["_id"], r.p, r.u, r.n, r.t, r.z, r["no"]) == ("ab", 1.5, None, '{"x":1}', "{text", None, None)
    assert (r.d.isoformat(), r.e.isoformat()) == ("2024-01-02T03:04:05", "1970-01-01T00:00:01")


@pytest.mark.parametrize(
    "path, clean",
    [
        ("element/\\\\Av-Pi\\DB\\É x:1", "element.Av-Pi.DB.É_x_1"), ("public.assets", "public.assets"),
        ("/a//b/", "a.b"), ("", ""), ("a\U0001F600b", "a_b"), ("..", ""),
    ],
)
def test_sanitise_path(spark, path, clean):
    assert spark.createDataFrame([(path,)], "p string").select(sanitise_path("p")).first()[0] == clean


def test_snapshot_key(spark):
    df = spark.sql("select 'e' entity, 1 a, cast(null as string) b")
    assert df.select(snapshot_key("entity", ["a", "b"])).first()[0] == "e:1:∅"
    assert df.select(snapshot_key("entity", [], keyless=True)).first()[0] == "e"
    with pytest.raises(ValueError):
        snapshot_key("entity", [])


@pytest.mark.parametrize(
    "pattern, subject, match",
    [
        ("cdc.>", "cdc.a", True), ("cdc.>", "cdc.a.b.c", True), ("cdc.>", "cdc", False), ("cdc.*.x", "cdc.a.x", True),
        ("cdc.*.x", "cdc.a.b.x", False), ("cdc.a", "cdc.a", True), ("cdc.a", "cdcxa", False), (">", "a.b", True), ("*", "a.b", False),
    ],
)
def test_subscriptions(spark, pattern, subject, match):
    assert spark.createDataFrame([(subject,)], "s string").select(subject_matches("s", pattern)).first()[0] is match


def test_bad_subscription():
    with pytest.raises(ValueError):
        subject_regex("a.>.b")


def test_attributes(spark):
    df = spark.sql("select map('a', '1', 'b', '2') base, map('a', cast(null as string), 'c', '3') patch, cast(null as map<string,string>) none")
    assert df.select(merge_attributes("base", "patch", False)).first()[0] == {"a": None, "b": "2"}
    assert df.select(merge_attributes("base", "none", False)).first()[0] == {"a": "1", "b": "2"}


def test_excluded_columns_are_not_read_by_the_forward_plan(spark, tmp_path):
    from changeflow.plans.forward import Driver, change_events
    from changeflow.sources.scan import raw_changes

    rows = spark.createDataFrame([(1, "secret", 10, 5), (1, "secret", 11, 6)], "k int, ssn string, t int, n int")
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    raw = raw_changes(table.withColumn("ts", F.timestamp_seconds("t")), "t", "ts", "Snapshot")
    driver = Driver("d", "pg", rules=[Rule("ssn", exclude=True), Rule("t", exclude=True)])
    raw = raw.withColumn("row", F.col("row").dropFields("ts"))
    out = change_events(raw, driver, ["k"], [F.col("row.t")], detected_at=F.col("source_ts"))
    assert "ssn" not in out._jdf.queryExecution().executedPlan().toString().split("ReadSchema:")[1]
    got = [r.asDict(recursive=True) for r in out.orderBy("source_ts").collect()]
    assert [r["fields"] for r in got] == [{"n": 5}, {"n": 6}] and got[1]["prev"] == {"n": 5}
    assert not [c for c in out.columns if c.startswith("__")]
