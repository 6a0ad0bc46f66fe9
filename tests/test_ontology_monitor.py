import pytest

from changeflow.operators import monitor, ontology
from changeflow.sinks.tables import read_version

ENTRY = "iri string, label string, parent_iri string, type string, n int"


def onto(spark):
    return spark.createDataFrame(
        [("x:A", "Pump", None, "class", 1), ("x:A", "Pump 2", "x:P", "class", 2), ("x:B", "pump", None, "individual", 3), ("x:C", None, None, "property", 4)],
        ENTRY,
    )


def test_lookup_last_wins_and_case_counts(spark):
    df = spark.createDataFrame([("x:A",), ("X:a",), ("x:C",)], "c string")
    got = {r.c: (r.label, r.parent_iri, r.type) for r in ontology.lookup_iri(df, onto(spark), "c", "n").collect()}
    assert got == {"x:A": ("Pump 2", "x:P", "class"), "X:a": (None, None, None), "x:C": (None, None, "property")}


def test_label_ignores_case_and_keeps_all(spark):
    df = spark.createDataFrame([("PUMP",), (None,)], "q string")
    assert sorted(r.iri for r in ontology.find_label(df, onto(spark), "q").collect()) == ["x:A", "x:B"]


def test_has_iri(spark):
    df = spark.createDataFrame([("x:A",), ("x:a",)], "c string")
    assert [r.c for r in ontology.has_iri(df, onto(spark), "c").collect()] == ["x:A"]


def test_bindings(spark):
    docs = [
        '{"results":{"bindings":[{"iri":{"value":"a"},"label":{"value":"L"},"type":{"value":"owl#Class"}},'
        '{"label":{"value":"no iri"}},{"iri":{"value":"b"},"type":{"value":"owl#NamedIndividual"}},{"iri":{"value":"c"}}]}}',
        "{}", '{"results":{}}',
    ]
    out = ontology.decode_bindings(spark.createDataFrame([(d,) for d in docs], "value string"))
    assert [(r.iri, r.label, r.type) for r in out.orderBy("iri").collect()] == [("a", "L", "class"), ("b", None, "individual"), ("c", None, "property")]


def test_refresh_replaces(spark, shared):
    ontology.refresh_ontology(onto(spark), shared)
    ontology.refresh_ontology(onto(spark).limit(1), shared)
    assert read_version(spark, shared).count() == 1


STATES = ("Disconnected", "Connecting", "Connected", "Streaming", "Reconnecting", "Failed")
ALLOWED = {(s, a): n for s, a, n in monitor.TRANSITIONS}


def test_every_transition(spark):
    rows = [(s, a) for s in STATES for a in ("start", "STOP", "Restart")]
    out = monitor.audit_lifecycle(spark.createDataFrame(rows, "state string, action string")).collect()
    assert sum(r.valid for r in out) == len(ALLOWED) == 8
    for r in out:
        assert r.next_state == ALLOWED.get((r.state, r.action.lower()))
        assert sorted(r.valid_actions) == sorted(a for s, a in ALLOWED if s == r.state)


@pytest.mark.parametrize("oks, failures, error", [("FFT", 0, "e1"), ("TFF", 2, "e2"), ("FF", 2, "e1"), ("T", 0, None), ("FTFTF", 1, "e4")])
def test_health(spark, oks, failures, error):
    rows = [("d", i, c == "T", None if c == "T" else f"e{i}", c) for i, c in enumerate(oks)]
    r = monitor.health(spark.createDataFrame(rows, "driver_id string, seq int, ok boolean, error string, state string").selectExpr("*", "timestamp_seconds(seq) ts")).first()
    assert (r.consecutive_failures, r.last_error, r.events_emitted, r.state) == (failures, error, oks.count("T"), oks[-1])


def test_catalogue_checks(spark):
    rows = spark.createDataFrame([(1, "ok", "a"), (2, None, "b"), (3, "bad", "a")], "id int, s string, g string")
    names = spark.createDataFrame([("a", "Alpha")], "k string, n string")
    assert sorted(tuple(r) for r in monitor.group_profile(rows, names, "g", "k", "n").collect()) == [("a", "Alpha", 2), ("b", "?", 1)]
    assert sorted(r.id for r in monitor.not_in_state(rows, "s", "ok").collect()) == [2, 3]
    assert monitor.row_by_key(rows, "id", 3).first().s == "bad"
