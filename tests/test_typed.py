import pytest

from haulmark.operators import typed
from haulmark.session import run_dir
from haulmark.sources.versioned import VersionedTable

GOOD = {
    "telemetry": '{"vehicle_id":"V1","timestamp":"2024-01-01T10:00:00Z","latitude":24.8,"longitude":67,"speed":0,"fuel_level":5e1}',
    "vehicles": '{"vehicle_id":"V1","make":"a","model":"b","vehicle_type":"Van","year":2015,"status":"Active"}',
    "warehouses": '{"warehouse_id":"W","name":"n","location":{"latitude":1.5,"longitude":2}}',
}
BAD = [
    ("telemetry", '"V1"', "7", ["type:vehicle_id"]),
    ("telemetry", '"V1"', "null", ["type:vehicle_id"]),
    ("telemetry", '"vehicle_id":"V1",', "", ["required:vehicle_id"]),
    ("telemetry", "2024-01-01T10:00:00Z", "soon", ["type:timestamp"]),
    ("telemetry", "24.8", '"24.8"', ["type:latitude"]),
    ("telemetry", '"speed":0', '"speed":-0.5', ["minimum:speed"]),
    ("telemetry", '"speed":0', '"speed":"-0.5"', ["type:speed"]),
    ("telemetry", '"speed":0', '"speed":[1]', ["type:speed"]),
    ("vehicles", "2015", "2015.5", ["type:year"]),
    ("vehicles", "2015", "2026", ["maximum:year"]),
    ("vehicles", "2015", "true", ["type:year"]),
    ("vehicles", '"Van"', '"van"', ["enum:vehicle_type"]),
    ("vehicles", '"Active"', "1", ["enum:status"]),
    ("warehouses", '{"latitude":1.5,"longitude":2}', '"here"', ["type:location", "required:location.latitude", "required:location.longitude"]),
    ("warehouses", "1.5", "{}", ["type:location.latitude"]),
]


def test_values_keep_their_types(spark):
    documents = [(e, v, []) for e, v in GOOD.items()] + [(e, GOOD[e].replace(old, new), rules) for e, old, new, rules in BAD]
    documents += [("vehicles", v, ["json:$"]) for v in ("{", "", "[]", "7", None)] + [("unknown", "{", [])]
    df = spark.createDataFrame([(i, e, v) for i, (e, v, _) in enumerate(documents)], "i int, entity string, value string")
    for r in typed.tagged(df).collect():
        assert r["broken_rules"] == documents[r["i"]][2], r["value"]


def test_every_rule_is_counted_and_bad_documents_are_stored_once(spark, rows):
    good = [(e, v) for e, v in GOOD.items()] * 3
    df = spark.createDataFrame(good + [("vehicles", "x"), ("telemetry", GOOD["telemetry"].replace("67", '"e"'))], "entity string, value string")
    counts = typed.rule_counts(typed.tagged(df))
    assert rows(counts.filter("violations > 0")) == [("json", "vehicles", "$", 1, 4, False), ("type", "telemetry", "longitude", 1, 4, False)]
    assert counts.filter("entity = 'drivers'").select("total").distinct().collect()[0][0] == 0
    table = VersionedTable(spark, f"{run_dir(spark, 't-quarantine')}/t")
    for _ in range(2):
        passed = typed.quarantine(typed.tagged(df), table, "run-1")
    assert passed.count() == 9
    assert rows(table.read(), "entity", "run") == [("telemetry", "run-1"), ("vehicles", "run-1")]


@pytest.mark.parametrize("value", ["{" * 3000, '{"a":' * 400 + "1" + "}" * 400, "x" * 2_000_000, '{"vehicle_id":"' + "y" * 2_000_000 + '"}'])
def test_deep_and_long_documents(spark, value):
    df = spark.createDataFrame([("vehicles", value)], "entity string, value string")
    assert len(typed.tagged(df).first()["broken_rules"]) >= 1


def test_documents_are_parsed_once(spark):
    df = spark.createDataFrame([("vehicles", GOOD["vehicles"])], "entity string, value string")
    plan = typed.rule_counts(typed.tagged(df, {"vehicles": typed.DOCUMENTS["vehicles"]}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1
