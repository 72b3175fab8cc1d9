"""Fields of JSON documents that no spec names."""

import json

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators.documents import (
    discover_fields,
    expand_fields,
    field_inventory,
    leaf_fields,
    unknown_sensor_points,
    with_document,
)
from gaugeworks.operators.parse import parse_readings
from gaugeworks.spec import HYDROPONIC

DOCS = [
    {"a": 1, "b": {"c": 2.5, "odd key": "x", "it's": True}, "f": [1, {"g": True}, []], "h": {}},
    {"a": "text", "b": {"c": None}, "A": 3},
    7,
    [],
]


def _docs(spark, texts):
    return with_document(spark.createDataFrame(list(enumerate(texts)), "id int, value string"))


def _leaves(value, path="$"):
    """Leaves of a parsed document, by recursion."""
    if isinstance(value, dict) and value:
        for k, v in value.items():
            plain = k.replace("_", "a").isalnum() and not k[0].isdigit()
            step = f".{k}" if plain else f'["{k}"]' if "'" in k else f"['{k}']"
            yield from _leaves(v, path + step)
    elif isinstance(value, list) and value:
        for v in value:
            yield from _leaves(v, path + "[*]")
    else:
        yield path, value


KINDS = {int: "number", float: "number", str: "text", bool: "boolean", type(None): "null", dict: "object", list: "array"}


def test_leaves_equal_recursion(spark):
    texts = [json.dumps(d) for d in DOCS] + ["not json", None, "", '{"twice": 1, "twice": 2}']
    got = leaf_fields(_docs(spark, texts), keep=["id"]).collect()
    want = sorted((i, p, KINDS[type(v)]) for i, d in enumerate(DOCS) for p, v in _leaves(d))
    assert sorted((r.id, r.path, r.kind) for r in got) == want
    numbers = {(r.id, r.path, r.number) for r in got if r.kind == "number"}
    assert numbers == {(i, p, float(v)) for i, d in enumerate(DOCS) for p, v in _leaves(d) if KINDS[type(v)] == "number"}
    assert {r.text for r in got if r.kind == "text"} == {"x", "text"}


def test_what_lies_deeper_is_one_leaf(spark):
    docs = _docs(spark, ['{"a": {"b": {"c": 1}}}'])
    (row,) = leaf_fields(docs, depth=2).collect()
    assert (row.path, row.kind, json.loads(row.text)) == ("$.a.b", "object", {"c": 1})
    with pytest.raises(ValueError, match="path"):
        leaf_fields(docs.withColumn("path", F.lit(1)), keep=["path"])


def test_fields_expand_to_columns(spark):
    docs = _docs(spark, [json.dumps(d) for d in DOCS])
    fields = discover_fields(field_inventory(docs))
    assert fields == {"$.A": "double", "$.a": "string", "$.b.c": "double", "$.b['odd key']": "string", '$.b["it\'s"]': "boolean"}
    wide = expand_fields(docs, fields, keep=["id"])
    assert len({c.lower() for c in wide.columns}) == len(wide.columns) == 6
    rows = {r.id: r.asDict() for r in wide.collect()}
    assert rows[0]["b_c"] == 2.5 and rows[0]["b_odd_key"] == "x" and rows[0]["b_it_s"] is True
    assert set(rows[1].values()) == {1, 3.0, "text", None} and set(rows[2].values()) == {2, None}
    clashing = expand_fields(docs.withColumn("b_c", F.lit(0)), fields, keep=["id", "b_c"])
    assert len({c.lower() for c in clashing.columns}) == 7


def test_too_many_fields_are_an_error(spark):
    docs = _docs(spark, [json.dumps({f"id{i}": 1 for i in range(20)})])
    assert len(discover_fields(field_inventory(docs), max_fields=20)) == 20
    with pytest.raises(ValueError, match="19 different"):
        discover_fields(field_inventory(docs), max_fields=19)


def test_one_scan_one_exchange(spark):
    docs = _docs(spark, [json.dumps(d) for d in DOCS])
    plan = field_inventory(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Python" not in plan


def test_empty_table(spark):
    docs = _docs(spark, ["x"]).where("id < 0")
    assert field_inventory(docs).count() == 0
    assert discover_fields(field_inventory(docs)) == {}


def test_sensors_that_the_spec_does_not_name(spark):
    doc = {"timestamp": 1_700_000_000_000, "sensors": {"water_ph": 6.1, "co2": 410, "probe": {"top": 1.5}, "note": "x"}}
    texts = [json.dumps(doc), json.dumps({"sensors": {"co2": 5}}), json.dumps({"sensors": 3}), "x", None]
    env = spark.createDataFrame([(t,) for t in texts], "value string").select(
        F.when(F.col("value").contains("water"), "s1").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.timestamp_seconds(F.lit(1000)).alias("timestamp"),
    )
    got = {(r.system_id, r.t, r.field, r.value) for r in unknown_sensor_points(env, HYDROPONIC).withColumn("t", F.unix_seconds("time")).collect()}
    system = HYDROPONIC.default_system
    assert got == {("s1", 1_700_000_000, "co2", 410.0), ("s1", 1_700_000_000, "$.probe.top", 1.5), (system, 1000, "co2", 5.0), (system, 1000, "$", 3.0)}
    assert parse_readings(env, HYDROPONIC).where("water_ph = 6.1").count() == 1
