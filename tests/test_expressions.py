"""Golden cases for the scalar rules (FIXTURES sections 4.1-4.4, 4.7)."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.expressions import (
    daily_factor,
    expected_light,
    finite,
    health_score,
    plant_activity,
    range_flag,
    status_line,
)
from gaugeworks.operators.parse import clean_readings, parse_readings
from gaugeworks.spec import HYDROPONIC, PipelineSpec, SensorSpec

SMALL = PipelineSpec(
    sensors=(SensorSpec("a", 0.0, 10.0), SensorSpec("b", 0.0, 10.0)),
    state_fields=(("p", "double"), ("i", "int")),
)


def test_spec_validates_range():
    with pytest.raises(ValueError):
        SensorSpec("x", 5.0, 5.0)


def _parse(spark, values):
    rows = [(None if v is None else bytearray(v.encode()),) for v in values]
    env = spark.createDataFrame(rows, "value binary").select(
        F.lit(None).cast("binary").alias("key"), "value", F.current_timestamp().alias("timestamp")
    )
    return [r.asDict() for r in parse_readings(env, SMALL).collect()]


def test_json_parse_is_permissive(spark):
    docs = [
        '{"timestamp":1,"sensors":{"a":1.5,"b":null},"system_state":{"p":0.1,"i":3}}',
        '{"timestamp":1,"sensors":{"a":"x","b":2},"system_state":{"p":0.1,"i":3.5}}',
        '{"timestamp":1,"sensors":null}',
        '{"timestamp":1,"sensors":{"a":1,"b":2},"extra":5}',
        "not json",
        "",
        None,
        '{"timestamp":1,"sensors":{"a":1',
    ]
    got = _parse(spark, docs)
    pick = lambda r: (r["sensor_timestamp"], r["a"], r["b"], r["p"], r["i"])
    assert pick(got[0]) == (1, 1.5, None, 0.1, 3)
    assert pick(got[1]) == (1, None, 2.0, 0.1, None)
    assert pick(got[2]) == (1, None, None, None, None)
    assert pick(got[3]) == (1, 1.0, 2.0, None, None)
    for r in got[4:]:
        assert pick(r) == (None, None, None, None, None)
    assert got[0]["event_time"] is not None and got[4]["event_time"] is None


def test_parse_column_order(spark):
    env = spark.createDataFrame([], "key binary, value binary, timestamp timestamp")
    cols = parse_readings(env, HYDROPONIC).columns
    assert cols == (
        ["kafka_timestamp", "kafka_key", "sensor_timestamp"]
        + HYDROPONIC.sensor_names
        + ["plant_activity", "last_refill", "last_ph_adjust", "last_nutrient_dose", "event_time"]
    )


def test_range_flag_and_health(spark):
    wt = HYDROPONIC.sensor("water_temperature")
    xs = [22.0, None, float("nan"), 18.0, 25.0, 30.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = df.select(range_flag("x", wt).alias("f"), health_score("x", wt).alias("h")).collect()
    assert [r.f for r in rows] == [0, 0, 1, 0, 0, 1]
    h = [r.h for r in rows]
    assert h[0] == pytest.approx(0.8571428571428572)
    assert h[1] == 0.0 and math.isnan(h[2]) and h[3] == 0.0 and h[4] == 0.0 and h[5] == 0.0


def test_finite_drops_nan_inf(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    assert [r.y for r in df.select(finite("x").alias("y")).collect()] == [1.0, None, None, None, None]


def test_plant_activity_cases(spark):
    df = spark.createDataFrame(
        [(800.0, 22.0, 6.0), (400.0, 27.0, 6.0), (1600.0, 40.0, 8.0), (None, 22.0, 6.0), (800.0, float("nan"), None)],
        "l double, t double, p double",
    )
    got = [r.a for r in df.select(plant_activity("l", "t", "p").alias("a")).collect()]
    assert got[0] == pytest.approx(1.0)
    assert got[1] == pytest.approx(0.25)
    assert got[2] == pytest.approx(0.03)
    assert got[3] is None
    assert got[4] == pytest.approx(0.1 * 0.3)


def test_schedule_functions(spark):
    hours = [0, 5, 6, 7, 8, 11, 12, 17, 18, 20, 21, 22]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    rows = df.select("h", daily_factor("h").alias("d"), expected_light("h").alias("e")).collect()
    d = {r.h: r.d for r in rows}
    e = {r.h: r.e for r in rows}
    assert d[0] == pytest.approx(0.0, abs=1e-12) and d[6] == pytest.approx(0.5)
    assert d[12] == pytest.approx(1.0) and d[18] == pytest.approx(0.5)
    expect = {5: 0, 6: 0, 7: 400, 8: 800, 11: 1000, 17: 600, 20: 800, 21: 400, 22: 0}
    for h, v in expect.items():
        assert e[h] == pytest.approx(v, abs=1e-9)


def test_clean_readings_rounds_and_nulls_nan(spark):
    df = spark.createDataFrame(
        [(21.04, 6.123, float("nan"), "keep")], "water_temperature double, water_ph double, ec_tds double, note string"
    )
    r = clean_readings(df, HYDROPONIC).collect()[0]
    assert r.water_temperature == 21.0 and r.water_ph == 6.12 and r.ec_tds is None and r.note == "keep"


def test_status_line(spark):
    df = spark.createDataFrame([(21.5, 6.0, None, 60.0, 0.256)], "t double, p double, e double, l double, a double")
    s = df.select(status_line("t", "p", "e", "l", "a").alias("s")).collect()[0].s
    assert s == "Water: 21.5°C, pH: 6.0, EC: ERROR, Level: 60.0%, Activity: 0.26"


def test_full_reading_at_centre(spark):
    from gaugeworks.operators.windows import system_health

    vals = [21.5, 6.0, 1.6, 60.0, 24.0, 60.0, 600.0]
    schema = T.StructType(
        [T.StructField("event_time", T.TimestampType())]
        + [T.StructField(n, T.DoubleType()) for n in HYDROPONIC.sensor_names]
        + [T.StructField("plant_activity", T.DoubleType())]
    )
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1, 0, 1)
    rows = [tuple([t0] + vals + [0.5]), tuple([t0] + [None] + vals[1:] + [0.5])]
    df = spark.createDataFrame(rows, schema)
    out = system_health(df, HYDROPONIC, "5 minutes").collect()[0]
    assert out.avg_water_temperature_health_score == pytest.approx(0.5)
    assert out.avg_system_health == pytest.approx((1.0 + 6 / 7) / 2)
    assert out.total_readings == 2
