"""Window analyses: hand rows, properties over a provided table, plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators.windows import (
    anomaly_detection,
    basic_aggregation,
    flatten_window,
    measurement_name,
    system_health,
)
from gaugeworks.sources.tables import events_wide, table
from gaugeworks.spec import EVENTS, HYDROPONIC, PipelineSpec, SensorSpec

from .conftest import SF_SMALL

WT = PipelineSpec(sensors=(SensorSpec("x", 18.0, 25.0),), activity=None)


def _rows(spark, values):
    t0 = dt.datetime(2024, 1, 1)
    data = [(t0 + dt.timedelta(seconds=10 * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "event_time timestamp, x double")


def test_basic_nan_and_null_rules(spark):
    df = _rows(spark, [22.0, None, float("nan"), 18.0, 25.0, 30.0])
    r = basic_aggregation(df, WT, "5 minutes").collect()[0]
    assert r.x_min == 18.0
    assert r.x_count == 5
    import math

    assert math.isnan(r.x_max) and math.isnan(r.x_avg) and math.isnan(r.x_stddev)
    a = anomaly_detection(df, WT, "5 minutes").collect()[0]
    assert a.x_range_anomaly == 2 and a.total_readings == 6
    assert "window_duration" not in anomaly_detection(df, WT, "5 minutes").columns


def test_single_row_stddev_is_null(spark):
    r = basic_aggregation(_rows(spark, [20.0]), WT, "5 minutes").collect()[0]
    assert r.x_stddev is None and r.x_count == 1


def test_null_time_reaches_no_window(spark):
    df = spark.createDataFrame([(None, 20.0), (dt.datetime(2024, 1, 1), 21.0)], "event_time timestamp, x double")
    out = basic_aggregation(df, WT, "5 minutes").collect()
    assert len(out) == 1 and out[0].x_count == 1


def test_output_shapes(spark):
    df = _rows(spark, [20.0])
    assert len(basic_aggregation(df, WT, "5 minutes").columns) == 1 + 5 + 2
    hydro_cols = basic_aggregation(
        spark.createDataFrame([], ", ".join(["event_time timestamp"] + [f"{c} double" for c in HYDROPONIC.aggregate_columns])),
        HYDROPONIC,
        "5 minutes",
    ).columns
    assert len(hydro_cols) == 43
    assert measurement_name("basic", "5 minutes") == "aggregations_5_minutes"
    assert measurement_name("health", "1 hour") == "health_1_hour"


def test_health_without_sensor_raises(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0)], "event_time timestamp, other double")
    with pytest.raises(ValueError):
        system_health(df, WT, "5 minutes")


@pytest.fixture(scope="module")
def events_sf(spark):
    return events_wide(table(spark, SF_SMALL, "events"))


def test_properties_over_events(spark, events_sf):
    b = flatten_window(basic_aggregation(events_sf, EVENTS, "15 minutes"))
    a = flatten_window(anomaly_detection(events_sf, EVENTS, "15 minutes"))
    h = flatten_window(system_health(events_sf, EVENTS, "15 minutes"))
    for t in ("click", "view"):
        bad = b.where(
            (F.col(f"{t}_min") > F.col(f"{t}_avg") + 1e-9) | (F.col(f"{t}_avg") > F.col(f"{t}_max") + 1e-9)
        ).count()
        assert bad == 0
    total_count = b.agg(F.sum("click_count")).first()[0]
    assert total_count == events_sf.where(F.col("click").isNotNull()).count()
    assert a.where(F.col("error_range_anomaly") > F.col("total_readings")).count() == 0
    assert h.where((F.col("avg_system_health") < 0) | (F.col("avg_system_health") > 1)).count() == 0
    assert a.agg(F.sum("total_readings")).first()[0] == events_sf.count()


def test_by_system_matches_total(spark, events_sf):
    per = basic_aggregation(events_sf, EVENTS, "1 hour", by=["system_id"])
    tot = basic_aggregation(events_sf, EVENTS, "1 hour")
    s1 = per.agg(F.sum("view_count")).first()[0]
    s2 = tot.agg(F.sum("view_count")).first()[0]
    assert s1 == s2


def test_plan_is_partial_aggregate_with_pushdown(spark):
    ev = table(spark, SF_SMALL, "events")
    q = basic_aggregation(events_wide(ev).where(F.col("event_time") >= F.lit("2024-01-10").cast("timestamp_ntz")), EVENTS, "1 hour")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan
    # the scan reads only the columns the analysis needs (user_id is unused)
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in plan


def test_health_skips_missing_readings(spark):
    from gaugeworks import HYDROPONIC
    from gaugeworks.operators import system_health

    a, b = HYDROPONIC.sensors[0], HYDROPONIC.sensors[1]
    rows = [(a.centre, None), (None, None), (a.centre, b.centre + b.half_width / 2)]
    df = spark.createDataFrame(rows, f"{a.name} double, {b.name} double").selectExpr(
        "*", f"timestamp '2024-01-01 00:00:01' AS {HYDROPONIC.time_col}"
    )
    zero = system_health(df, HYDROPONIC).first()
    skip = system_health(df, HYDROPONIC, missing="skip").first()
    assert abs(zero.avg_system_health - (0.5 + 0.0 + 0.75) / 3) < 1e-9
    assert abs(skip.avg_system_health - (1.0 + 0.75) / 2) < 1e-9
    assert skip[f"avg_{a.name}_health_score"] == 1.0 and abs(skip[f"avg_{b.name}_health_score"] - 0.5) < 1e-9
    assert skip.total_readings == 3
