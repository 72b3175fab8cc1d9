"""Point building rules (FIXTURES 4.4; SURVEY D9-D13, D20)."""

import datetime as dt

from pyspark.sql import functions as F

from gaugeworks.operators.points import line_protocol, points_long, raw_points, window_points
from gaugeworks.operators.windows import anomaly_detection, basic_aggregation
from gaugeworks.spec import PipelineSpec, SensorSpec

SPEC = PipelineSpec(
    sensors=(SensorSpec("a", 0.0, 10.0), SensorSpec("b", 0.0, 10.0), SensorSpec("c", 0.0, 10.0), SensorSpec("d", 0.0, 10.0)),
    default_system="sys0",
)


def test_field_cleaning_and_empty_points(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [
            ("k1", dt.datetime(2024, 1, 1), 1, 1.0, None, float("nan"), inf),
            ("k1", dt.datetime(2024, 1, 1), 2, None, float("nan"), inf, -inf),
        ],
        "kafka_key string, event_time timestamp, sensor_timestamp long, a double, b double, c double, d double",
    )
    pts = raw_points(df, SPEC).collect()
    assert len(pts) == 1  # the all-invalid reading yields no point
    p = pts[0]
    assert (p.a, p.b, p.c, p.d) == (1.0, None, None, None)
    assert p.system_id == "k1" and p.measurement == "raw_sensor_data"
    long = points_long(raw_points(df, SPEC)).collect()
    assert [(r.field, r.value) for r in long] == [("a", 1.0)]


def test_time_fallback_and_default_system(spark):
    df = spark.createDataFrame(
        [(None, None, 1_700_000_000_000, 2.0), (None, None, None, 3.0)],
        "kafka_key string, event_time timestamp, sensor_timestamp long, a double",
    )
    rows = {r.a: r for r in raw_points(df, SPEC).collect()}
    assert rows[2.0].time == dt.datetime(2023, 11, 14, 22, 13, 20)  # from the epoch-ms stamp (UTC)
    assert rows[3.0].time is not None  # ingest time
    assert rows[2.0].system_id == "sys0"


def test_window_points_stamp_tags_and_fields(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 1), 1.0), (dt.datetime(2024, 1, 1, 0, 2), None)], "event_time timestamp, a double"
    )
    agg = basic_aggregation(df, SPEC, "5 minutes")
    end = window_points(agg, SPEC, "aggregations_5_minutes").collect()[0]
    start = window_points(agg, SPEC, "aggregations_5_minutes", stamp="start").collect()[0]
    assert end.time == dt.datetime(2024, 1, 1, 0, 5) and start.time == dt.datetime(2024, 1, 1, 0, 0)
    assert end.analysis_type == "basic_aggregation" and end.window_duration == "5 minutes"
    assert end.a_count == 1.0 and end.a_stddev is None  # n=1 stddev is NULL -> field dropped
    assert end.system_id == "sys0"
    # anomaly output has no window_duration column, so no such tag
    an = window_points(anomaly_detection(df, SPEC, "5 minutes"), SPEC, "anomalies_5_minutes")
    assert "window_duration" not in an.columns and "total_readings" in an.columns


def test_window_row_with_no_readings_keeps_count_fields(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 1), None)], "event_time timestamp, a double")
    pts = window_points(basic_aggregation(df, SPEC, "5 minutes"), SPEC, "m").collect()
    assert len(pts) == 1 and pts[0].a_count == 0.0 and pts[0].a_avg is None


def test_line_protocol_escaping(spark):
    df = spark.createDataFrame(
        [("raw data", "sys 1,a=b", dt.datetime(1970, 1, 1, 0, 0, 1), 1.5, None)],
        "measurement string, system_id string, time timestamp, a double, b double",
    )
    line = line_protocol(df).collect()[0].line
    assert line == "raw\\ data,system_id=sys\\ 1\\,a\\=b a=1.5 1000000000"
    assert line_protocol(df, precision=3).collect()[0].line.endswith(" a=1.500 1000000000")
