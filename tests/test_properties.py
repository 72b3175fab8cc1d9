"""Seeded property checks of the window analyses."""

import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeworks.operators.windows import anomaly_detection, basic_aggregation, system_health
from gaugeworks.spec import PipelineSpec, SensorSpec

SPEC = PipelineSpec(sensors=(SensorSpec("a", 18.0, 25.0), SensorSpec("b", 5.5, 6.5)), activity=None)
T0 = dt.datetime(2024, 1, 1)

reading = st.one_of(st.none(), st.floats(min_value=-50, max_value=80, allow_nan=False))
rows = st.lists(st.tuples(st.integers(0, 3600), reading, reading), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, derandomize=True)
@given(rows)
def test_window_invariants(spark, data):
    df = spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=s), a, b) for s, a, b in data], "event_time timestamp, a double, b double"
    )
    basic = basic_aggregation(df, SPEC, "15 minutes").collect()
    anom = anomaly_detection(df, SPEC, "15 minutes").collect()
    health = system_health(df, SPEC, "15 minutes").collect()
    assert sum(r.a_count for r in basic) == sum(1 for _, a, _ in data if a is not None)
    for r in basic:
        if r.a_count:
            assert r.a_min <= r.a_avg + 1e-9 and r.a_avg <= r.a_max + 1e-9
    for r in anom:
        assert 0 <= r.a_range_anomaly <= r.total_readings and 0 <= r.b_range_anomaly <= r.total_readings
    assert sum(r.total_readings for r in anom) == len(data)
    for r in health:
        for v in (r.avg_a_health_score, r.avg_b_health_score, r.avg_system_health):
            assert 0.0 <= v <= 1.0 and not math.isnan(v)
