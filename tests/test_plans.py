"""Plan-shape checks for the scale properties the operators rely on."""

import re

from gaugeworks.operators.control import elapsed_since_action
from gaugeworks.operators.readings import latest_readings
from gaugeworks.operators.windows import basic_aggregation
from gaugeworks.sources.tables import events_as_hydroponic, events_wide, table
from gaugeworks.spec import EVENTS, HYDROPONIC

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_readings_aggregates_partially(spark):
    plan = _plan(latest_readings(events_wide(table(spark, SF_SMALL, "events")), EVENTS))
    assert "partial_max_by" in plan  # map-side candidates before the shuffle
    assert "Window" not in plan


def test_by_system_windows_aggregate_partially(spark):
    plan = _plan(basic_aggregation(events_wide(table(spark, SF_SMALL, "events")), EVENTS, "1 hour", by=["system_id"]))
    assert "partial_avg" in plan and "partial_stddev_samp" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_elapsed_windows_never_span_a_whole_system(spark):
    h = events_as_hydroponic(table(spark, SF_SMALL, "events"))
    plan = _plan(elapsed_since_action(h, HYDROPONIC, tiebreak="event_id"))
    windows = [m.groups() for m in re.finditer(r"Window \[.*\], \[([^\]]*)\], \[([^\]]*)\]", plan)]
    assert windows, plan
    for part, order in windows:
        if "__chunk" in part or "__b1" in part or "__b2" in part:
            continue  # bounded by a chunk or a block of chunks
        # only the top of the blocked prefix maximum partitions by system
        # alone: one row per fan_in**2 chunks
        assert "__b2" in order, (part, order)
