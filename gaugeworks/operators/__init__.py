"""DataFrame -> DataFrame operators."""

from .documents import discover_fields, expand_fields, field_inventory, leaf_fields, unknown_sensor_points, with_document
from .parse import clean_readings, parse_readings, rejected_readings, with_system_id
from .points import line_protocol, points_long, raw_points, window_points
from .readings import latest_readings, with_plant_activity, with_schedule, with_status_line
from .states import (
    FROM_STATES,
    combined_from,
    corrected_states,
    merge_states,
    window_states,
)
from .windows import (
    ANALYSES,
    anomaly_detection,
    basic_aggregation,
    flatten_window,
    measurement_name,
    system_health,
)

__all__ = [
    "discover_fields",
    "expand_fields",
    "field_inventory",
    "leaf_fields",
    "unknown_sensor_points",
    "with_document",
    "clean_readings",
    "parse_readings",
    "rejected_readings",
    "with_system_id",
    "line_protocol",
    "points_long",
    "raw_points",
    "window_points",
    "latest_readings",
    "with_plant_activity",
    "with_schedule",
    "with_status_line",
    "FROM_STATES",
    "combined_from",
    "corrected_states",
    "merge_states",
    "window_states",
    "ANALYSES",
    "anomaly_detection",
    "basic_aggregation",
    "flatten_window",
    "measurement_name",
    "system_health",
]
