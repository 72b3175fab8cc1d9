"""Column-level building blocks (scalar expressions and schemas)."""

from .expressions import (
    clean_reading,
    daily_factor,
    epoch_nanos,
    expected_light,
    finite,
    health_score,
    mean_of,
    mean_of_present,
    nan_to_null,
    plant_activity,
    range_flag,
    status_line,
)
from .schema import ENVELOPE_SCHEMA, parsed_columns, payload_schema

__all__ = [
    "clean_reading",
    "daily_factor",
    "epoch_nanos",
    "expected_light",
    "finite",
    "health_score",
    "mean_of",
    "mean_of_present",
    "nan_to_null",
    "plant_activity",
    "range_flag",
    "status_line",
    "ENVELOPE_SCHEMA",
    "parsed_columns",
    "payload_schema",
]
