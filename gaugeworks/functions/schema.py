"""Schemas derived from a ``PipelineSpec``."""

from __future__ import annotations

from pyspark.sql import types as T

from ..spec import PipelineSpec

_TYPES = {
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "string": T.StringType(),
}


def spark_type(name: str) -> T.DataType:
    try:
        return _TYPES[name.lower()]
    except KeyError:
        raise ValueError(f"unsupported state field type {name!r}") from None


def payload_schema(spec: PipelineSpec) -> T.StructType:
    """JSON payload of one reading: epoch-millisecond ``timestamp``, a
    ``sensors`` struct of doubles and a ``system_state`` struct. All
    fields are nullable, so malformed fields parse to NULL individually."""
    sensors = T.StructType([T.StructField(s.name, T.DoubleType(), True) for s in spec.sensors])
    state = T.StructType([T.StructField(n, spark_type(t), True) for n, t in spec.state_fields])
    fields = [
        T.StructField("timestamp", T.LongType(), True),
        T.StructField("sensors", sensors, True),
    ]
    if spec.state_fields:
        fields.append(T.StructField("system_state", state, True))
    return T.StructType(fields)


def parsed_columns(spec: PipelineSpec) -> list[str]:
    """Column order of a parsed reading."""
    return (
        ["kafka_timestamp", "kafka_key", "sensor_timestamp"]
        + spec.sensor_names
        + [n for n, _ in spec.state_fields]
        + [spec.time_col]
    )


ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)
