"""Envelope -> typed wide readings, and reading clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import clean_reading
from ..functions.schema import payload_schema
from ..spec import PipelineSpec


def parse_readings(df: DataFrame, spec: PipelineSpec, *, sensors: list[str] | None = None) -> DataFrame:
    """Flatten keyed JSON envelopes into one typed wide row per record.

    Output (in order): ``kafka_timestamp, kafka_key, sensor_timestamp``,
    the sensors, the state fields, and ``event_time`` =
    ``timestamp_millis(sensor_timestamp)`` (integer-exact).

    Parsing is permissive: malformed documents give all-NULL data columns
    and a bad field NULLs only itself, so the stream never fails on input.
    ``sensors`` narrows the schema handed to ``from_json`` when only a few
    sensors are needed (Catalyst prunes top-level JSON fields on its own,
    not fields inside the nested struct).
    """
    if sensors is not None:
        spec = spec.with_(sensors=tuple(spec.sensor(s) for s in sensors))
    schema = payload_schema(spec)
    data = F.from_json(F.col("value").cast("string"), schema)
    state_names = [n for n, _ in spec.state_fields]
    return df.select(
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("kafka_key"),
        data.alias("data"),
    ).select(
        "kafka_timestamp",
        "kafka_key",
        F.col("data.timestamp").alias("sensor_timestamp"),
        *[F.col(f"data.sensors.{s}").alias(s) for s in spec.sensor_names],
        *[F.col(f"data.system_state.{n}").alias(n) for n in state_names],
        F.timestamp_millis(F.col("data.timestamp")).alias(spec.time_col),
    )


def is_rejected(parsed: DataFrame, spec: PipelineSpec) -> Column:
    """True where the document of a parsed row yielded nothing."""
    fields = ["sensor_timestamp"] + spec.sensor_names + [n for n, _ in spec.state_fields]
    return F.coalesce(*[F.col(c).cast("string") for c in fields if c in parsed.columns]).isNull()


def rejected_readings(parsed: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Rows whose document yielded nothing: no time and no field at all
    (malformed JSON).  The main path keeps them (they reach raw points
    with the ingest time), this view lets a pipeline route them apart."""
    return parsed.where(is_rejected(parsed, spec))


def rejected_documents(df: DataFrame, spec: PipelineSpec) -> DataFrame:
    """The records themselves (``key``, ``value`` as text, ``timestamp``)
    whose document yields nothing, as ``rejected_readings`` tells: to be kept
    for repair and replay."""
    data = F.from_json(F.col("value").cast("string"), payload_schema(spec))
    found = ["timestamp", *[f"sensors.{s}" for s in spec.sensor_names], *[f"system_state.{n}" for n, _ in spec.state_fields]]
    fields = F.coalesce(*[F.col(f"__data.{f}").cast("string") for f in found])
    text = [F.col(c).cast("string").alias(c) for c in ("key", "value")]
    return df.withColumn("__data", data).where(fields.isNull()).select(*text, "timestamp")


def nan_to_null(df: DataFrame, spec: PipelineSpec) -> DataFrame:
    """NaN -> NULL for every spec sensor present; values stay as they are."""
    present = {s.name for s in spec.present(df.columns)}
    return df.select(*[F.nanvl(c, F.lit(None)).alias(c) if c in present else F.col(c) for c in df.columns])


def clean_readings(df: DataFrame, spec: PipelineSpec) -> DataFrame:
    """NaN -> NULL and half-even rounding to each sensor's precision, for
    every spec sensor present; other columns pass through unchanged.
    Run before the analyses so NaN does not poison averages and maxima."""
    present = {s.name: s for s in spec.present(df.columns)}
    return df.select(
        *[clean_reading(c, present[c]).alias(c) if c in present else F.col(c) for c in df.columns]
    )


def with_system_id(df: DataFrame, spec: PipelineSpec, key_col: str = "kafka_key") -> DataFrame:
    """Add ``system_id`` = record key, or the spec's default when missing."""
    src = F.col(key_col).cast("string") if key_col in df.columns else F.lit(None).cast("string")
    return df.withColumn(spec.system_col, F.coalesce(src, F.lit(spec.default_system)))
