"""Readings and window results -> clean time-series points.

A point is ``(measurement, tags..., time, fields...)``: fields are finite
doubles (NULL, NaN and +/-Infinity are dropped per field) and a point
without any valid field is dropped.  Everything stays a column expression,
so building points is one projection + filter fused into the upstream
stage; the long form is an ``unpivot`` (Expand), which also needs no
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import epoch_nanos, finite
from ..spec import PipelineSpec

POINT_KEYS = ("measurement", "time")


def _system_tag(df: DataFrame, spec: PipelineSpec):
    if "kafka_key" in df.columns:
        src = F.col("kafka_key").cast("string")
    elif spec.system_col in df.columns:
        src = F.col(spec.system_col).cast("string")
    else:
        src = F.lit(None).cast("string")
    return F.coalesce(src, F.lit(spec.default_system)).alias("system_id")


def raw_fields(df: DataFrame, spec: PipelineSpec) -> list[str]:
    """Columns of parsed readings that become fields of raw points."""
    return [c for c in spec.sensor_names + [n for n, _ in spec.state_fields] if c in df.columns]


def window_fields(df: DataFrame, spec: PipelineSpec, tags=("analysis_type", "window_duration"), window_col: str = "window") -> list[str]:
    """Columns of window results that become fields of their points."""
    other = {*tags, spec.system_col, window_col}
    return [f.name for f in df.schema.fields if f.name not in other and isinstance(f.dataType, T.NumericType)]


def raw_points(df: DataFrame, spec: PipelineSpec, measurement: str = "raw_sensor_data", *, keep=()) -> DataFrame:
    """Parsed readings -> raw points (wide: one column per field).

    ``time`` = event time, else the reading's own epoch-ms stamp, else the
    current time; ``system_id`` tag = record key (or system column), else
    the spec default.  Fields: the sensors and state fields present.  Columns
    in ``keep`` are carried along (to order points, for example)."""
    fields = raw_fields(df, spec)
    if not fields:
        raise ValueError("raw_points: no spec field present")
    times = []
    if spec.time_col in df.columns:
        times.append(F.col(spec.time_col).cast("timestamp"))
    if "sensor_timestamp" in df.columns:
        times.append(F.timestamp_millis(F.col("sensor_timestamp")))
    times.append(F.current_timestamp())
    out = df.select(
        F.lit(measurement).alias("measurement"),
        _system_tag(df, spec),
        F.coalesce(*times).alias("time"),
        *[finite(c).alias(c) for c in fields],
        *keep,
    )
    return out.where(F.coalesce(*[F.col(c) for c in fields]).isNotNull())


def window_points(
    df: DataFrame,
    spec: PipelineSpec,
    measurement: str,
    *,
    stamp: str = "end",
    tags=("analysis_type", "window_duration"),
    window_col: str = "window",
) -> DataFrame:
    """Window results -> points.

    ``time`` is the window end (``stamp='end'``) or start; string columns
    named in ``tags`` (and any grouping column listed there) become tags;
    every other numeric column becomes a double field.  The system column is
    always the ``system_id`` tag, whatever its type."""
    if stamp not in ("end", "start"):
        raise ValueError("stamp must be 'end' or 'start'")
    tag_cols = [t for t in tags if t in df.columns]
    fields = window_fields(df, spec, tags, window_col)
    if not fields:
        raise ValueError("window_points: no numeric column")
    if window_col in df.columns:
        t = F.col(f"{window_col}.{stamp}").cast("timestamp")
    else:
        t = F.col(f"{window_col}_{stamp}").cast("timestamp")
    sys_tag = (
        F.coalesce(F.col(spec.system_col).cast("string"), F.lit(spec.default_system)).alias("system_id")
        if spec.system_col in df.columns
        else F.lit(spec.default_system).alias("system_id")
    )
    out = df.select(
        F.lit(measurement).alias("measurement"),
        sys_tag,
        *[F.col(c).cast("string").alias(c) for c in tag_cols if c != spec.system_col],
        F.coalesce(t, F.current_timestamp()).alias("time"),
        *[finite(c).alias(c) for c in fields],
    )
    return out.where(F.coalesce(*[F.col(c) for c in fields]).isNotNull())


def point_fields(points: DataFrame) -> list[str]:
    """Field columns of a wide point DataFrame (the double columns)."""
    return [f.name for f in points.schema.fields if isinstance(f.dataType, T.DoubleType)]


def point_tags(points: DataFrame) -> list[str]:
    return [
        f.name
        for f in points.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name != "measurement"
    ]


def newest_points(points: DataFrame, stamp: Column, *, ignore=()) -> DataFrame:
    """One point per (measurement, tags, time), as a time-series store keeps
    it: every field has its newest non-NULL value by ``stamp`` (a column that
    orders writes; equal stamps must carry equal values).

    One partial aggregate: a point that was written very often is one row a
    task before the shuffle.  Columns in ``ignore`` are left out."""
    fields = point_fields(points)
    keys = ["measurement", *[t for t in point_tags(points) if t not in ignore], "time"]
    rows = points.select(*keys, *fields, stamp.alias("__stamp"))
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__stamp"))).alias(c) for c in fields]
    return rows.groupBy(*keys).agg(*newest)


def points_long(points: DataFrame) -> DataFrame:
    """Wide points -> one row per (point, field) with a non-NULL value."""
    fields = point_fields(points)
    ids = ["measurement", *point_tags(points), "time"]
    return points.unpivot(ids, fields, "field", "value").where(F.col("value").isNotNull())


def _escape(c, chars: str):
    return F.regexp_replace(c, f"([{chars}])", r"\\$1")


def line_expr(points: DataFrame, *, precision: int | None = None):
    """Line-protocol text of a wide point row as a column expression:
    ``measurement,tag=v field=1.5,other=2.0 <epoch ns>``.

    Tags with a NULL or empty value are omitted; measurement and tag text
    are escaped.  ``precision`` fixes the number of decimals of the field
    values (default: Spark's shortest round-trip text)."""
    fields = point_fields(points)
    tags = point_tags(points)
    head = [_escape(F.col("measurement"), ", ")]
    for t in tags:
        v = F.col(t)
        head.append(F.when(v.isNotNull() & (v != ""), F.concat(F.lit(f"{t}="), _escape(v, ", ="))))

    def fmt(c):
        if precision is None:
            return F.col(c).cast("string")
        return F.format_string(f"%.{int(precision)}f", F.col(c))

    body = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), fmt(c))) for c in fields]
    return F.concat_ws(
        " ",
        F.concat_ws(",", *head),
        F.concat_ws(",", *body),
        epoch_nanos("time").cast("string"),
    )


def line_protocol(points: DataFrame, *, precision: int | None = None) -> DataFrame:
    """Wide points -> one line-protocol text line per point (``line``)."""
    return points.select(line_expr(points, precision=precision).alias("line"))
