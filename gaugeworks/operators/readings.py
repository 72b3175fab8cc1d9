"""Per-reading derivations and latest-value aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import daily_factor, expected_light, plant_activity, status_line
from ..spec import PipelineSpec


def with_plant_activity(
    df: DataFrame,
    *,
    light: str = "light_intensity_ppfd",
    temperature: str = "water_temperature",
    ph: str = "water_ph",
    out: str = "plant_activity",
) -> DataFrame:
    """Add the activity score computed from light, temperature and pH."""
    return df.withColumn(out, plant_activity(light, temperature, ph))


def with_schedule(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Add ``hour`` (of the event time), ``daily_factor`` and
    ``expected_light`` for that hour."""
    h = F.hour(F.col(time_col))
    return df.withColumns(
        {"hour": h, "daily_factor": daily_factor(h), "expected_light": expected_light(h)}
    )


def with_status_line(
    df: DataFrame,
    *,
    water_temperature: str = "water_temperature",
    ph: str = "water_ph",
    ec: str = "ec_tds",
    level: str = "water_level_percent",
    activity: str = "plant_activity",
    out: str = "status",
) -> DataFrame:
    """Add a one-line text summary of each reading (``ERROR`` for a
    missing value)."""
    return df.withColumn(out, status_line(water_temperature, ph, ec, level, activity))


def latest_readings(
    df: DataFrame,
    spec: PipelineSpec,
    *,
    sensors: list[str] | None = None,
    by=None,
    tiebreak: str | None = None,
) -> DataFrame:
    """Newest non-NULL value of each sensor per system.

    ``max_by(value, order)`` where the order is ``(event_time, tiebreak)``
    and is NULL on rows where the sensor is missing, so such rows never
    win.  It is an ordinary partial aggregate: each map task keeps one
    candidate per system before the shuffle, whatever the key skew.
    """
    by = [spec.system_col] if by is None else ([by] if isinstance(by, str) else list(by))
    names = sensors or [s for s in spec.sensor_names if s in df.columns]
    t = F.col(spec.time_col)
    aggs = []
    for c in names:
        order = F.struct(t, F.col(tiebreak)) if tiebreak else F.struct(t)
        aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c))
    aggs.append(F.max(t).alias("last_seen"))
    return df.groupBy(*by).agg(*aggs)
