"""Tumbling-window analyses: basic statistics, range anomalies, health.

Each operator is ``DataFrame -> DataFrame`` and works unchanged on batch
and streaming input.  On a stream the event-time watermark is attached
first, so append mode emits a window once, after the watermark passes its
end; on a batch the watermark is skipped (it has no effect there).

Plan shape: one ``HashAggregate(partial)`` per input partition, an
``Exchange hashpartitioning(window, by...)`` and a final merge.  Every
aggregate is algebraic (sum / count / min / max / central moments), so the
map side reduces each partition to one row per window before the shuffle
and a hot window (or a hot system) never concentrates raw rows in one
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import health_score, mean_of, mean_of_present, range_flag
from ..spec import PipelineSpec

# --- fixed values: analysis labels (``analysis_type``) and the measurement
# --- prefixes points of each analysis are written under.
ANALYSIS_TYPE = {"basic": "basic_aggregation", "anomaly": "anomaly_detection", "health": "system_health"}
MEASUREMENT_PREFIX = {"basic": "aggregations", "anomaly": "anomalies", "health": "health"}


def _windowed(df: DataFrame, spec: PipelineSpec, window: str, watermark: str | None):
    time_col = spec.time_col
    if time_col not in df.columns:
        raise ValueError(f"time column {time_col!r} not in {df.columns}")
    if df.isStreaming:
        delay = spec.watermark if watermark is None else watermark
        if delay:
            df = df.withWatermark(time_col, delay)
    return df, F.window(F.col(time_col), window)


def _by_cols(by) -> list[str]:
    if isinstance(by, str):
        return [by]
    return list(by or [])


def basic_aggregation(
    df: DataFrame,
    spec: PipelineSpec,
    window: str = "5 minutes",
    *,
    by=(),
    watermark: str | None = None,
) -> DataFrame:
    """Average, minimum, maximum, sample standard deviation and non-NULL
    count of every sensor (and the activity column) per tumbling window.

    Output: ``window``, ``by``..., ``{c}_avg/_min/_max/_stddev/_count`` per
    column, ``window_duration``, ``analysis_type``.  Aggregates skip NULL but
    not NaN (clean readings first to drop NaN).
    """
    cols = [c for c in spec.aggregate_columns if c in df.columns]
    if not cols:
        raise ValueError(f"none of the spec columns {spec.aggregate_columns} is present in {df.columns}")
    by = _by_cols(by)
    df, win = _windowed(df, spec, window, watermark)
    aggs = []
    for c in cols:
        aggs += [
            F.avg(c).alias(f"{c}_avg"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
            F.stddev_samp(c).alias(f"{c}_stddev"),
            F.count(c).alias(f"{c}_count"),
        ]
    return (
        df.groupBy(win.alias("window"), *by)
        .agg(*aggs)
        .withColumns({"window_duration": F.lit(window), "analysis_type": F.lit(ANALYSIS_TYPE["basic"])})
    )


def anomaly_detection(
    df: DataFrame,
    spec: PipelineSpec,
    window: str = "5 minutes",
    *,
    by=(),
    watermark: str | None = None,
    with_duration: bool = False,
) -> DataFrame:
    """Per window: number of readings outside each sensor's inclusive range
    (``{s}_range_anomaly``) and the number of rows (``total_readings``).

    A missing reading is not an anomaly; NaN is.  Like the original, the
    output has no ``window_duration`` column unless ``with_duration``.
    """
    sensors = spec.present(df.columns)
    by = _by_cols(by)
    df, win = _windowed(df, spec, window, watermark)
    aggs = [F.sum(range_flag(s.name, s)).alias(f"{s.name}_range_anomaly") for s in sensors]
    aggs.append(F.count(F.lit(1)).alias("total_readings"))
    out = df.groupBy(win.alias("window"), *by).agg(*aggs)
    if with_duration:
        out = out.withColumn("window_duration", F.lit(window))
    return out.withColumn("analysis_type", F.lit(ANALYSIS_TYPE["anomaly"]))


def system_health(
    df: DataFrame,
    spec: PipelineSpec,
    window: str = "5 minutes",
    *,
    by=(),
    watermark: str | None = None,
    missing: str = "zero",
) -> DataFrame:
    """Per window: average health score of each present sensor, average
    overall health (mean over the sensor columns present), average activity
    and row count.  A missing reading scores 0 (``missing="zero"``) or
    has no score (``"skip"``): the overall health of a row is then the mean
    of the scores it has, NULL if none."""
    if missing not in ("zero", "skip"):
        raise ValueError(f"missing must be 'zero' or 'skip', not {missing!r}")
    sensors = spec.present(df.columns)
    if not sensors:
        raise ValueError(
            f"system_health needs at least one sensor column of {spec.sensor_names}; got {df.columns}"
        )
    by = _by_cols(by)
    df, win = _windowed(df, spec, window, watermark)
    scores = {s.name: health_score(s.name, s) for s in sensors}
    if missing == "skip":
        scores = {n: F.when(F.col(n).isNotNull(), e) for n, e in scores.items()}
    overall = (mean_of if missing == "zero" else mean_of_present)(list(scores.values()))
    aggs = [F.avg(e).alias(f"avg_{n}_health_score") for n, e in scores.items()]
    aggs.append(F.avg(overall).alias("avg_system_health"))
    if spec.activity and spec.activity in df.columns:
        aggs.append(F.avg(spec.activity).alias(f"avg_{spec.activity}"))
    else:
        aggs.append(F.lit(None).cast("double").alias(f"avg_{spec.activity or 'activity'}"))
    aggs.append(F.count(F.lit(1)).alias("total_readings"))
    return (
        df.groupBy(win.alias("window"), *by)
        .agg(*aggs)
        .withColumns({"window_duration": F.lit(window), "analysis_type": F.lit(ANALYSIS_TYPE["health"])})
    )


ANALYSES = {
    "basic": basic_aggregation,
    "anomaly": anomaly_detection,
    "health": system_health,
}

def measurement_name(analysis: str, window: str) -> str:
    """``aggregations_5_minutes`` style measurement name for a window."""
    return f"{MEASUREMENT_PREFIX[analysis]}_{window.replace(' ', '_')}"


def flatten_window(df: DataFrame, name: str = "window") -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` / ``window_end``."""
    cols = []
    for c in df.columns:
        q = "`" + c.replace("`", "``") + "`"
        if c == name:
            cols += [f"{q}.start AS `{name}_start`", f"{q}.end AS `{name}_end`"]
        else:
            cols.append(q)
    return df.selectExpr(*cols)
