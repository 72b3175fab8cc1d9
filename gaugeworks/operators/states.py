"""Mergeable window states: one aggregate for all analyses and lengths.

A *state* row holds, per window (and ``by`` keys), what all three analyses
need and nothing else: for every aggregated column ``{c}_n, {c}_sum, {c}_m2,
{c}_min, {c}_max`` (``m2`` is the sum of squared distances from the mean), for
every sensor ``{s}_out`` (readings out of range), ``{s}_score`` and
``{s}_scored`` (sum and number of health scores), and ``health_sum``,
``health_n``, ``readings``.  ``basic_from``, ``anomaly_from`` and
``health_from`` turn states into exactly the columns of
``basic_aggregation``, ``anomaly_detection`` and ``system_health``.

Two states of one key merge without the readings: counts and sums add, and

    M2 = sum(m2_i) + sum(n_i * d_i^2) - sum(n_i * d_i)^2 / sum(n_i)

with ``d_i = mean_i - shift`` is the parallel-variance formula.  ``shift`` is a
constant of the column (the middle of the sensor's range), so ``d_i`` is small
for readings anywhere near their range and nothing cancels; all terms are
sums, so merging is a partial aggregate like any other and a key with very
many states is never gathered.

Plan: ``window_states`` reads the source once and has one exchange, of one
partial row per input partition and key; every merge adds an exchange of
states only.  Missing keys of ``by`` can be merged away (``by=()`` over states
by system).  All functions work on batch and stream; on a stream
``merge_states`` chains a second (third, ...) stateful operator through
``window_time``, the event time that Spark gives an emitted window.

Defined cases: a NULL time is in no window; NULL readings are skipped and NaN
readings poison the column's sums as in the separate analyses; a state without
readings of a column has n = 0 and NULL sums; an empty table has no states.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import health_score, mean_of, mean_of_present, range_flag
from ..spec import PipelineSpec
from .windows import ANALYSIS_TYPE, _by_cols, _windowed

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}


def window_seconds(window: str) -> int:
    """Length of a window text such as ``15 minutes`` in seconds."""
    found = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day|week)s?\s*", window)
    if not found:
        raise ValueError(f"not a window length: {window!r}")
    return int(found[1]) * _UNITS[found[2]]


def _shift(spec: PipelineSpec, column: str) -> float:
    return next((s.centre for s in spec.sensors if s.name == column), 0.5)


def _columns(spec: PipelineSpec, present) -> tuple[list[str], list[str]]:
    """Aggregated columns and sensors that exist, in the order of the spec."""
    return [c for c in spec.aggregate_columns if c in present], [s.name for s in spec.present(present)]


def window_states(
    df: DataFrame,
    spec: PipelineSpec,
    window: str = "5 minutes",
    *,
    by=(),
    watermark: str | None = None,
    missing: str = "zero",
) -> DataFrame:
    """Readings -> one state row per window (and ``by`` keys).

    ``missing`` is that of ``system_health``: a missing reading scores 0
    (``"zero"``) or has no score (``"skip"``)."""
    if missing not in ("zero", "skip"):
        raise ValueError(f"missing must be 'zero' or 'skip', not {missing!r}")
    columns, sensors = _columns(spec, df.columns)
    if not columns:
        raise ValueError(f"none of the spec columns {spec.aggregate_columns} is present in {df.columns}")
    by = _by_cols(by)
    df, win = _windowed(df, spec, window, watermark)
    aggs: list[Column] = []
    for c in columns:
        aggs += [
            F.count(c).alias(f"{c}_n"),
            F.sum(F.col(c).cast("double")).alias(f"{c}_sum"),
            (F.var_pop(c) * F.count(c)).alias(f"{c}_m2"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    scores = {n: health_score(n, spec.sensor(n)) for n in sensors}
    if missing == "skip":
        scores = {n: F.when(F.col(n).isNotNull(), e) for n, e in scores.items()}
    for n, score in scores.items():
        aggs += [
            F.sum(range_flag(n, spec.sensor(n))).alias(f"{n}_out"),
            F.sum(score).alias(f"{n}_score"),
            F.count(score).alias(f"{n}_scored"),
        ]
    if scores:
        overall = (mean_of if missing == "zero" else mean_of_present)(list(scores.values()))
        aggs += [F.sum(overall).alias("health_sum"), F.count(overall).alias("health_n")]
    aggs.append(F.count(F.lit(1)).alias("readings"))
    return df.groupBy(win.alias("window"), *by).agg(*aggs)


def state_columns(spec: PipelineSpec, present) -> tuple[list[str], list[str]]:
    """Aggregated columns and sensors whose states are among ``present``."""
    held = {c[: -len("_m2")] for c in present if c.endswith("_m2")}
    scored = {c[: -len("_scored")] for c in present if c.endswith("_scored")}
    return [c for c in spec.aggregate_columns if c in held], [s.name for s in spec.sensors if s.name in scored]


def _merged(spec: PipelineSpec, present) -> list[Column]:
    columns, sensors = state_columns(spec, present)
    out: list[Column] = []
    for c in columns:
        n, total = F.col(f"{c}_n"), F.col(f"{c}_sum")
        distance = total / F.nullif(n, F.lit(0)) - F.lit(_shift(spec, c))  # NULL without readings
        first, second = F.sum(n * distance), F.sum(n * distance * distance)
        m2 = F.sum(f"{c}_m2") + second - first * first / F.nullif(F.sum(n), F.lit(0))
        out += [
            F.sum(n).alias(f"{c}_n"),
            F.sum(total).alias(f"{c}_sum"),
            F.when(F.sum(n) > 0, F.greatest(m2, F.lit(0.0))).alias(f"{c}_m2"),
            F.min(f"{c}_min").alias(f"{c}_min"),
            F.max(f"{c}_max").alias(f"{c}_max"),
        ]
    for s in sensors:
        out += [F.sum(f"{s}_{x}").alias(f"{s}_{x}") for x in ("out", "score", "scored")]
    if sensors:
        out += [F.sum("health_sum").alias("health_sum"), F.sum("health_n").alias("health_n")]
    out.append(F.sum("readings").alias("readings"))
    return out


def merge_states(
    states: DataFrame, spec: PipelineSpec, window: str | None = None, *, by=(), time: Column | None = None
) -> DataFrame:
    """States -> states of a longer window and / or fewer keys; with
    ``window=None`` states of equal windows are merged (partial states of the
    same window from several batches).

    The window must be a multiple of the length of the states' windows: one
    that a longer window would cut fails the query, as its readings are gone.
    ``time`` is the event time of a state where a stream of states does not
    come from an aggregate in the same query (a column with a watermark)."""
    by = _by_cols(by)
    aggs = _merged(spec, states.columns)
    if window is None:
        return states.groupBy("window", *by).agg(*aggs)
    length = F.unix_micros(F.col("window.end").cast("timestamp")) - F.unix_micros(F.col("window.start").cast("timestamp"))
    fits = F.lit(window_seconds(window) * 1_000_000) % length == 0
    wrong = F.raise_error(F.lit(f"states do not fill windows of {window}")).cast("boolean")
    states = states.where(F.when(fits, F.lit(True)).otherwise(wrong))
    if time is None:
        time = F.window_time(F.col("window")) if states.isStreaming else F.col("window.start")
    return states.groupBy(F.window(time, window).alias("window"), *by).agg(*aggs)


def _keys(states: DataFrame, spec: PipelineSpec) -> list[str]:
    columns, sensors = state_columns(spec, states.columns)
    own = {f"{c}_{x}" for c in columns for x in ("n", "sum", "m2", "min", "max")}
    own |= {f"{s}_{x}" for s in sensors for x in ("out", "score", "scored")} | {"health_sum", "health_n", "readings"}
    return [c for c in states.columns if c not in own]


def _mean(total: str, n: str) -> Column:
    return F.when(F.col(n) > 0, F.col(total) / F.col(n))


def basic_columns(spec: PipelineSpec, present) -> list[Column]:
    out = []
    for c in state_columns(spec, present)[0]:
        n, m2 = F.col(f"{c}_n"), F.col(f"{c}_m2")
        out += [
            _mean(f"{c}_sum", f"{c}_n").alias(f"{c}_avg"),
            F.col(f"{c}_min"),
            F.col(f"{c}_max"),
            F.when(n > 1, F.sqrt(m2 / (n - 1))).alias(f"{c}_stddev"),
            n.alias(f"{c}_count"),
        ]
    return out


def anomaly_columns(spec: PipelineSpec, present) -> list[Column]:
    return [F.col(f"{s}_out").alias(f"{s}_range_anomaly") for s in state_columns(spec, present)[1]]


def health_columns(spec: PipelineSpec, present) -> list[Column]:
    columns, sensors = state_columns(spec, present)
    if not sensors:
        raise ValueError(f"system_health needs at least one sensor of {spec.sensor_names}; got {list(present)}")
    out = [_mean(f"{s}_score", f"{s}_scored").alias(f"avg_{s}_health_score") for s in sensors]
    out.append(_mean("health_sum", "health_n").alias("avg_system_health"))
    name = f"avg_{spec.activity or 'activity'}"
    if spec.activity in columns:
        out.append(_mean(f"{spec.activity}_sum", f"{spec.activity}_n").alias(name))
    else:
        out.append(F.lit(None).cast("double").alias(name))
    return out


def basic_from(states: DataFrame, spec: PipelineSpec, window: str) -> DataFrame:
    """The columns of ``basic_aggregation``."""
    tail = [F.lit(window).alias("window_duration"), F.lit(ANALYSIS_TYPE["basic"]).alias("analysis_type")]
    return states.select(*_keys(states, spec), *basic_columns(spec, states.columns), *tail)


def anomaly_from(states: DataFrame, spec: PipelineSpec, window: str) -> DataFrame:
    """The columns of ``anomaly_detection``."""
    tail = [F.col("readings").alias("total_readings"), F.lit(ANALYSIS_TYPE["anomaly"]).alias("analysis_type")]
    return states.select(*_keys(states, spec), *anomaly_columns(spec, states.columns), *tail)


def health_from(states: DataFrame, spec: PipelineSpec, window: str) -> DataFrame:
    """The columns of ``system_health``."""
    tail = [
        F.col("readings").alias("total_readings"),
        F.lit(window).alias("window_duration"),
        F.lit(ANALYSIS_TYPE["health"]).alias("analysis_type"),
    ]
    return states.select(*_keys(states, spec), *health_columns(spec, states.columns), *tail)


FROM_STATES = {"basic": basic_from, "anomaly": anomaly_from, "health": health_from}


def combined_from(states: DataFrame, spec: PipelineSpec, window: str) -> DataFrame:
    """All three analyses in one row: statistics, anomalies, health scores,
    ``total_readings``, ``window_duration``."""
    present = states.columns
    return states.select(
        *_keys(states, spec),
        *basic_columns(spec, present),
        *anomaly_columns(spec, present),
        *health_columns(spec, present),
        F.col("readings").alias("total_readings"),
        F.lit(window).alias("window_duration"),
    )


def corrected_states(states: DataFrame, late: DataFrame, spec: PipelineSpec, *, by=()) -> DataFrame:
    """New states of the windows that late rows touch: the emitted state, if
    there is one, merged with the states of the late rows (``late`` is a table
    of states, see ``window_states``).  Untouched windows are not returned, and
    readings of emitted windows are not read again."""
    by = _by_cols(by)
    touched = late.select("window", *by).distinct()
    same = reduce(and_, [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in ("window", *by)])
    old = states.alias("s").join(touched.alias("t"), same, "left_semi")
    return merge_states(old.unionByName(late), spec, by=by)
