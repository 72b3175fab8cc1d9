"""Fan-out of streaming analyses over one parsed reading stream.

One streaming query per output: the raw points plus each analysis x
window length.  Every query has its own checkpoint folder, its own
trigger and an idempotent sink; a query that fails to start does not
stop the others (its error is reported); ``run`` waits on *any* query,
so a failure anywhere surfaces at once.

Each query re-reads the source (Structured Streaming has no shared
scan).  For very wide fan-outs ``land_readings`` first lands the parsed
readings once as a Parquet table and the analyses stream from there.
"""

from __future__ import annotations

import logging
import os
import time
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..operators.points import raw_fields, raw_points, window_fields, window_points
from ..operators.windows import ANALYSES, measurement_name
from ..spec import PipelineSpec
from .metrics import observe_points
from .sinks import write_line_protocol, write_points

log = logging.getLogger(__name__)

# --- fixed values: measurement name of raw reading points.
RAW_MEASUREMENT = "raw_sensor_data"


@dataclass(frozen=True)
class SinkConfig:
    """Where and how points are written."""

    path: str
    fmt: str = "parquet"  # parquet | json | line (line-protocol text)
    stamp: str = "end"  # window end or start as point time
    precision: int | None = None  # decimals for line-protocol fields


@dataclass
class StreamSet:
    queries: list = field(default_factory=list)
    errors: dict = field(default_factory=dict)


# The sinks make exactly one pass over the micro-batch: an extra action such
# as ``isEmpty()`` would re-read the source (and double its input metrics).
# An empty batch writes no partition, so it replaces nothing.
def _sink_raw(batch_df: DataFrame, batch_id: int, *, spec: PipelineSpec, measurement: str, sink: SinkConfig):
    pts = raw_points(batch_df, spec, measurement)
    _write(pts, batch_id, sink)


def _sink_window(batch_df: DataFrame, batch_id: int, *, spec: PipelineSpec, measurement: str, sink: SinkConfig):
    pts = window_points(batch_df, spec, measurement, stamp=sink.stamp)
    _write(pts, batch_id, sink, end_stamped=sink.stamp == "end")


def _write(points: DataFrame, batch_id: int, sink: SinkConfig, end_stamped: bool = False):
    # the id of the query lives in its checkpoint: a new checkpoint is a new run
    run = points.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    where = {"batch_id": batch_id, "run": run, "end_stamped": end_stamped}
    if sink.fmt == "line":
        write_line_protocol(points, sink.path, precision=sink.precision, **where)
    else:
        write_points(points, sink.path, fmt=sink.fmt, observe=False, **where)


def plan_streams(
    parsed: DataFrame,
    spec: PipelineSpec,
    *,
    windows=None,
    analyses=("basic", "anomaly", "health"),
    raw: bool = True,
    by=(),
) -> dict[str, tuple]:
    """Name -> (builder of the streaming result, measurement) per output.
    Builders are called lazily so one bad output cannot stop the others."""
    out: dict[str, tuple] = {}
    if raw:
        out["raw"] = (lambda: parsed, RAW_MEASUREMENT)
    for w in windows or spec.windows:
        for a in analyses:
            m = measurement_name(a, w)
            out[m] = (partial(ANALYSES[a], parsed, spec, w, by=by), m)
    return out


def start_streams(
    parsed: DataFrame,
    spec: PipelineSpec,
    sink: SinkConfig,
    checkpoint_base: str,
    *,
    windows=None,
    analyses=("basic", "anomaly", "health"),
    raw: bool = True,
    raw_trigger: dict | None = None,
    window_trigger: dict | None = None,
    by=(),
    query_prefix: str = "",
) -> StreamSet:
    """Start one query per output and return them with start errors.

    Building and starting each query is isolated: a failure is logged and
    reported in ``StreamSet.errors`` and the other queries still start.
    Triggers are ``DataStreamWriter.trigger`` keyword dicts, e.g.
    ``{"processingTime": "5 seconds"}`` (default raw) /
    ``{"processingTime": "15 seconds"}`` (default windows), or
    ``{"availableNow": True}`` for a bounded catch-up run.

    Every output counts its points (``metrics.observe_points``); records and
    rejected documents are counted where ``parsed`` is observed by
    ``metrics.observe_readings``."""
    raw_trigger = raw_trigger or {"processingTime": "5 seconds"}
    window_trigger = window_trigger or {"processingTime": "15 seconds"}
    result = StreamSet()
    for name, (build, measurement) in plan_streams(
        parsed, spec, windows=windows, analyses=analyses, raw=raw, by=by
    ).items():
        is_raw = name == "raw"
        fn = partial(_sink_raw if is_raw else _sink_window, spec=spec, measurement=measurement, sink=sink)
        try:
            rows = build()
            fields = raw_fields(rows, spec) if is_raw else window_fields(rows, spec)
            q = (
                observe_points(rows, measurement, fields)
                .writeStream.queryName(f"{query_prefix}{name}")
                .foreachBatch(fn)
                .outputMode("append")
                .option("checkpointLocation", os.path.join(checkpoint_base, name))
                .trigger(**(raw_trigger if is_raw else window_trigger))
                .start()
            )
            result.queries.append(q)
        except Exception as e:  # noqa: BLE001 - isolate one failed start from the rest
            log.error("failed to start %s: %s", name, e)
            result.errors[name] = e
    return result


def run(spark: SparkSession, streams: StreamSet, timeout: float | None = None, poll: float = 1.0) -> None:
    """Wait until any of these queries ends (or ``timeout`` seconds), then
    stop the rest in reverse start order; re-raise the first failure.

    Waits on its own queries only: the session-wide
    ``awaitAnyTermination`` also returns for unrelated queries that ended
    earlier in the session."""
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        while streams.queries and all(q.isActive for q in streams.queries):
            if deadline is not None and time.monotonic() >= deadline:
                break
            streams.queries[0].awaitTermination(poll)
    finally:
        stop_all(streams)
    for q in streams.queries:
        err = q.exception()
        if err is not None:
            raise err


def stop_all(streams: StreamSet) -> None:
    for q in reversed(streams.queries):
        if q.isActive:
            q.stop()


def await_all(streams: StreamSet) -> None:
    """Wait for every query (for bounded ``availableNow`` runs)."""
    try:
        for q in streams.queries:
            q.awaitTermination()
    finally:  # one that failed ends the others too
        stop_all(streams)
    for q in streams.queries:
        err = q.exception()
        if err is not None:
            raise err


def land_readings(parsed: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None):
    """Land parsed readings once as an append-only Parquet table, so many
    analyses can stream from it instead of each re-parsing the source."""
    return (
        parsed.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
