"""One aggregate for all outputs, with late rows kept and corrected.

    source -> admit_readings -> landed table -+-> raw points
                                              `-> states (shortest window) -> points of all analyses
                                                       `-> longer windows  -> points of all analyses
    landed late rows -> correct_late -> newer states and points of the touched windows

``admit_readings`` reads and parses the source once.  Every micro-batch is
put down as one folder, in which rows whose window the watermark has closed
are kept apart (``late=true``).  One streaming aggregate over the rows that
came in time makes the mergeable states of ``operators.states``; all analyses
of that length are projections of them, and every longer window aggregates
states, not readings.  ``correct_late`` merges late rows into the states of
the windows they touch; the points it writes have the keys of the old ones,
and ``read_points`` and ``compact_points`` let the newest win.

Each folder appears by one rename of a finished one and is never written
twice: a micro-batch that is replayed finds its folder and skips, so a reader
of the table sees every row once, whatever failed.

What is late is decided once, at admission: the watermark there is the
latest event time of all earlier batches less the delay.  A stream over the
landed table has seen no more than that, so it refuses nothing that was
admitted; each row is either in an emitted window or in ``late=true``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.points import raw_fields, window_points
from ..operators.states import FROM_STATES, corrected_states, merge_states, window_seconds, window_states
from ..operators.windows import _by_cols, measurement_name
from ..spec import PipelineSpec
from .metrics import PipelineMetrics, observe_points
from .sinks import write_line_protocol, write_points
from .streams import RAW_MEASUREMENT, SinkConfig, StreamSet, _sink_raw, log


# --- small files beside the tables ----------------------------------------


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: beside its place, then renamed into it."""
    fs, p = _fs(spark, path)
    beside = _path(spark, f"{path}.new")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(beside, p):
        raise OSError(f"could not put {path}")


def get_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_folder(df: DataFrame, table: str, name: str, *, partition_by=()) -> None:
    """Write ``df`` as the folder ``name`` of a table, in one rename."""
    spark = df.sparkSession
    staging = f"{table.rstrip('/')}/_staging/{name}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(staging)
    fs, target = _fs(spark, f"{table.rstrip('/')}/{name}")
    if not fs.rename(_path(spark, staging), target):
        raise OSError(f"could not put folder {name} of {table}")


@contextmanager
def settled(df: DataFrame, table: str, name: str) -> Iterator[DataFrame]:
    """``df`` written beside a table and read back, for several outputs of one
    result (and a short plan for each); deleted at the end."""
    spark = df.sparkSession
    place = f"{table.rstrip('/')}/_settled/{name}"
    df.write.mode("overwrite").parquet(place)
    try:
        yield spark.read.schema(df.schema).parquet(place)
    finally:
        fs, p = _fs(spark, place)
        fs.delete(p, True)


def folders(spark: SparkSession, table: str, key: str) -> list[int]:
    """The numbers of the folders ``key=<number>`` of a table, ascending."""
    fs, p = _fs(spark, table)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[len(key) + 1 :]) for n in names if n.startswith(f"{key}="))


# --- admission --------------------------------------------------------------

LANDED_KEYS = [T.StructField("batch_id", T.LongType()), T.StructField("late", T.BooleanType())]


def _admit(batch: DataFrame, batch_id: int, *, spec: PipelineSpec, table: str, window: str, delay: str) -> None:
    spark = batch.sparkSession
    name, mark = f"batch_id={batch_id}", f"{table}/_watermarks/{batch_id}"
    if exists(spark, f"{table}/{name}") and exists(spark, mark):
        return
    before = get_text(spark, f"{table}/_watermarks/{batch_id - 1}")  # NULL: none yet
    closed = F.lit(None if not before else int(before)).cast("long")
    time = F.col(spec.time_col).cast("timestamp")
    length = window_seconds(window) * 1_000_000
    end = (F.floor(F.unix_micros(time) / length) + 1) * length
    seen = Observation(f"admitted_{batch_id}")
    delayed = F.max(F.unix_micros(time - F.expr(f"INTERVAL {delay}"))).alias("mark")
    tagged = batch.withColumn("late", F.coalesce(end <= closed, F.lit(False))).observe(seen, delayed)
    if exists(spark, f"{table}/{name}"):  # put down, but the watermark was not
        tagged.write.format("noop").mode("overwrite").save()
    else:
        put_folder(tagged, table, name, partition_by=("late",))
    found = [x for x in (seen.get["mark"], int(before) if before else None) if x is not None]
    put_text(spark, mark, str(max(found)) if found else "")


def admit_readings(
    parsed: DataFrame,
    spec: PipelineSpec,
    table: str,
    checkpoint: str,
    *,
    window: str | None = None,
    trigger: dict | None = None,
    name: str | None = None,
):
    """Land parsed readings under ``table``, late ones (whose ``window``, the
    shortest of the spec, is closed) in folders ``late=true``.  A reading
    without a time is never late."""
    window = window or min(spec.windows, key=window_seconds)
    fn = partial(_admit, spec=spec, table=table.rstrip("/"), window=window, delay=spec.watermark)
    writer = parsed.writeStream.foreachBatch(fn).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def landed(
    spark: SparkSession, table: str, schema: T.StructType, *, stream: bool = False, late: bool | None = False, max_files: int | None = None
) -> DataFrame:
    """The landed readings (with ``batch_id``): those that came in time, late
    ones, or with ``late=None`` all."""
    whole = T.StructType([*schema.fields, *LANDED_KEYS])
    reader = spark.readStream if stream else spark.read
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.schema(whole).parquet(table)
    if late is not None:
        rows = rows.where(F.col("late") == F.lit(late))
    return rows.drop("late")


# --- states and points ------------------------------------------------------


def _points_of(states: DataFrame, spec: PipelineSpec, window: str, analyses, sink: SinkConfig):
    for a in analyses:
        name = measurement_name(a, window)
        yield name, window_points(FROM_STATES[a](states, spec, window), spec, name, stamp=sink.stamp)


def write_state_points(states: DataFrame, spec: PipelineSpec, window: str, analyses, sink: SinkConfig, *, run: str, batch_id: int, metrics: PipelineMetrics | None = None) -> None:
    """Points of all analyses of some states, one write an analysis; counted
    by ``metrics`` in the pass that writes them."""
    where = {"batch_id": batch_id, "run": run, "end_stamped": sink.stamp == "end"}
    for name, points in _points_of(states, spec, window, analyses, sink):
        seen = Observation()
        if metrics is not None:
            points = points.observe(seen, F.count(F.lit(1)).alias("points"))
        if sink.fmt == "line":
            write_line_protocol(points, sink.path, precision=sink.precision, **where)
        else:
            write_points(points, sink.path, fmt=sink.fmt, observe=False, **where)
        if metrics is not None:
            metrics.count_points(run, name, batch_id, int(seen.get.get("points") or 0))


def _emit(batch: DataFrame, batch_id: int, *, spec: PipelineSpec, window: str, shortest: str, by, analyses, sink: SinkConfig, states: str, metrics: PipelineMetrics | None) -> None:
    spark = batch.sparkSession
    run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    table, name = state_table(states, window), f"batch_id={batch_id}"
    if not exists(spark, f"{table}/{name}"):  # the stateful plan runs once
        put_folder(batch.withColumn("start", F.col("window.start")), table, name)
    emitted = spark.read.schema(batch.schema).parquet(f"{table}/{name}")
    late = late_states(spark, batch.schema, states, shortest)
    if late is None:
        write_state_points(emitted, spec, window, analyses, sink, run=run, batch_id=batch_id, metrics=metrics)
        return
    # late rows that a correction has taken in before
    whole = corrected_states(late if window == shortest else merge_states(late, spec, window, by=by), emitted, spec, by=by)
    with settled(whole, table, name) as known:
        write_state_points(known, spec, window, analyses, sink, run=run, batch_id=batch_id, metrics=metrics)


def state_table(base: str, window: str) -> str:
    return f"{base.rstrip('/')}/{window.replace(' ', '_')}"


def start_state_streams(
    spark: SparkSession,
    spec: PipelineSpec,
    table: str,
    schema: T.StructType,
    states: str,
    sink: SinkConfig,
    checkpoint_base: str,
    *,
    windows=None,
    analyses=("basic", "anomaly", "health"),
    raw: bool = True,
    by=(),
    trigger: dict | None = None,
    raw_trigger: dict | None = None,
    max_files: int | None = None,
    wait: bool = False,
    metrics: PipelineMetrics | None = None,
) -> StreamSet:
    """Start the raw stream, the state stream of the shortest window and a
    stream of states for every longer one.  ``schema`` is that of the landed
    readings, ``states`` the folder of the state tables.

    With ``wait`` each stream ends before the next starts (for
    ``availableNow`` runs, in which a longer window must find its states)."""
    by = _by_cols(by)
    windows = sorted(windows or spec.windows, key=window_seconds)
    shortest = windows[0]
    trigger = trigger or {"processingTime": "15 seconds"}
    result = StreamSet()

    def start(name: str, frame: DataFrame, fn, every: dict) -> None:
        q = (
            frame.writeStream.queryName(name).foreachBatch(fn).outputMode("append")
            .option("checkpointLocation", os.path.join(checkpoint_base, name)).trigger(**every).start()
        )
        result.queries.append(q)
        if wait:
            q.awaitTermination()

    readings = landed(spark, table, schema, stream=True, max_files=max_files).drop("batch_id")
    state_schema = window_states(spark.createDataFrame([], schema), spec, shortest, by=by).schema
    plans = []
    if raw:
        fn = partial(_sink_raw, spec=spec, measurement=RAW_MEASUREMENT, sink=sink)
        whole = landed(spark, table, schema, stream=True, late=None, max_files=max_files).drop("batch_id")
        whole = observe_points(whole, RAW_MEASUREMENT, raw_fields(whole, spec))
        plans.append(("raw", lambda: whole, fn, raw_trigger or {"processingTime": "5 seconds"}))
    for w in windows:
        fn = partial(_emit, spec=spec, window=w, shortest=shortest, by=by, analyses=analyses, sink=sink, states=states, metrics=metrics)
        if w == shortest:
            plans.append((f"states_{w.replace(' ', '_')}", lambda: window_states(readings, spec, shortest, by=by), fn, trigger))
        else:
            build = partial(_longer_stream, spark, spec, state_table(states, shortest), state_schema, w, by)
            plans.append((f"states_{w.replace(' ', '_')}", build, fn, trigger))
    for name, build, fn, every in plans:
        try:
            start(name, build(), fn, every)
        except Exception as e:  # noqa: BLE001 - isolate one failed start from the rest
            log.error("failed to start %s: %s", name, e)
            result.errors[name] = e
    return result


def _longer_stream(spark: SparkSession, spec: PipelineSpec, table: str, schema: T.StructType, window: str, by) -> DataFrame:
    """States of a longer window from the table of emitted ones.  An emitted
    window never starts before one emitted earlier, so no delay is needed."""
    fs, p = _fs(spark, table)
    fs.mkdirs(p)
    fields = [*schema.fields, T.StructField("start", T.TimestampType()), T.StructField("batch_id", T.LongType())]
    rows = spark.readStream.schema(T.StructType(fields)).parquet(table).withWatermark("start", "0 seconds")
    return merge_states(rows, spec, window, by=by, time=F.col("start"))


# --- corrections ------------------------------------------------------------


def _late_table(states: str, shortest: str) -> str:
    return f"{state_table(states, shortest)}_late"


def late_states(spark: SparkSession, schema: T.StructType, states: str, shortest: str) -> DataFrame | None:
    """States of the late readings alone, of all corrections so far."""
    table = _late_table(states, shortest)
    if not folders(spark, table, "version"):
        return None
    return spark.read.schema(schema).parquet(table).select(*schema.names)


def current_states(spark: SparkSession, spec: PipelineSpec, schema: T.StructType, states: str, window: str, by=()) -> DataFrame:
    """States of the shortest window: what the stream has emitted, merged with
    the late readings taken in by corrections."""
    found = spark.read.schema(schema).parquet(state_table(states, window)).select(*schema.names)
    late = late_states(spark, schema, states, window)
    return found if late is None else merge_states(found.unionByName(late), spec, by=_by_cols(by))


def correct_late(
    spark: SparkSession,
    spec: PipelineSpec,
    table: str,
    schema: T.StructType,
    states: str,
    sink: SinkConfig,
    *,
    windows=None,
    analyses=("basic", "anomaly", "health"),
    by=(),
    metrics: PipelineMetrics | None = None,
) -> int:
    """Take in the late readings landed since the last correction: keep their
    states, and write the points of the windows (of all lengths) that they
    touch anew.  Emitted states are merged, readings in time are not read
    again.  Returns the number of this correction, 0 if nothing was landed.

    Late states appear in one rename; points are written behind it under the
    number of the correction, so a run that breaks off is taken up where it
    stopped and doubles nothing.  A window that is emitted later finds the late
    states and takes them in.  Run it while the state streams are at rest
    (after an ``availableNow`` run), as both write points of one window."""
    by = _by_cols(by)
    windows = sorted(windows or spec.windows, key=window_seconds)
    shortest = windows[0]
    kept = _late_table(states, shortest)
    state_schema = window_states(spark.createDataFrame([], schema), spec, shortest, by=by).schema
    done = folders(spark, kept, "version")
    number = done[-1] if done else 0
    if not done or exists(spark, f"{kept}/_points/{number}"):
        last = int(get_text(spark, f"{kept}/_upto/{number}")) if done else -1
        batches = [b for b in folders(spark, table, "batch_id") if b > last]
        if not batches:
            return 0
        number += 1
        rows = landed(spark, table, schema, late=True)
        rows = rows.where((F.col("batch_id") > last) & (F.col("batch_id") <= batches[-1])).drop("batch_id")
        put_text(spark, f"{kept}/_upto/{number}", str(batches[-1]))
        put_folder(window_states(rows, spec, shortest, by=by), kept, f"version={number}")
    late = spark.read.schema(state_schema).parquet(f"{kept}/version={number}")
    now = current_states(spark, spec, state_schema, states, shortest, by)
    for w in windows:
        key = F.window(F.col("window.start"), w)
        touched = late.select(key.alias("w"), *by).distinct().alias("t")
        same = [F.col(f"t.{k}").eqNullSafe(F.col(f"n.{k}")) for k in ("w", *by)]
        inside = now.withColumn("w", key).alias("n").join(touched, same, "left_semi").drop("w")
        fixed = inside if w == shortest else merge_states(inside, spec, w, by=by)
        with settled(fixed, kept, f"{number}_{w.replace(' ', '_')}") as known:
            write_state_points(known, spec, w, analyses, sink, run="correction", batch_id=number, metrics=metrics)
    put_text(spark, f"{kept}/_points/{number}", "")
    return number
