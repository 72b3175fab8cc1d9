"""Streaming application: source -> parse -> raw points + analyses -> sinks.

    python -m gaugeworks --source kafka --bootstrap broker:9092 --topic sensors \\
        --sink s3://bucket/points --windows "5 minutes" "15 minutes" "1 hour"

The checkpoint base defaults to ``<spark.checkpoint.dir>/gaugeworks``: on a
cluster that setting names a shared folder.  The session is taken from
``SparkSession.builder.getOrCreate()`` so cluster settings from
``spark-submit`` apply unchanged.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from .operators.control import control_stream
from .operators.parse import clean_readings, nan_to_null, parse_readings, rejected_documents, with_system_id
from .session import checkpoint_dir, ensure_utc
from .sources.envelope import read_envelope_files, read_json_lines, read_kafka
from .spec import HYDROPONIC, PipelineSpec
from .streaming.fanout import admit_readings, correct_late, start_state_streams
from .streaming.latest import start_latest
from .streaming.metrics import attach, observe_readings
from .streaming.streams import SinkConfig, StreamSet, await_all, land_readings, run, start_streams

log = logging.getLogger("gaugeworks")


def build_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="gaugeworks", description=__doc__.split("\n")[0])
    p.add_argument("--source", choices=["kafka", "parquet", "json"], default="kafka")
    p.add_argument("--bootstrap", help="Kafka bootstrap servers")
    p.add_argument("--topic", help="Kafka topic")
    p.add_argument("--starting-offsets", default="earliest")
    p.add_argument("--max-offsets-per-trigger", type=int, help="Kafka offsets per micro-batch (default: no limit)")
    p.add_argument("--max-files-per-trigger", type=int, help="files per micro-batch (default: no limit)")
    p.add_argument("--allow-data-loss", action="store_true", help="go on when Kafka offsets are gone")
    p.add_argument("--path", help="input folder for the file sources")
    p.add_argument("--sink", required=True, help="output folder for points")
    p.add_argument("--format", default="parquet", choices=["parquet", "json", "line"])
    p.add_argument("--stamp", default="end", choices=["end", "start"])
    p.add_argument("--checkpoint", help="checkpoint base (default: <spark.checkpoint.dir>/gaugeworks)")
    p.add_argument("--windows", nargs="+", default=list(HYDROPONIC.windows))
    p.add_argument("--analyses", nargs="+", default=["basic", "anomaly", "health"])
    p.add_argument("--watermark", default=HYDROPONIC.watermark)
    p.add_argument("--raw-trigger", default="5 seconds")
    p.add_argument("--window-trigger", default="15 seconds")
    p.add_argument("--by-system", action="store_true", help="group the analyses by system as well")
    p.add_argument("--land", help="folder in which parsed readings are kept once; all outputs stream from there")
    p.add_argument("--states", help="with --land: folder of window states; one aggregate serves all analyses and lengths")
    p.add_argument("--correct", action="store_true", help="with --states and --available-now: take late readings into their windows")
    p.add_argument("--latest", help="folder of the table of each system's latest values")
    p.add_argument("--control", help="folder of control actions (actions/) and seconds since them (elapsed/)")
    p.add_argument("--rejects", help="folder in which records are kept whose document yields nothing")
    p.add_argument("--no-clean", action="store_true", help="keep NaN readings")
    p.add_argument("--round", action="store_true", help="round readings to each sensor's precision before everything else")
    p.add_argument("--available-now", action="store_true", help="drain what is there and stop")
    return p.parse_args(argv)


def _start_more(args, streams: StreamSet, env: DataFrame, readings: DataFrame, spec: PipelineSpec, base: str, trigger: dict) -> None:
    """Start the outputs besides points; one that does not start leaves the others."""
    more = {}
    if args.latest:
        more["latest"] = lambda at: start_latest(readings, spec, args.latest, at, trigger=trigger)
    if args.control:
        for emit in ("actions", "elapsed"):
            place = f"{args.control.rstrip('/')}/{emit}"
            more[f"control_{emit}"] = lambda at, emit=emit, place=place: land_readings(
                control_stream(readings, spec, emit=emit), place, at, trigger=trigger
            )
    if args.rejects:
        more["rejects"] = lambda at: land_readings(rejected_documents(env, spec), args.rejects, at, trigger=trigger)
    for name, start in more.items():
        try:
            streams.queries.append(start(f"{base}/{name}"))
        except Exception as e:  # noqa: BLE001 - isolate one failed start from the rest
            streams.errors[name] = e


def main(argv=None, spark: SparkSession | None = None) -> dict:
    """Run the application; returns its counters (``PipelineMetrics.snapshot``)."""
    args = build_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = spark or SparkSession.builder.appName("gaugeworks").getOrCreate()
    ensure_utc(spark)
    spec = HYDROPONIC.with_(windows=tuple(args.windows), watermark=args.watermark)

    if args.source == "kafka":
        if not (args.bootstrap and args.topic):
            raise SystemExit("--bootstrap and --topic are required for the Kafka source")
        env = read_kafka(
            spark, args.bootstrap, args.topic,
            starting_offsets=args.starting_offsets, max_offsets_per_trigger=args.max_offsets_per_trigger,
            fail_on_data_loss=not args.allow_data_loss,
        )
    elif args.source == "parquet":
        env = read_envelope_files(spark, args.path, max_files_per_trigger=args.max_files_per_trigger)
    else:
        env = read_json_lines(spark, args.path, max_files_per_trigger=args.max_files_per_trigger)

    readings = with_system_id(observe_readings(parse_readings(env, spec), spec), spec)
    if args.round:
        readings = clean_readings(readings, spec)
    elif not args.no_clean:
        readings = nan_to_null(readings, spec)
    base = args.checkpoint or checkpoint_dir(spark, "gaugeworks")
    if args.available_now:
        raw_t = win_t = {"availableNow": True}
    else:
        raw_t, win_t = {"processingTime": args.raw_trigger}, {"processingTime": args.window_trigger}

    if args.states and not args.land:
        raise SystemExit("--states needs --land")
    if args.correct and not (args.states and args.available_now):
        raise SystemExit("--correct needs --states and --available-now")
    metrics = attach(spark)
    landing = None
    by = [spec.system_col] if args.by_system else ()
    sink = SinkConfig(args.sink, fmt=args.format, stamp=args.stamp)
    if args.states:  # the source is parsed once, and all analyses share one aggregate
        landing = admit_readings(readings, spec, args.land, f"{base.rstrip('/')}/landing", trigger=raw_t, name="landing")
        if args.available_now:
            landing.awaitTermination()
    elif args.land:  # the source is read and parsed once, whatever the number of outputs
        landing = land_readings(readings, args.land, f"{base.rstrip('/')}/landing", trigger=raw_t)
        if args.available_now:
            landing.awaitTermination()
        readings = spark.readStream.schema(readings.schema).parquet(args.land)
    shared = {"windows": args.windows, "analyses": args.analyses, "by": by}
    if args.states:
        streams = start_state_streams(
            spark, spec, args.land, readings.schema, args.states, sink, base,
            trigger=win_t, raw_trigger=raw_t, wait=args.available_now, metrics=metrics, **shared,
        )
    else:
        streams = start_streams(readings, spec, sink, base, raw_trigger=raw_t, window_trigger=win_t, **shared)
    if landing is not None:
        streams.queries.append(landing)
    _start_more(args, streams, env, readings, spec, base.rstrip("/"), raw_t)
    for name, err in streams.errors.items():
        log.error("query %s did not start: %s", name, err)
    log.info("started %d queries (checkpoints under %s)", len(streams.queries), base)
    try:
        if args.available_now:
            await_all(streams)
            if args.correct:
                correct_late(spark, spec, args.land, readings.schema, args.states, sink, metrics=metrics, **shared)
        else:
            run(spark, streams)
    finally:
        metrics.wait_ended()
        counters = metrics.snapshot()
        log.info("metrics: %s", counters)
        spark.streams.removeListener(metrics)
    if streams.errors:
        raise RuntimeError(f"queries that did not start: {', '.join(sorted(streams.errors))}")
    return counters
