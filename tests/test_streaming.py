"""Structured Streaming behaviour: watermark trace, parity with batch,
restart after a failed sink (exactly-once points)."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gaugeworks.operators.parse import parse_readings
from gaugeworks.operators.windows import basic_aggregation
from gaugeworks.sources.envelope import read_envelope_files
from gaugeworks.spec import PipelineSpec, SensorSpec
from gaugeworks.streaming.sinks import write_points
from gaugeworks.streaming.streams import SinkConfig, await_all, start_streams
from gaugeworks.operators.points import window_points

SPEC = PipelineSpec(
    sensors=(SensorSpec("water_temperature", 18.0, 25.0, 1),),
    state_fields=(("plant_activity", "double"),),
    activity="plant_activity",
    windows=("5 minutes",),
    watermark="30 seconds",
)


def _write_batches(path, batches):
    """One Parquet envelope file per batch, written in order."""
    os.makedirs(path, exist_ok=True)
    schema = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("timestamp", pa.timestamp("us", tz="UTC"))])
    for i, secs in enumerate(batches):
        keys, vals, ts = [], [], []
        for s in secs:
            doc = {"timestamp": s * 1000, "sensors": {"water_temperature": 20.0}, "system_state": {"plant_activity": 0.5}}
            keys.append(b"sys1")
            vals.append(json.dumps(doc).encode())
            ts.append(s * 1_000_000)
        tbl = pa.table({"key": keys, "value": vals, "timestamp": pa.array(ts, pa.timestamp("us", tz="UTC"))}, schema=schema)
        f = os.path.join(path, f"batch-{i:03d}.parquet")
        pq.write_table(tbl, f)
        # the file source orders files by modification time (ms): keep them apart
        os.utime(f, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))


def _run_basic(spark, base, batches):
    src = os.path.join(base, "in")
    _write_batches(src, batches)
    env = read_envelope_files(spark, src, max_files_per_trigger=1)
    parsed = parse_readings(env, SPEC)
    out = os.path.join(base, "points")
    streams = start_streams(
        parsed,
        SPEC,
        SinkConfig(out),
        os.path.join(base, "cp"),
        analyses=("basic",),
        raw=False,
        window_trigger={"availableNow": True},
    )
    assert not streams.errors
    await_all(streams)
    pts = spark.read.parquet(out)
    rows = pts.select(
        (F.unix_seconds("time") - 300).alias("start"), F.col("water_temperature_count").alias("n"), "batch_id"
    ).collect()
    return sorted((r.start, int(r.n), r.batch_id) for r in rows)


def test_watermark_trace_late_row_dropped(spark, tmpdir_new):
    got = _run_basic(spark, tmpdir_new, [[10, 290], [340], [660], [299, 305], [1300], [1310]])
    assert got == [(0, 2, 2), (300, 2, 3), (600, 1, 5)]


def test_watermark_trace_row_kept_when_window_open(spark, tmpdir_new):
    got = _run_basic(spark, tmpdir_new, [[10, 290], [340], [299, 305], [660]])
    # [300,600) closes in the trailing no-data batch; [600,900) stays open
    assert got == [(0, 3, 2), (300, 2, 4)]


def test_stream_equals_batch_on_closed_windows(spark, tmpdir_new):
    batches = [[10, 290], [340, 420], [660, 700], [910], [1500]]
    got = _run_basic(spark, tmpdir_new, batches)
    src = os.path.join(tmpdir_new, "in")
    parsed = parse_readings(read_envelope_files(spark, src, stream=False), SPEC)
    batch = basic_aggregation(parsed, SPEC, "5 minutes").select(
        F.unix_seconds("window.start").alias("s"), F.col("water_temperature_count").alias("n")
    )
    expect = {(r.s, r.n) for r in batch.collect()}
    assert {(s, n) for s, n, _ in got} <= expect
    # every window except the trailing open one is emitted
    assert len(got) == len(expect) - 1


class _FailOnce:
    def __init__(self, out, fail_batch):
        self.out, self.fail_batch, self.failed = out, fail_batch, False

    def __call__(self, batch_df, batch_id):
        pts = window_points(batch_df, SPEC, "aggregations_5_minutes")
        write_points(pts, self.out, batch_id=batch_id, observe=False)
        if batch_id == self.fail_batch and not self.failed:
            self.failed = True
            raise RuntimeError("sink down")


def test_restart_after_sink_failure_is_exactly_once(spark, tmpdir_new):
    src = os.path.join(tmpdir_new, "in")
    _write_batches(src, [[10, 290], [340], [660], [299, 305], [1300], [1310]])
    out, cp = os.path.join(tmpdir_new, "points"), os.path.join(tmpdir_new, "cp")
    sink = _FailOnce(out, fail_batch=3)

    def start():
        parsed = parse_readings(read_envelope_files(spark, src, max_files_per_trigger=1), SPEC)
        agg = basic_aggregation(parsed, SPEC, "5 minutes")
        return (
            agg.writeStream.foreachBatch(sink).outputMode("append")
            .option("checkpointLocation", cp).trigger(availableNow=True).start()
        )

    q = start()
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
    q = start()
    q.awaitTermination()
    rows = spark.read.parquet(out).select(F.unix_seconds("time").alias("end")).collect()
    ends = sorted(r.end for r in rows)
    assert ends == [300, 600, 900]


def test_streaming_control_equals_batch(spark, tmpdir_new):
    from gaugeworks.operators.control import control_actions, control_stream, elapsed_since_action
    from gaugeworks.spec import HYDROPONIC

    src = os.path.join(tmpdir_new, "in")
    os.makedirs(src)
    schema = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("timestamp", pa.timestamp("us", tz="UTC"))])
    import random

    rnd = random.Random(3)
    t = 1_704_067_200  # 2024-01-01
    for b in range(6):
        keys, vals, ts = [], [], []
        # a far reading of another system moves the watermark past all others
        for _ in range(60 if b < 5 else 1):
            t += rnd.choice([5, 60, 200, 400]) if b < 5 else 100_000
            sysid = rnd.choice([b"a", b"b"]) if b < 5 else b"z"
            doc = {"timestamp": t * 1000, "sensors": {"water_level_percent": rnd.uniform(20, 40),
                   "water_ph": rnd.uniform(5.5, 6.5), "ec_tds": rnd.uniform(1.1, 1.5)}}
            keys.append(sysid); vals.append(json.dumps(doc).encode()); ts.append(t * 1_000_000)
        f = os.path.join(src, f"batch-{b:03d}.parquet")
        pq.write_table(pa.table({"key": keys, "value": vals, "timestamp": pa.array(ts, pa.timestamp("us", tz="UTC"))}, schema=schema), f)
        os.utime(f, (1_700_000_000 + 10 * b, 1_700_000_000 + 10 * b))

    from gaugeworks.operators.parse import with_system_id

    def parsed(stream):
        p = parse_readings(read_envelope_files(spark, src, stream=stream, max_files_per_trigger=1 if stream else None), HYDROPONIC)
        p = with_system_id(p, HYDROPONIC)
        return p if stream else p.where("system_id != 'z'")

    out_a, out_e = os.path.join(tmpdir_new, "acts"), os.path.join(tmpdir_new, "el")
    for emit, out in (("actions", out_a), ("elapsed", out_e)):
        q = (
            control_stream(parsed(True), HYDROPONIC, emit=emit, watermark="1 hour")
            .writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", out + "_cp").outputMode("append")
            .trigger(availableNow=True).start()
        )
        q.awaitTermination()
    got = sorted((r.system_id, r.rule, r.action, r.event_time) for r in spark.read.parquet(out_a).collect())
    exp = sorted((r.system_id, r.rule, r.action, r.event_time) for r in control_actions(parsed(False), HYDROPONIC).collect())
    assert got == exp and len(exp) > 10
    gel = sorted((r.system_id, r.event_time, r.last_refill, r.last_ph_adjust, r.last_nutrient_dose) for r in spark.read.parquet(out_e).collect())
    eel = sorted((r.system_id, r.event_time, r.last_refill, r.last_ph_adjust, r.last_nutrient_dose)
                 for r in elapsed_since_action(parsed(False), HYDROPONIC).collect())
    assert gel == eel


def test_failed_start_is_isolated_and_run_surfaces_failures(spark, tmpdir_new):
    from gaugeworks.streaming.streams import run

    src = os.path.join(tmpdir_new, "in")
    _write_batches(src, [[10, 290], [340]])
    parsed = parse_readings(read_envelope_files(spark, src, max_files_per_trigger=1), SPEC)
    # grouping by a missing column breaks only the window queries
    streams = start_streams(
        parsed, SPEC, SinkConfig(os.path.join(tmpdir_new, "pts")), os.path.join(tmpdir_new, "cp"),
        by=["no_such_column"], raw_trigger={"availableNow": True}, window_trigger={"availableNow": True},
    )
    assert set(streams.errors) == {"aggregations_5_minutes", "anomalies_5_minutes", "health_5_minutes"}
    assert len(streams.queries) == 1
    await_all(streams)

    # a sink that fails makes run() raise instead of hanging or hiding it
    bad = parsed.writeStream.foreachBatch(_boom).option("checkpointLocation", os.path.join(tmpdir_new, "cp2")).start()
    from gaugeworks.streaming.streams import StreamSet

    with pytest.raises(StreamingQueryException):
        run(spark, StreamSet(queries=[bad]), timeout=120)


def _boom(df, batch_id):
    raise RuntimeError("sink down")


def _write_keyed(path, batches):
    """Envelope files; each batch is a list of (key, seconds, level)."""
    os.makedirs(path, exist_ok=True)
    schema = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("timestamp", pa.timestamp("us", tz="UTC"))])
    for i, rows in enumerate(batches):
        keys = [k.encode() for k, _, _ in rows]
        vals = [json.dumps({"timestamp": s * 1000, "sensors": {"water_level_percent": lv}}).encode() for _, s, lv in rows]
        ts = pa.array([s * 1_000_000 for _, s, _ in rows], pa.timestamp("us", tz="UTC"))
        f = os.path.join(path, f"batch-{i:03d}.parquet")
        pq.write_table(pa.table({"key": keys, "value": vals, "timestamp": ts}, schema=schema), f)
        os.utime(f, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))


def test_streaming_windows_by_system(spark, tmpdir_new):
    from gaugeworks.operators.parse import with_system_id
    from gaugeworks.spec import HYDROPONIC

    src = os.path.join(tmpdir_new, "in")
    _write_keyed(src, [[("a", 10, 50.0), ("b", 20, 50.0), ("a", 30, 50.0)], [("b", 700, 50.0)]])
    parsed = with_system_id(parse_readings(read_envelope_files(spark, src, max_files_per_trigger=1), HYDROPONIC), HYDROPONIC)
    out = os.path.join(tmpdir_new, "pts")
    streams = start_streams(
        parsed, HYDROPONIC.with_(windows=("5 minutes",)), SinkConfig(out), os.path.join(tmpdir_new, "cp"),
        analyses=("basic",), raw=False, by=["system_id"], window_trigger={"availableNow": True},
    )
    assert not streams.errors
    await_all(streams)
    got = sorted((r.system_id, int(r.water_level_percent_count)) for r in spark.read.parquet(out).collect())
    assert got == [("a", 2), ("b", 1)]


def _control(spark, base, batches, watermark, emit="actions"):
    from gaugeworks.operators.control import control_stream
    from gaugeworks.operators.parse import with_system_id
    from gaugeworks.spec import HYDROPONIC

    src, out = os.path.join(base, "in"), os.path.join(base, emit)
    _write_keyed(src, batches)
    parsed = with_system_id(parse_readings(read_envelope_files(spark, src, max_files_per_trigger=1), HYDROPONIC), HYDROPONIC)
    q = (
        control_stream(parsed, HYDROPONIC, emit=emit, watermark=watermark).writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", out + "_cp").outputMode("append")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    late = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in json.loads(p.json)["stateOperators"])
    return spark.read.parquet(out).withColumn("s", F.unix_seconds("event_time")).collect(), late


# a far reading of another system moves the watermark past all others
END = [("z", 100_000, 50.0)]


def test_control_stream_replays_out_of_order_rows_in_time_order(spark, tmpdir_new):
    # the clock starts at 10,000; 10,380 arrives after 10,400, inside the
    # watermark: it fires, so 10,400 does not; 10,800 does
    batches = [[("a", 10_000, 50.0), ("a", 10_400, 10.0)], [("a", 10_380, 10.0)], [("a", 10_800, 10.0)], END]
    got, late = _control(spark, tmpdir_new, batches, "1 hour")
    assert sorted(r.s for r in got) == [10_380, 10_800]
    assert late == 0


def test_control_stream_drops_and_counts_rows_behind_the_watermark(spark, tmpdir_new):
    batches = [[("a", 1000, 50.0), ("a", 2000, 10.0)], [("a", 2100, 10.0)], [("a", 500, 10.0)], [("a", 3000, 10.0)], END]
    got, late = _control(spark, tmpdir_new, batches, "30 seconds")
    assert sorted(r.s for r in got) == [2000, 3000]
    assert late == 1


def test_control_stream_on_shuffled_input_equals_batch(spark, tmpdir_new):
    import random

    from gaugeworks.operators.control import control_actions, elapsed_since_action
    from gaugeworks.operators.parse import with_system_id
    from gaugeworks.spec import HYDROPONIC

    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), 10_000 + 7 * i, rnd.uniform(20, 40)) for i in range(400)]
    near = sorted(rows, key=lambda r: r[1] + rnd.uniform(-600, 600))
    batches = [near[i : i + 80] for i in range(0, 400, 80)] + [END]
    acts, late = _control(spark, tmpdir_new, batches, "1 hour")
    last, _ = _control(spark, tmpdir_new, batches, "1 hour", emit="elapsed")
    assert late == 0
    env = read_envelope_files(spark, os.path.join(tmpdir_new, "in"), stream=False)
    batch = with_system_id(parse_readings(env, HYDROPONIC), HYDROPONIC).where("system_id != 'z'")
    want = control_actions(batch, HYDROPONIC).collect()
    assert sorted((r.system_id, r.event_time, r.rule) for r in acts) == sorted((r.system_id, r.event_time, r.rule) for r in want)
    assert len(want) > 5
    columns = ("system_id", "event_time", "last_refill", "last_ph_adjust", "last_nutrient_dose")
    pick = lambda found: sorted(tuple(r[c] for c in columns) for r in found)
    assert pick(last) == pick(elapsed_since_action(batch, HYDROPONIC).collect())
    assert min(r.last_refill for r in last) >= 0
