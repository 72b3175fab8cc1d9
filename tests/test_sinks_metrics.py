"""Sinks (idempotent overwrite, line protocol), JSON-lines source, landing
and listener metrics."""

import json
import os
import time

from pyspark.sql import functions as F

from gaugeworks.operators.parse import parse_readings, rejected_readings
from gaugeworks.operators.points import raw_points
from gaugeworks.operators.readings import latest_readings
from gaugeworks.sources.envelope import read_json_lines, to_envelope
from gaugeworks.sources.tables import events_wide, table
from gaugeworks.spec import EVENTS, HYDROPONIC
from gaugeworks.streaming.metrics import attach
from gaugeworks.streaming.sinks import write_line_protocol, write_points
from gaugeworks.streaming.streams import SinkConfig, await_all, land_readings, start_streams

from .conftest import SF_SMALL


def _raw(spark):
    wide = events_wide(table(spark, SF_SMALL, "events"))
    return raw_points(wide, EVENTS)


def test_write_points_is_idempotent(spark, tmpdir_new):
    pts = _raw(spark)
    out = os.path.join(tmpdir_new, "pts")
    n1 = write_points(pts, out, batch_id=7)
    n2 = write_points(pts, out, batch_id=7)  # replay of the same batch
    assert n1 == n2 == pts.count()
    assert spark.read.parquet(out).count() == n1
    back = os.path.join(tmpdir_new, "backfill")
    whole = ("2024-01-01", "2024-02-01")
    assert write_points(pts, back, replace=whole) == n1
    assert write_points(pts, back, replace=whole) == n1  # re-run replaces its own rows
    assert spark.read.parquet(back).count() == n1


def test_sinks_never_delete_what_others_wrote(spark, tmpdir_new):
    import pytest

    from gaugeworks.operators.points import window_points
    from gaugeworks.operators.windows import ANALYSES

    wide = events_wide(table(spark, SF_SMALL, "events"))
    pts = window_points(ANALYSES["basic"](wide, EVENTS, "5 minutes"), EVENTS, "w").cache()
    out = os.path.join(tmpdir_new, "days")
    end = F.col("time") - F.expr("INTERVAL 1 MICROSECOND")

    def fill(low, high, label=None, rows=pts):
        part = rows.where((end >= F.lit(low).cast("timestamp")) & (end < F.lit(high).cast("timestamp")))
        write_points(part, out, replace=(low, high), label=label, end_stamped=True)
        return part.count()

    n = fill("2024-01-03", "2024-01-04")
    n += fill("2024-01-02", "2024-01-03")  # its last window ends on the next day
    assert spark.read.parquet(out).count() == n
    n += fill("2024-01-05 00:00:00", "2024-01-05 12:00:00") + fill("2024-01-05 12:00:00", "2024-01-06 00:00:00")
    assert spark.read.parquet(out).count() == n
    twin = pts.withColumn("system_id", F.lit("other"))
    n += fill("2024-01-03", "2024-01-04", label="other", rows=twin)
    fill("2024-01-03", "2024-01-04")  # again
    assert spark.read.parquet(out).count() == n
    with pytest.raises(Exception, match="outside the replaced range"):
        write_points(pts, out, replace=("2024-01-03", "2024-01-04"), end_stamped=True)
    with pytest.raises(ValueError, match="replace"):
        write_points(pts, out)
    stream = os.path.join(tmpdir_new, "stream")
    write_points(pts, stream, batch_id=0, run="one")
    write_points(pts.limit(3), stream, batch_id=0, run="two")  # a reset checkpoint
    assert spark.read.parquet(stream).count() == pts.count() + 3


def test_line_protocol_files(spark, tmpdir_new):
    pts = _raw(spark)
    out = os.path.join(tmpdir_new, "lp")
    write_line_protocol(pts, out, batch_id=0)
    lines = spark.read.text(out).select("value").collect()
    assert len(lines) == pts.count()
    first = lines[0].value
    head, fields, ts = first.split(" ")
    assert head.startswith("raw_sensor_data,system_id=")
    assert "=" in fields and ts.isdigit() and len(ts) >= 18


def test_json_lines_source_and_rejects(spark, tmpdir_new):
    src = os.path.join(tmpdir_new, "jl")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"timestamp": 1_700_000_000_000, "sensors": {"water_ph": 6.1}}) + "\n")
        f.write("not json\n")
    env = read_json_lines(spark, src, stream=False, key="sys-9")
    parsed = parse_readings(env, HYDROPONIC)
    assert parsed.count() == 2
    assert rejected_readings(parsed, HYDROPONIC).count() == 1
    pts = raw_points(parsed, HYDROPONIC).collect()
    assert len(pts) == 1 and pts[0].system_id == "sys-9" and pts[0].water_ph == 6.1


def test_fanout_metrics_and_landing(spark, tmpdir_new):
    metrics = attach(spark)
    wide = events_wide(table(spark, SF_SMALL, "events"))
    src = os.path.join(tmpdir_new, "env")
    to_envelope(wide, EVENTS, key_col="system_id", time_col="event_time").repartition(3).write.parquet(src)
    from gaugeworks.sources.envelope import read_envelope_files

    parsed = parse_readings(read_envelope_files(spark, src, max_files_per_trigger=1), EVENTS)
    landed = os.path.join(tmpdir_new, "landed")
    q = land_readings(parsed, landed, os.path.join(tmpdir_new, "land_cp"), trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.read.parquet(landed).count() == wide.count()

    streams = start_streams(
        parsed, EVENTS.with_(windows=("1 hour",)), SinkConfig(os.path.join(tmpdir_new, "pts"), fmt="line"),
        os.path.join(tmpdir_new, "cp"), raw_trigger={"availableNow": True},
        window_trigger={"availableNow": True}, query_prefix="m_",
    )
    assert not streams.errors and len(streams.queries) == 4
    await_all(streams)
    time.sleep(1.0)  # listener events are delivered asynchronously
    snap = metrics.snapshot()
    assert snap["records_processed"].get("m_raw") == wide.count()
    assert snap["batches"].get("m_raw", 0) >= 3
    assert snap["active_streams"] == 0
    spark.streams.removeListener(metrics)


def test_latest_readings_streaming_update(spark, tmpdir_new):
    wide = events_wide(table(spark, SF_SMALL, "events"))
    src = os.path.join(tmpdir_new, "wide")
    wide.withColumn("event_time", F.col("event_time").cast("timestamp")).repartition(2).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = (
        latest_readings(stream, EVENTS).writeStream.outputMode("update").format("memory")
        .queryName("latest_upd").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    rows = spark.sql("SELECT * FROM latest_upd").collect()
    final = {r.system_id: r.asDict() for r in rows}  # the last update of a key wins
    batch = {r.system_id: r.asDict() for r in latest_readings(wide, EVENTS).collect()}
    assert final == batch


def test_foreach_partition_sink_batches_and_closes(spark, tmpdir_new):
    from functools import partial

    from gaugeworks.streaming.sinks import PointWriter, foreach_partition_sink

    class FileWriter(PointWriter):  # local class: pickled by value to the workers
        def __init__(self, folder):
            import uuid

            self.path = os.path.join(folder, uuid.uuid4().hex)
            self.batches = []

        def write(self, points):
            assert 0 < len(points) <= 50
            self.batches.append(len(points))

        def close(self):
            with open(self.path, "w") as f:
                json.dump(self.batches, f)

    pts = _raw(spark)
    out = os.path.join(tmpdir_new, "ext")
    os.makedirs(out)
    foreach_partition_sink(pts.repartition(4), partial(FileWriter, out), batch_size=50)
    sizes = [n for name in os.listdir(out) for n in json.load(open(os.path.join(out, name)))]
    assert sum(sizes) == pts.count() and max(sizes) == 50
