"""Counters observed inside the streaming plans."""

import json
import math
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException

from gaugeworks.app import main
from gaugeworks.operators.parse import parse_readings
from gaugeworks.operators.windows import ANALYSES
from gaugeworks.sources.envelope import read_envelope_files, to_envelope
from gaugeworks.sources.tables import events_as_hydroponic, table
from gaugeworks.spec import HYDROPONIC, PipelineSpec, SensorSpec
from gaugeworks.streaming.metrics import attach, observe_readings
from gaugeworks.streaming.streams import SinkConfig, _sink_raw, await_all, start_streams

from .conftest import SF_SMALL

SPEC = PipelineSpec(
    sensors=(SensorSpec("water_temperature", 18.0, 25.0, 1), SensorSpec("water_ph", 5.5, 6.5, 2)),
    windows=("5 minutes",),
)
BATCHES = [
    [(0, {"water_temperature": 20.0, "water_ph": 6.0}), (10, {"water_temperature": "NaN", "water_ph": 6.1}), "junk", (5, {})],
    [(1000, {"water_temperature": 21.0})],
    [(2000, {"water_ph": 9.0})],
]
MEASUREMENTS = {"basic": "aggregations_5_minutes", "anomaly": "anomalies_5_minutes", "health": "health_5_minutes"}


def _source(folder):
    os.makedirs(folder)
    schema = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("timestamp", pa.timestamp("us", tz="UTC"))])
    for i, docs in enumerate(BATCHES):
        texts = [d if d == "junk" else json.dumps({"timestamp": d[0] * 1000, "sensors": d[1]}) for d in docs]
        rows = {"key": [b"s"] * len(texts), "value": [t.encode() for t in texts], "timestamp": [0] * len(texts)}
        f = os.path.join(folder, f"{i}.parquet")
        pq.write_table(pa.table(rows, schema=schema), f)
        os.utime(f, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))


def _start(spark, base, src, sink, **options):
    parsed = observe_readings(parse_readings(read_envelope_files(spark, src, max_files_per_trigger=1), SPEC), SPEC)
    now = {"availableNow": True}
    return start_streams(parsed, SPEC, SinkConfig(sink), os.path.join(base, "cp"), raw_trigger=now, window_trigger=now, **options)


@pytest.fixture()
def metrics(spark):
    m = attach(spark)
    yield m
    spark.streams.removeListener(m)


def test_exact_counts_of_four_outputs(spark, tmpdir_new, metrics):
    src, out = os.path.join(tmpdir_new, "in"), os.path.join(tmpdir_new, "points")
    _source(src)
    await_all(_start(spark, tmpdir_new, src, out))
    assert metrics.wait_ended()
    got = metrics.snapshot()
    # four queries parse the source, its six records count once
    assert got["records"] == {"source": 6} and got["rejected"] == {"source": 1} and got["records_processed_total"] == 6
    assert got["points"]["raw_sensor_data"] == 4 and got["dropped_rows"]["raw_sensor_data"] == 2
    assert got["dropped_fields"]["raw_sensor_data"] == 1 and got["batches_written"]["raw_sensor_data"] == 3
    env = read_envelope_files(spark, src, stream=False)
    for kind, name in MEASUREMENTS.items():
        rows = ANALYSES[kind](parse_readings(env, SPEC), SPEC, "5 minutes").where("window.end <= timestamp_seconds(1970)").collect()
        assert len(rows) == 2 == got["points"][name]
        nans = sum(isinstance(v, float) and not math.isfinite(v) for r in rows for v in r)
        assert got["dropped_fields"][name] == nans and got["dropped_rows"][name] == 0
    assert got["dropped_fields"]["aggregations_5_minutes"] == 3  # average, maximum and deviation of the NaN
    assert got["write_errors_total"] == 0
    for name in got["points"]:
        assert spark.read.parquet(f"{out}/measurement={name}").count() == got["points"][name]


def test_failed_sink_counts_as_failed_and_its_replay_once(spark, tmpdir_new, metrics):
    src, out = os.path.join(tmpdir_new, "in"), os.path.join(tmpdir_new, "points")
    _source(src)
    with open(out, "w") as f:  # a file where the folder of points should be
        f.write("")
    with pytest.raises(StreamingQueryException):
        await_all(_start(spark, tmpdir_new, src, out, analyses=()))
    assert metrics.wait_ended()
    got = metrics.snapshot()
    assert got["write_failures"] == {"raw": 1} and got["write_errors_total"] == 1
    assert got["points"] == {} and got["records_processed_total"] == 0
    os.rename(out, f"{out}.file")
    await_all(_start(spark, tmpdir_new, src, out, analyses=()))
    assert metrics.wait_ended()
    got = metrics.snapshot()
    assert got["points"] == {"raw_sensor_data": 4} and got["records"] == {"source": 6}
    assert got["write_errors_total"] == 1 and got["batches_written_total"] == 3


def test_empty_batch_writes_no_folder(spark, tmpdir_new):
    out = os.path.join(tmpdir_new, "points")
    src = os.path.join(tmpdir_new, "in")
    _source(src)
    parsed = parse_readings(read_envelope_files(spark, src, stream=False), SPEC)
    _sink_raw(parsed.where("false"), 0, spec=SPEC, measurement="m", sink=SinkConfig(out))
    assert not [n for n in os.listdir(out) if n.startswith("measurement=")]


def test_counters_of_the_application(spark, tmpdir_new):
    h = events_as_hydroponic(table(spark, SF_SMALL, "events"))
    src, land, states = (os.path.join(tmpdir_new, n) for n in ("in", "landed", "states"))
    to_envelope(h, HYDROPONIC, key_col="system_id", time_col="event_time").repartition(2).write.parquet(src)
    n = h.count()
    for way, extra in {"direct": [], "one_aggregate": ["--land", land, "--states", states]}.items():
        out = os.path.join(tmpdir_new, f"points_{way}")
        args = ["--source", "parquet", "--path", src, "--sink", out, "--windows", "1 hour", "--available-now"]
        got = main([*args, *extra, "--checkpoint", os.path.join(tmpdir_new, f"cp_{way}")], spark=spark)
        assert got["records_processed_total"] == n and got["rejected"] == {"source": 0}, way
        assert set(got["points"]) == {"raw_sensor_data", "aggregations_1_hour", "anomalies_1_hour", "health_1_hour"}
        for name, points in got["points"].items():
            assert spark.read.parquet(f"{out}/measurement={name}").count() == points > 0, (way, name)
