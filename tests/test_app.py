"""The streaming application over a file source, and Kafka options."""

import os

from pyspark.sql import functions as F

from gaugeworks.app import main
from gaugeworks.sources.envelope import kafka_options, to_envelope
from gaugeworks.sources.tables import events_as_hydroponic, table
from gaugeworks.spec import HYDROPONIC

from .conftest import SF_SMALL


def test_kafka_options():
    o = kafka_options("b:9092", "t", starting_offsets="latest", max_offsets_per_trigger=1000)
    assert o["subscribe"] == "t" and o["startingOffsets"] == "latest"
    assert o["maxOffsetsPerTrigger"] == "1000" and o["failOnDataLoss"] == "true"
    assert o["kafka.max.poll.records"] == "1000"
    assert "maxOffsetsPerTrigger" not in kafka_options("b:9092", "t")
    assert kafka_options("b:9092", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_app_drains_file_source(spark, tmpdir_new):
    h = events_as_hydroponic(table(spark, SF_SMALL, "events"))
    src = os.path.join(tmpdir_new, "in")
    to_envelope(h, HYDROPONIC, key_col="system_id", time_col="event_time").repartition(4).write.parquet(src)
    out = os.path.join(tmpdir_new, "points")
    main(
        ["--source", "parquet", "--path", src, "--sink", out, "--available-now",
         "--windows", "1 hour", "--checkpoint", os.path.join(tmpdir_new, "cp")],
        spark=spark,
    )
    pts = spark.read.parquet(out)
    ms = {r.measurement for r in pts.select("measurement").distinct().collect()}
    assert ms == {"raw_sensor_data", "aggregations_1_hour", "anomalies_1_hour", "health_1_hour"}
    assert pts.where(F.col("measurement") == "raw_sensor_data").count() == h.count()
    # raw points keep the values as they were published
    got = {round(r[0], 9) for r in spark.read.parquet(f"{out}/measurement=raw_sensor_data").select("water_temperature").collect()}
    assert got == {round(r[0], 9) for r in h.select("water_temperature").collect()}


def test_kafka_paths_without_connector(spark, tmpdir_new):
    import pytest

    from gaugeworks.sources.envelope import publish_kafka, read_envelope_files, read_kafka

    # the connector jar is not shipped here: the reader gets as far as the
    # data-source lookup and fails with Spark's own message
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka(spark, "localhost:9092", "sensors")
    src = os.path.join(tmpdir_new, "env")
    h = events_as_hydroponic(table(spark, SF_SMALL, "events"))
    to_envelope(h, HYDROPONIC, key_col="system_id", time_col="event_time").write.parquet(src)
    with pytest.raises(ValueError, match="checkpoint"):
        publish_kafka(read_envelope_files(spark, src), "localhost:9092", "sensors")


def test_app_lands_readings_once(spark, tmpdir_new):
    h = events_as_hydroponic(table(spark, SF_SMALL, "events"))
    src, land, out = (os.path.join(tmpdir_new, n) for n in ("in", "landed", "points"))
    to_envelope(h, HYDROPONIC, key_col="system_id", time_col="event_time").repartition(4).write.parquet(src)
    args = ["--source", "parquet", "--path", src, "--sink", out, "--available-now", "--land", land,
            "--windows", "1 hour", "--analyses", "basic", "--checkpoint", os.path.join(tmpdir_new, "cp")]
    main(args, spark=spark)
    main(args, spark=spark)  # a second run finds nothing new
    assert spark.read.parquet(land).count() == h.count()
    pts = spark.read.parquet(out)
    assert pts.where(F.col("measurement") == "raw_sensor_data").count() == h.count()
    assert pts.where(F.col("measurement") == "aggregations_1_hour").count() > 0


def test_app_with_one_aggregate_for_all_outputs(spark, tmpdir_new):
    import pytest

    from gaugeworks.streaming.sinks import read_points

    h = events_as_hydroponic(table(spark, SF_SMALL, "events"))
    src = os.path.join(tmpdir_new, "in")
    to_envelope(h, HYDROPONIC, key_col="system_id", time_col="event_time").repartition(2).write.parquet(src)
    out = os.path.join(tmpdir_new, "points")
    args = ["--source", "parquet", "--path", src, "--sink", out, "--windows", "1 hour", "--checkpoint", os.path.join(tmpdir_new, "cp")]
    args += ["--states", os.path.join(tmpdir_new, "states")]
    with pytest.raises(SystemExit, match="--land"):
        main(args, spark=spark)
    args += ["--land", os.path.join(tmpdir_new, "landed")]
    with pytest.raises(SystemExit, match="--available-now"):
        main([*args, "--correct"], spark=spark)
    main([*args, "--available-now", "--correct"], spark=spark)
    pts = read_points(spark, out)
    ms = {r.measurement for r in pts.select("measurement").distinct().collect()}
    assert ms == {"raw_sensor_data", "aggregations_1_hour", "anomalies_1_hour", "health_1_hour"}
    assert pts.where(F.col("measurement") == "raw_sensor_data").count() == h.select("system_id", "event_time").distinct().count()


def test_app_latest_control_and_rejects(spark, tmpdir_new):
    import random

    import pyarrow as pa
    import pyarrow.parquet as pq

    from gaugeworks.operators.control import control_actions, elapsed_since_action
    from gaugeworks.operators.parse import parse_readings, with_system_id
    from gaugeworks.operators.readings import latest_readings
    from gaugeworks.sources.envelope import read_envelope_files
    from gaugeworks.streaming.latest import read_latest

    from .test_streaming import _write_keyed

    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), 10_000 + 100 * i, rnd.uniform(10, 40)) for i in range(60)]
    src = os.path.join(tmpdir_new, "in")
    # a far reading of another system moves the watermark past all others
    _write_keyed(src, [rows[:30], rows[30:], [("z", 900_000, 50.0)]])
    junk = {"key": [b"a", None], "value": [b"no document", None], "timestamp": pa.array([7, 8], pa.timestamp("us", tz="UTC"))}
    schema = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("timestamp", pa.timestamp("us", tz="UTC"))])
    pq.write_table(pa.table(junk, schema=schema), os.path.join(src, "junk.parquet"))
    places = {n: os.path.join(tmpdir_new, n) for n in ("latest", "control", "rejects")}
    args = ["--source", "parquet", "--path", src, "--sink", os.path.join(tmpdir_new, "points"), "--available-now",
            "--windows", "1 hour", "--analyses", "basic", "--checkpoint", os.path.join(tmpdir_new, "cp"),
            "--watermark", "1 hour", "--max-files-per-trigger", "1"]
    args += [x for n, p in places.items() for x in (f"--{n}", p)]
    counters = main(args, spark=spark)
    assert counters["records"] == {"source": 63}
    assert counters["rejected"] == {"source": 2} and not any(counters["failures"].values())
    kept = spark.read.parquet(places["rejects"]).collect()
    assert sorted((r["key"] or "", r["value"] or "") for r in kept) == [("", ""), ("a", "no document")]
    batch = with_system_id(parse_readings(read_envelope_files(spark, src, stream=False), HYDROPONIC), HYDROPONIC)
    want = {r.system_id: r.asDict() for r in latest_readings(batch, HYDROPONIC).collect()}
    names = next(iter(want.values())).keys()
    got = {r.system_id: {n: r[n] for n in names} for r in read_latest(spark, places["latest"]).collect()}
    assert got == want
    replayed = batch.where("system_id != 'z' AND event_time IS NOT NULL")
    key = ["system_id", "event_time", "rule", "action"]
    acts = sorted(map(tuple, spark.read.parquet(f"{places['control']}/actions").select(key).collect()))
    assert acts == sorted(map(tuple, control_actions(replayed, HYDROPONIC).select(key).collect())) and len(acts) > 5
    key = ["system_id", "event_time", "last_refill"]
    elapsed = sorted(map(tuple, spark.read.parquet(f"{places['control']}/elapsed").select(key).collect()))
    assert elapsed == sorted(map(tuple, elapsed_since_action(replayed, HYDROPONIC).select(key).collect()))
