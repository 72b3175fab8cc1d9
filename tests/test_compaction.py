"""Equal points of several runs: newest value per field, compaction that
may break off anywhere."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators.points import newest_points
from gaugeworks.streaming import sinks
from gaugeworks.streaming.sinks import compact_points, read_points, write_points

DAY = dt.datetime(2024, 3, 1)
SCHEMA = "measurement string, system_id string, time timestamp, a double, b double"


def points(spark, rows):
    """Rows (system, minute, a, b) of one day."""
    data = [("m", s, DAY + dt.timedelta(minutes=t), a, b) for s, t, a, b in rows]
    return spark.createDataFrame(data, SCHEMA)


def stored(spark, out, **options):
    rows = read_points(spark, out, **options).collect()
    return sorted((r.system_id, int((r.time - DAY).total_seconds()) // 60, r.a, r.b) for r in rows)


def aged(out, run, seconds):
    """Set the age of the files of one run."""
    for folder, _, names in os.walk(out):
        if f"run={run}" in folder:
            for n in names:
                os.utime(os.path.join(folder, n), (1_700_000_000 + seconds,) * 2)


@pytest.fixture()
def two_runs(spark, tmpdir_new):
    out = os.path.join(tmpdir_new, "pts")
    write_points(points(spark, [("x", 1, 1.0, 1.0), ("x", 2, 2.0, None), ("y", 1, 5.0, 5.0)]), out, batch_id=0, run="one")
    write_points(points(spark, [("x", 1, 10.0, None), ("x", 2, None, 20.0), ("z", 9, 9.0, None)]), out, batch_id=0, run="two")
    aged(out, "one", 0)
    aged(out, "two", 10)
    return out


WANT = [("x", 1, 10.0, 1.0), ("x", 2, 2.0, 20.0), ("y", 1, 5.0, 5.0), ("z", 9, 9.0, None)]
RANGE = ("2024-03-01", "2024-03-02")


def test_newest_fields_win_and_age_decides(spark, two_runs):
    assert stored(spark, two_runs) == WANT
    aged(two_runs, "one", 99)  # written again: now the newer one
    assert stored(spark, two_runs)[0] == ("x", 1, 1.0, 1.0)


def test_compaction_keeps_every_point_once(spark, two_runs):
    assert compact_points(spark, two_runs, "m", RANGE) >= 2
    plain = spark.read.parquet(two_runs)
    assert plain.count() == 4 and plain.select("run").distinct().count() == 1
    assert stored(spark, two_runs) == WANT
    compact_points(spark, two_runs, "m", RANGE)  # again: nothing changes
    assert stored(spark, two_runs) == WANT and spark.read.parquet(two_runs).count() == 4
    assert compact_points(spark, two_runs, "m", ("2025-01-01", "2025-01-02")) == 0


def test_compacted_points_keep_their_age(spark, two_runs):
    # a run whose files are younger than the replaced ones, but older than the compaction
    compact_points(spark, two_runs, "m", RANGE)
    write_points(points(spark, [("x", 1, 77.0, None)]), two_runs, batch_id=3, run="late")
    aged(two_runs, "late", 20)
    assert stored(spark, two_runs)[0] == ("x", 1, 77.0, 1.0)


@pytest.mark.parametrize("deletes", [0, 1])
def test_broken_compaction_loses_and_doubles_nothing(spark, two_runs, monkeypatch, deletes):
    real, left = sinks._delete_file, [deletes]

    def breaking(spark, name):
        if not left[0]:
            raise RuntimeError("driver lost")
        left[0] -= 1
        real(spark, name)

    monkeypatch.setattr(sinks, "_delete_file", breaking)
    with pytest.raises(RuntimeError):
        compact_points(spark, two_runs, "m", RANGE)
    assert stored(spark, two_runs) == WANT
    monkeypatch.setattr(sinks, "_delete_file", real)
    compact_points(spark, two_runs, "m", RANGE)
    assert stored(spark, two_runs) == WANT and spark.read.parquet(two_runs).count() == 4


def test_broken_write_of_compaction(spark, two_runs, monkeypatch):
    monkeypatch.setattr(sinks, "_overwrite", lambda *_: (_ for _ in ()).throw(RuntimeError("executors lost")))
    with pytest.raises(RuntimeError):
        compact_points(spark, two_runs, "m", RANGE)
    assert stored(spark, two_runs) == WANT


def test_ranges_and_measurements_of_other_columns(spark, tmpdir_new):
    out = os.path.join(tmpdir_new, "pts")
    write_points(points(spark, [("x", 1, 1.0, None), ("x", 1500, 2.0, None)]), out, batch_id=0, run="one")
    other = points(spark, [("x", 1, 3.0, None)]).withColumn("measurement", F.lit("n")).withColumnRenamed("a", "c")
    write_points(other, out, batch_id=0, run="two")
    assert {"a", "c"} <= set(read_points(spark, out).columns)
    assert stored(spark, out, measurement="m", dates=RANGE) == [("x", 1, 1.0, None)]
    compact_points(spark, out, "m", RANGE)
    assert stored(spark, out, measurement="m") == [("x", 1, 1.0, None), ("x", 1500, 2.0, None)]
    assert read_points(spark, out, measurement="n").count() == 1


def test_newest_points_hot_key_is_one_partial_row(spark):
    frame = spark.range(50_000).selectExpr("'m' AS measurement", "'s' AS system_id", "timestamp '2024-03-01' AS time", "double(id) AS a", "id AS at")
    newest = newest_points(frame, F.col("at"))
    assert newest.collect()[0].a == 49_999.0
    assert "partial_max_by" in newest._jdf.queryExecution().executedPlan().toString()
