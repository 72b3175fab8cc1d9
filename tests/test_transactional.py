"""Points through the transactional writer: each once, or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators.parse import parse_readings
from gaugeworks.operators.points import raw_points
from gaugeworks.sources.envelope import read_envelope_files
from gaugeworks.streaming.transactional import FilePointStore, point_source

from .test_streaming import SPEC, _write_batches


class Fragile(FilePointStore):
    """Fails where a file of that name lies in its folder: in the second
    batch of a task, or when committing (before or after it took effect)."""

    def stage(self, name, batches):
        def checked():
            for i, b in enumerate(batches):
                yield b
                if i == 0 and os.path.exists(f"{self.path}/fail_stage"):
                    raise OSError("no space")

        return super().stage(name, checked())

    def commit(self, label, names, *, replace):
        if os.path.exists(f"{self.path}/fail_before"):
            raise OSError("lost before the commit")
        super().commit(label, names, replace=replace)
        if os.path.exists(f"{self.path}/fail_after"):
            raise OSError("lost after the commit")


def _points(spark, folder, batches, stream):
    if not os.path.exists(folder):
        _write_batches(folder, batches)
    parsed = parse_readings(read_envelope_files(spark, folder, stream=stream, max_files_per_trigger=1 if stream else None), SPEC)
    return raw_points(parsed, SPEC, "raw").where("time IS NOT NULL")


def _times(spark, store):
    return sorted(r[0] for r in store.read(spark).select(F.unix_seconds(F.col("time").cast("timestamp"))).collect())


def _source(store, name):
    # the class goes to the workers by value, as a user's own would
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return point_source(store, name)


def test_batch_append_overwrite_and_failure(spark, tmpdir_new):
    store = FilePointStore(os.path.join(tmpdir_new, "store"))
    spark.dataSource.register(point_source(store, "points_batch"))
    pts = _points(spark, os.path.join(tmpdir_new, "in"), [[1, 2, 3], [4, 5]], False)
    with pytest.raises(FileNotFoundError):
        store.read(spark)

    def save(df, mode, run):
        df.write.format("points_batch").option("run", run).mode(mode).save()

    save(pts.repartition(4), "overwrite", "day-1")
    assert _times(spark, store) == [1, 2, 3, 4, 5]
    save(pts.where("unix_seconds(time) < 3"), "overwrite", "day-1")  # replaces its own run
    save(pts.where("unix_seconds(time) = 5"), "overwrite", "day-2")
    assert _times(spark, store) == [1, 2, 5]
    save(pts.where("unix_seconds(time) = 4"), "append", "day-1")
    assert _times(spark, store) == [1, 2, 4, 5]
    save(pts.limit(0), "append", "day-1")
    broken = pts.withColumn("measurement", F.when(F.unix_seconds("time") == 5, F.raise_error(F.lit("bad"))).otherwise(F.col("measurement")))
    with pytest.raises(Exception, match="bad"):
        save(broken.repartition(3), "append", "day-3")
    assert _times(spark, store) == [1, 2, 4, 5]
    got, want = store.read(spark), pts.where("unix_seconds(time) != 3")
    assert sorted(map(str, got.select(pts.columns).collect())) == sorted(map(str, want.collect()))
    store.purge(older_than=0.0)
    assert len(os.listdir(os.path.join(store.path, "data"))) == len(store.committed())
    assert _times(spark, store) == [1, 2, 4, 5]
    with pytest.raises(Exception, match="run"):
        save(pts, "append", "a/b")


@pytest.mark.parametrize("fault", ["fail_stage", "fail_before", "fail_after"])
def test_stream_replays_a_failed_batch_once(spark, tmpdir_new, fault):
    store = Fragile(os.path.join(tmpdir_new, "store"))
    os.makedirs(store.path)
    spark.dataSource.register(_source(store, f"points_{fault}"))
    src, cp = os.path.join(tmpdir_new, "in"), os.path.join(tmpdir_new, "cp")
    batches = [[1, 2, 3], [4, 5], [6]]

    def drain():
        q = (
            _points(spark, src, batches, True).writeStream.format(f"points_{fault}").option("run", "raw")
            .option("checkpointLocation", cp).trigger(availableNow=True).start()
        )
        q.awaitTermination()

    flag = os.path.join(store.path, fault)
    open(flag, "w").close()
    with pytest.raises(Exception):  # noqa: B017 - Spark wraps it differently by place
        drain()
    if fault != "fail_after":
        assert store.committed() == []
    os.remove(flag)
    drain()
    assert _times(spark, store) == [1, 2, 3, 4, 5, 6]
    drain()  # nothing new
    assert _times(spark, store) == [1, 2, 3, 4, 5, 6]
    store.purge(older_than=0.0)
    assert len(os.listdir(os.path.join(store.path, "data"))) == len(store.committed()) == 3
