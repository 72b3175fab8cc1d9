"""The state of a stream as a table."""

import os

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators.parse import parse_readings, with_system_id
from gaugeworks.operators.windows import ANALYSES, flatten_window
from gaugeworks.sources.envelope import read_envelope_files
from gaugeworks.spec import HYDROPONIC
from gaugeworks.streaming.open_windows import open_windows, stateful_operators, unfinished

from .test_streaming import SPEC, _write_batches, _write_keyed


def _starts(df):
    return sorted(r[0] for r in df.select(F.unix_seconds("window.start")).collect())


def _drain(frame, out, cp):
    q = (
        frame.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp)
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()


@pytest.mark.parametrize("kind", ["basic", "anomaly", "health"])
def test_open_and_emitted_windows_are_the_batch(spark, tmpdir_new, kind):
    src, out, cp = (os.path.join(tmpdir_new, n) for n in ("in", "out", "cp"))
    _write_batches(src, [[10, 290], [340, 345], [700], [1000, 1220]])

    def parsed(stream):
        return parse_readings(read_envelope_files(spark, src, stream=stream, max_files_per_trigger=1 if stream else None), SPEC)

    _drain(ANALYSES[kind](parsed(True), SPEC, "5 minutes"), out, cp)
    emitted = spark.read.parquet(out)
    assert _starts(emitted) == [0, 300, 600] and _starts(open_windows(spark, cp)) == [900, 1200]
    rest = unfinished(spark, cp, parsed(False), SPEC, kind, "5 minutes")
    whole = ANALYSES[kind](parsed(False), SPEC, "5 minutes")
    got = flatten_window(emitted.select(whole.columns).unionByName(rest))
    key = lambda r: r["window_start"]
    assert sorted(got.collect(), key=key) == sorted(flatten_window(whole).collect(), key=key)
    operators = stateful_operators(spark, cp).collect()
    assert [r["operatorName"] for r in operators] == ["stateStoreSave"]


def test_restart_goes_on_from_the_state_by_system(spark, tmpdir_new):
    src, out, cp = (os.path.join(tmpdir_new, n) for n in ("in", "out", "cp"))
    spec = HYDROPONIC.with_(windows=("5 minutes",))

    def parsed(stream):
        env = read_envelope_files(spark, src, stream=stream, max_files_per_trigger=1 if stream else None)
        return with_system_id(parse_readings(env, spec), spec)

    def held():
        rows = open_windows(spark, cp).select(F.unix_seconds("window.start"), "system_id").collect()
        return sorted(map(tuple, rows))

    batches = [[("a", 10, 50.0), ("b", 20, 50.0), ("a", 30, 50.0)], [("b", 1000, 40.0)]]
    _write_keyed(src, batches)
    _drain(ANALYSES["basic"](parsed(True), spec, "5 minutes", by=["system_id"]), out, cp)
    assert held() == [(900, "b")]
    _write_keyed(src, [*batches, [("a", 1100, 60.0), ("b", 1110, 60.0)]])
    _drain(ANALYSES["basic"](parsed(True), spec, "5 minutes", by=["system_id"]), out, cp)
    assert held() == [(900, "a"), (900, "b")]
    # the window of b holds what was read before the restart
    rest = unfinished(spark, cp, parsed(False), spec, "basic", "5 minutes", by=["system_id"]).collect()
    assert {(r["system_id"], r["water_level_percent_count"]) for r in rest} == {("a", 1), ("b", 2)}
