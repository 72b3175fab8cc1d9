"""What a stream still holds: its state store read as a table.

A window is emitted once the watermark has passed its end, so the last
windows of a source that falls silent stay in the state.  ``open_windows``
lists them from the checkpoint, and ``unfinished`` gives their analysis as
far as it is known, so a report need not end at the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import ANALYSES
from ..spec import PipelineSpec


def stateful_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``operatorId, operatorName, numPartitions, minBatchId, maxBatchId`` of
    the stateful operators of a checkpoint.  The number of partitions is
    fixed by the first start, whatever the session says at a restart."""
    rows = spark.read.format("state-metadata").load(checkpoint)
    return rows.select("operatorId", "operatorName", "numPartitions", "minBatchId", "maxBatchId")


def open_windows(spark: SparkSession, checkpoint: str, *, batch_id: int | None = None) -> DataFrame:
    """The keys (``window`` and those of ``by``) that a windowed aggregate
    holds after its last batch, or after ``batch_id`` while that is kept."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.*")


def unfinished(
    spark: SparkSession, checkpoint: str, readings: DataFrame, spec: PipelineSpec, kind: str, window: str, *, by=(), **options
) -> DataFrame:
    """The analysis ``kind`` of the open windows of a stream, over
    ``readings`` (a table of what the stream has read; late readings are in
    no open window).  With the rows that the stream has emitted these are the
    analysis of the whole table."""
    held = open_windows(spark, checkpoint).select(F.struct("window.start", "window.end").alias("window"), *by).alias("held")
    # open windows are the newest: the scan begins at the first of them
    first = held.agg(F.min("window.start").alias("t")).first()["t"]
    if first is None:
        return ANALYSES[kind](readings.limit(0), spec, window, by=by, **options)
    recent = readings.where(F.col(spec.time_col).cast("timestamp") >= F.lit(first))
    found = ANALYSES[kind](recent, spec, window, by=by, watermark=None, **options).alias("found")
    same = [F.col("found.window.start") == F.col("held.window.start")]
    same += [F.col(f"found.{k}").eqNullSafe(F.col(f"held.{k}")) for k in by]
    return found.join(held, same, "left_semi")
