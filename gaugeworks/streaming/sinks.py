"""Idempotent, lossless point sinks.

Points are written by Spark executors straight from the DataFrame (no
``collect``) under ``measurement=<m>/date=<d>/run=<r>/batch_id=<n>``.  The
date is that of the point, for points stamped with a window's end that of
the window's last instant, so reads by time prune folders.  A write
replaces only folders of its own run and batch
(``partitionOverwriteMode=dynamic``), so it can never delete what another
wrote:

* a stream's run is its query id, which belongs to the checkpoint: a
  replayed micro-batch rewrites its own rows, a reset checkpoint or a second
  job on the same sink gets folders of its own;
* a backfill declares the time range ``replace`` that it rewrites (and a
  ``label`` where several jobs fill the same range, e.g. one a system); these
  name its run.  Rows outside the range fail the write.  Backfills of
  different ranges or labels lie side by side.

Equal points (measurement, tags, time) of several runs lie side by side on
disk.  ``read_points`` gives one of each, every field with its newest value
(by the time its file was written), and ``compact_points`` rewrites a range
that way.

Errors propagate: a failed write fails the micro-batch, which is then
replayed from the checkpoint on restart.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.points import line_expr, newest_points, point_tags


PARTITIONS = ["measurement", "date", "run", "batch_id"]


def _partitioned(
    points: DataFrame, batch_id: int | None, run: str | None, replace: tuple | None, label: str | None, end_stamped: bool
) -> DataFrame:
    at = F.col("time") - F.expr("INTERVAL 1 MICROSECOND") if end_stamped else F.col("time")
    date = F.to_date(at)
    if batch_id is not None:
        return points.withColumns(
            {"date": date, "run": F.lit(run or "stream"), "batch_id": F.lit(int(batch_id))}
        )
    if replace is None:
        raise ValueError("a backfill needs replace=(from, to), the time range that it rewrites")
    low, high = (F.lit(str(x)).cast("timestamp") for x in replace)
    inside = (at >= low) & (at < high)
    checked = F.when(inside, date).otherwise(F.raise_error(F.concat(F.lit("point outside the replaced range: "), at.cast("string"))))
    name = "backfill_" + "_".join("".join(c if c.isalnum() else "-" for c in str(x)) for x in (*replace, label or "all"))
    # range-partition on (measurement, time) so each task covers a
    # contiguous time range (few date folders, few files per task) and a hot
    # date is split over several tasks
    dated = points.withColumns({"date": checked, "run": F.lit(name), "batch_id": F.lit(0)})
    return dated.repartitionByRange("measurement", "time")


def _overwrite(df: DataFrame, max_records_per_file: int = 5_000_000):
    return (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*PARTITIONS)
    )


def write_points(
    points: DataFrame,
    path: str,
    *,
    batch_id: int | None = None,
    run: str | None = None,
    replace: tuple | None = None,
    label: str | None = None,
    end_stamped: bool = False,
    fmt: str = "parquet",
    observe: bool = True,
) -> int | None:
    """Write wide points under ``path`` (Parquet by default), replacing
    what the same run and batch wrote.  Returns the number of points
    written (counted in the same pass through ``observe``), or ``None``
    when counting is off."""
    obs = None
    df = _partitioned(points, batch_id, run, replace, label, end_stamped)
    if observe:
        # observed above the range exchange: its sampling job must not count
        obs = Observation(f"points_{batch_id if batch_id is not None else 'batch'}")
        df = df.observe(obs, F.count(F.lit(1)).alias("points"))
    _overwrite(df).format(fmt).save(path)
    return int(obs.get.get("points", 0)) if obs is not None else None


def write_line_protocol(
    points: DataFrame,
    path: str,
    *,
    batch_id: int | None = None,
    run: str | None = None,
    replace: tuple | None = None,
    label: str | None = None,
    end_stamped: bool = False,
    precision: int | None = None,
) -> None:
    """Write points as line-protocol text files (one line per point),
    partitioned and replaced like ``write_points``."""
    keyed = _partitioned(points, batch_id, run, replace, label, end_stamped)
    text = keyed.select(line_expr(points, precision=precision).alias("value"), *PARTITIONS)
    _overwrite(text).text(path)


#: Column of compacted files: when the newest file behind a point was written.
STAMP = "_stamp"


def _stored(spark: SparkSession, path: str, measurement: str | None, dates: tuple | None) -> DataFrame:
    """Stored points (wide) with their stamp; files as listed now."""
    place = path.rstrip("/") + (f"/measurement={measurement}" if measurement else "")
    # measurements have fields of their own; those of one differ where sensors were added
    rows = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(place)
    if dates is not None:
        rows = rows.where((F.col("date") >= F.lit(str(dates[0])).cast("date")) & (F.col("date") < F.lit(str(dates[1])).cast("date")))
    written = F.col("_metadata.file_modification_time")
    if STAMP in rows.columns:
        written = F.coalesce(F.col(STAMP), written)
    # files written in one millisecond: the run and batch decide, alike for every reader
    order = F.struct(written.alias("at"), F.col("run").cast("string").alias("run"), F.col("batch_id").cast("long").alias("batch"))
    return rows.withColumn("__order", order)


def read_points(spark: SparkSession, path: str, *, measurement: str | None = None, dates: tuple | None = None) -> DataFrame:
    """Stored points, each (measurement, tags, time) once; ``dates`` is a
    half-open range of date folders."""
    rows = _stored(spark, path, measurement, dates)
    return newest_points(rows, F.col("__order"), ignore=("run",))


def compact_points(spark: SparkSession, path: str, measurement: str, dates: tuple) -> int:
    """Rewrite the points of a measurement in a range of dates so that each
    is stored once, and return how many files were replaced.

    The new files are complete before the old ones are deleted, and carry the
    stamp of what they replace.  So a compaction that breaks off at any point
    leaves a table that ``read_points`` reads alike (old, new, or both), the
    next one clears it up, and files that others write meanwhile are neither
    lost nor overruled.  Only the names of the range's files are listed here."""
    rows = _stored(spark, path, measurement, dates)
    old = [f for f in rows.inputFiles() if _in_range(f, dates)]
    if not old:
        return 0
    newest = newest_points(rows, F.col("__order"), ignore=("run",))
    keys = ["measurement", *[t for t in point_tags(newest)], "time"]
    stamps = rows.groupBy(*keys).agg(F.max("__order.at").alias(STAMP), F.min("date").alias("date"))
    same = [newest[k].eqNullSafe(stamps[k]) for k in keys]
    found = newest.join(stamps, same).select(*[newest[c] for c in newest.columns], stamps[STAMP], stamps["date"])
    named = found.withColumns({"run": F.lit(f"compacted_{uuid.uuid4().hex}"), "batch_id": F.lit(0)})
    _overwrite(named.repartitionByRange("measurement", "time")).parquet(path)
    for name in old:
        _delete_file(spark, name)
    return len(old)


def _delete_file(spark: SparkSession, name: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)


def _in_range(name: str, dates: tuple) -> bool:
    day = name.split("/date=", 1)[1].split("/", 1)[0]
    return str(dates[0]) <= day < str(dates[1])


class PointWriter:
    """Interface of an external point store used by
    ``foreach_partition_sink``."""

    def write(self, points: list[dict]) -> None:  # pragma: no cover - interface
        raise NotImplementedError

    def flush(self) -> None:
        pass

    def close(self) -> None:
        pass


def foreach_partition_sink(
    points: DataFrame,
    make_writer: Callable[[], PointWriter],
    *,
    batch_size: int = 1000,
) -> None:
    """Hand points to an external store, one client per partition, in
    batches of ``batch_size`` rows.  ``make_writer`` must be a picklable
    factory (a module-level function or class), never a live client.
    A failing write raises and fails the task (and so the batch)."""

    def run(rows: Iterable):
        writer = make_writer()
        try:
            buf = []
            for row in rows:
                buf.append(row.asDict())
                if len(buf) >= batch_size:
                    writer.write(buf)
                    buf = []
            if buf:
                writer.write(buf)
            writer.flush()
        finally:
            writer.close()

    points.foreachPartition(run)
