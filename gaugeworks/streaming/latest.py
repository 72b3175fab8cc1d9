"""The latest value of every sensor, kept as a table by a stream.

The table is dealt into buckets by system.  A micro-batch is reduced to one
row a system, merged with the rows of the buckets that it touches, and only
these buckets are written anew; a small file per version names the folder of
every bucket.  That file is put in place by one rename, so readers see a
version whole or not at all, and a break-off at any point leaves the version
before it.  Folders of the last ``keep`` versions stay for those who still
read them.

A merge takes the newest of two values, so merging a batch twice changes
nothing: a replayed batch, a new checkpoint or a backfill through the same
stream leave the table right.  One stream may write a table at a time.

    <table>/_versions/version=<n>       {"buckets": .., "schema": .., "folders": {bucket: version}}
    <table>/version=<n>/bucket=<b>/     the rows of a bucket that version n wrote
"""

from __future__ import annotations

import json
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import PipelineSpec
from .fanout import _fs, get_text, put_folder, put_text

LAST_SEEN = "last_seen"


def _sensors(columns: list[str], keys: list[str]) -> list[str]:
    return [c for c in columns if c not in (*keys, LAST_SEEN, "bucket")]


def latest_pairs(readings: DataFrame, spec: PipelineSpec) -> DataFrame:
    """One row a system: for each sensor its newest (time, value), and the
    newest time.  Of values at one time the largest counts, whatever the
    order of arrival.  Readings without a time come before all others."""
    t = F.col(spec.time_col).cast("timestamp")
    names = [s for s in spec.sensor_names if s in readings.columns]
    pairs = [F.max(F.when(F.col(c).isNotNull(), F.struct(t.alias("at"), F.col(c).alias("value")))).alias(c) for c in names]
    return readings.groupBy(spec.system_col).agg(*pairs, F.max(t).alias(LAST_SEEN))


def _versions(spark: SparkSession, table: str) -> list[int]:
    fs, p = _fs(spark, f"{table}/_versions")
    if not fs.exists(p):
        return []
    numbers = [s.getPath().getName().partition("=")[2] for s in fs.listStatus(p)]
    return sorted(int(n) for n in numbers if n.isdigit())  # one being written is named differently


def _version(spark: SparkSession, table: str, number: int) -> dict:
    return json.loads(get_text(spark, f"{table}/_versions/version={number}"))


def _rows(spark: SparkSession, table: str, version: dict, buckets: list[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(version["schema"])
    wanted = version["folders"] if buckets is None else {b: v for b, v in version["folders"].items() if b in buckets}
    places = [f"{table}/version={v}/bucket={b}" for b, v in wanted.items()]
    return spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)


def upsert_latest(batch: DataFrame, spec: PipelineSpec, table: str, *, buckets: int = 32, keep: int = 3) -> int | None:
    """Merge readings into the table; returns the version written, or
    ``None`` for a batch without rows, which writes nothing.  A table keeps
    the number of buckets that it was made with."""
    spark, table = batch.sparkSession, table.rstrip("/")
    known = _versions(spark, table)
    before = _version(spark, table, known[-1]) if known else {"buckets": buckets, "folders": {}}
    key = spec.system_col
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(before["buckets"])).cast("int")
    news = latest_pairs(batch, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # one row comes to the driver, with at most ``buckets`` numbers
        touched = [str(b) for b in news.agg(F.collect_set(bucket).alias("b")).first()["b"]]
        if not touched:
            return None
        both = news
        if before["folders"]:
            both = news.unionByName(_rows(spark, table, before, touched), allowMissingColumns=True)
        names = [c for c in both.columns if c != key]
        merged = both.groupBy(key).agg(*[F.max(c).alias(c) for c in names])
        number = known[-1] + 1 if known else 0
        fs, left_over = _fs(spark, f"{table}/version={number}")
        fs.delete(left_over, True)  # of a write that broke off; no version names it
        out = merged.withColumn("bucket", bucket)
        put_folder(out.hint("rebalance", "bucket"), table, f"version={number}", partition_by=("bucket",))
    finally:
        news.unpersist()
    after = {
        "buckets": before["buckets"],
        "schema": json.loads(merged.schema.json()),
        "folders": before["folders"] | {b: number for b in touched},
    }
    put_text(spark, f"{table}/_versions/version={number}", json.dumps(after))
    _drop_old(spark, table, [*known, number], keep)
    return number


def _drop_old(spark: SparkSession, table: str, versions: list[int], keep: int) -> None:
    """Delete versions but the last ``keep``, and the folders only they name."""
    used = {(b, v) for n in versions[-keep:] for b, v in _version(spark, table, n)["folders"].items()}
    alive = {v for _, v in used}
    for n in versions[:-keep]:
        for b, v in _version(spark, table, n)["folders"].items():
            if (b, v) not in used:
                fs, place = _fs(spark, f"{table}/version={v}" + (f"/bucket={b}" if v in alive else ""))
                fs.delete(place, True)
        fs, place = _fs(spark, f"{table}/_versions/version={n}")
        fs.delete(place, False)


def read_latest(spark: SparkSession, table: str, *, times: bool = False, version: int | None = None) -> DataFrame:
    """The newest version (or one of those kept): a row a system with the
    latest value of each sensor and ``last_seen``, as ``latest_readings``
    gives; ``times`` adds ``<sensor>_at``."""
    table = table.rstrip("/")
    known = _versions(spark, table)
    if not known:
        raise FileNotFoundError(f"no latest-value table in {table}")
    rows = _rows(spark, table, _version(spark, table, known[-1] if version is None else version))
    key = rows.columns[0]
    names = _sensors(rows.columns, [key])
    ats = [F.col(f"{c}.at").alias(f"{c}_at") for c in names] if times else []
    return rows.select(key, *[F.col(f"{c}.value").alias(c) for c in names], LAST_SEEN, *ats)


def _merge(batch: DataFrame, _batch_id: int, *, spec: PipelineSpec, table: str, buckets: int) -> None:
    upsert_latest(batch, spec, table, buckets=buckets)


def start_latest(
    readings: DataFrame, spec: PipelineSpec, table: str, checkpoint: str, *, buckets: int = 32, trigger: dict | None = None, name: str = "latest"
):
    """Keep the table at ``table`` from a stream of readings.  The table is
    the only state: late readings count as any other."""
    return (
        readings.writeStream.queryName(name)
        .foreachBatch(partial(_merge, spec=spec, table=table, buckets=buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
