"""Adapters from the provided tables to wide sensor readings.

Each adapter is a single projection over a Parquet scan, so Catalyst
prunes the columns it does not use and pushes any later filter into the
scan.  Output columns: ``system_id``, ``event_time`` and one column per
sensor of the matching spec.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import EVENT_TYPES, LINEITEM_SENSORS

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str, *, fresh: bool = False) -> DataFrame:
    """One provided table: ``{sf_dir}/{name}.parquet``.

    The provided tables are read-only, so the scan DataFrame (file listing
    and footer schema) is reused per session; ``fresh`` forces a new read."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (id(spark), path)
    df = _TABLES.get(key)
    if fresh or df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _TABLES[key] = df
    return df


def props_k(props="props"):
    """The ``k`` member of the ``props`` JSON text, as an integer."""
    return F.get_json_object(F.col(props), "$.k").cast("int")


def events_wide(events: DataFrame) -> DataFrame:
    """``events`` as sparse wide readings.

    Each event type is one sensor holding ``value`` on its own rows (NULL
    elsewhere); ``system_id`` is the user, ``event_time`` the event
    timestamp and the activity column is ``props.k / 100``."""
    cols = [
        F.col("user_id").alias("system_id"),
        F.col("ts").alias("event_time"),
    ]
    cols += [F.when(F.col("event_type") == F.lit(t), F.col("value")).alias(t) for t in EVENT_TYPES]
    cols.append((props_k().cast("double") / F.lit(100.0)).alias("plant_activity"))
    return events.select(*cols)


def events_with_gaps(events: DataFrame, keep=()) -> DataFrame:
    """All of ``events`` as sparse wide readings, some of them broken by a
    fixed rule on the id: every 11th value is NULL, of the others every 7th
    is NaN, and every 13th event time is NULL.  ``sensor_timestamp`` (epoch
    ms) is always there.  Columns in ``keep`` are carried along."""
    n = F.col("event_id")
    value = F.when(n % 11 == 0, F.lit(None)).when(n % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return events.withColumn("value", value).select(
        *keep,
        F.col("user_id").alias("system_id"),
        F.when(n % 13 != 0, F.col("ts")).alias("event_time"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("sensor_timestamp"),
        *[F.when(F.col("event_type") == F.lit(t), F.col("value")).alias(t) for t in EVENT_TYPES],
        (props_k().cast("double") / F.lit(100.0)).alias("plant_activity"),
    )


def lineitem_dense(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as dense readings on the ship date (four sensors).

    ``+ 0.0`` turns the ``-0.0`` present in the data into ``0.0`` so that
    minima and maxima are sign-stable."""
    cols = [F.col("l_returnflag").alias("system_id"), F.col("l_shipdate").alias("event_time")]
    cols += [(F.col(c) + F.lit(0.0)).alias(c) for c in LINEITEM_SENSORS]
    return lineitem.select(*cols)


def events_as_hydroponic(events: DataFrame) -> DataFrame:
    """``events`` mapped onto the seven hydroponic sensors (dense rows).

    A fixed, documented derivation so the domain operators (activity,
    cleaning, status lines, control actions) run over a provided table:
    ``value`` drives water temperature, EC, light and air temperature,
    ``props.k`` drives pH, level and humidity."""
    v = F.col("value")
    k = props_k().cast("double")
    return events.select(
        F.col("user_id").alias("system_id"),
        F.col("event_id"),
        F.col("ts").alias("event_time"),
        (v / F.lit(10.0) + F.lit(10.0)).alias("water_temperature"),
        (k / F.lit(20.0) + F.lit(3.5)).alias("water_ph"),
        (v / F.lit(100.0)).alias("ec_tds"),
        k.alias("water_level_percent"),
        (v / F.lit(20.0) + F.lit(15.0)).alias("air_temperature"),
        (k / F.lit(2.0) + F.lit(30.0)).alias("humidity"),
        (v * F.lit(2.5)).alias("light_intensity_ppfd"),
    )
