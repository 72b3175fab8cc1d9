"""Keyed-JSON envelope sources and the publish side (``to_envelope``).

An *envelope* is the Kafka record shape ``key binary, value binary,
timestamp timestamp``.  Kafka is the production source; directories of
Parquet envelope files or JSON-lines readings are the replayable sources
used by tests and backfills.  All readers return plain (streaming or
batch) DataFrames, so the parse and analysis operators do not care which
one produced the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import ENVELOPE_SCHEMA
from ..spec import PipelineSpec


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    *,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    max_poll_records: int | None = 1000,
    extra: dict | None = None,
) -> dict[str, str]:
    """Options of the Kafka source: one topic and a starting position
    (``earliest`` so a new checkpoint replays the topic; ``latest``
    reproduces a live-only consumer).  Lost offsets fail the query unless
    ``fail_on_data_loss`` is off, and there is no admission limit unless one is set."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if max_poll_records:
        opts["kafka.max.poll.records"] = str(int(max_poll_records))
    opts.update(extra or {})
    return opts


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str, *, stream: bool = True, **kw) -> DataFrame:
    """Kafka topic as an envelope DataFrame (needs the Kafka connector on
    the classpath)."""
    opts = kafka_options(bootstrap_servers, topic, **kw)
    reader = spark.readStream if stream else spark.read
    if not stream:
        opts.pop("maxOffsetsPerTrigger", None)
    return reader.format("kafka").options(**opts).load().select("key", "value", "timestamp")


def read_envelope_files(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "parquet",
    stream: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Directory of envelope files (``key, value, timestamp``).

    On a stream ``max_files_per_trigger`` is the admission limit (the file
    analogue of ``maxOffsetsPerTrigger``)."""
    if stream:
        reader = spark.readStream.schema(ENVELOPE_SCHEMA).format(fmt)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        return reader.load(path)
    return spark.read.schema(ENVELOPE_SCHEMA).format(fmt).load(path)


def read_json_lines(
    spark: SparkSession,
    path: str,
    *,
    stream: bool = True,
    max_files_per_trigger: int | None = None,
    key: str | None = None,
) -> DataFrame:
    """Directory of JSON-lines readings as envelopes: each line is a value,
    the key is the given constant (or NULL) and the record time is the
    ingest time."""
    if stream:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        lines = reader.load(path)
    else:
        lines = spark.read.format("text").load(path)
    return lines.select(
        F.lit(key).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.current_timestamp().alias("timestamp"),
    )


def to_envelope(
    df: DataFrame,
    spec: PipelineSpec,
    *,
    key_col: str | None = None,
    time_col: str | None = None,
    record_time_col: str | None = None,
) -> DataFrame:
    """Wide readings -> envelope records (the publish side).

    ``value`` is the JSON document ``{timestamp: epoch ms, sensors: {...},
    system_state: {...}}`` built with ``to_json`` (NULL readings are
    omitted from the document and parse back to NULL); ``key`` is the
    system id; ``timestamp`` is the record time (defaults to the event
    time)."""
    time_col = time_col or spec.time_col
    key_col = key_col or spec.system_col
    t = F.col(time_col).cast("timestamp")
    sensors = F.struct(*[F.col(s) for s in spec.sensor_names if s in df.columns])
    fields = [F.unix_millis(t).alias("timestamp"), sensors.alias("sensors")]
    state = [F.col(n) for n, _ in spec.state_fields if n in df.columns]
    if state:
        fields.append(F.struct(*state).alias("system_state"))
    rec_t = F.col(record_time_col).cast("timestamp") if record_time_col else t
    return df.select(
        F.col(key_col).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        rec_t.alias("timestamp"),
    )


def publish_kafka(df: DataFrame, bootstrap_servers: str, topic: str, *, compression: str = "snappy",
                  batch_size: int = 16384, linger_ms: int = 10, retries: int = 3, checkpoint: str | None = None):
    """Write envelopes to a Kafka topic (batch write, or a started stream
    when ``df`` is streaming).  Producer settings mirror a low-latency
    publisher: snappy, 16 KiB batches, 10 ms linger, 3 retries."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "kafka.compression.type": compression,
        "kafka.batch.size": str(batch_size),
        "kafka.linger.ms": str(linger_ms),
        "kafka.retries": str(retries),
    }
    out = df.select(F.col("key"), F.col("value"))
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming publish needs a checkpoint location")
        return out.writeStream.format("kafka").options(**opts).option("checkpointLocation", checkpoint).start()
    out.write.format("kafka").options(**opts).save()
    return None
