"""Sources: envelope readers (Kafka, files) and table adapters."""

from .envelope import (
    kafka_options,
    publish_kafka,
    read_envelope_files,
    read_json_lines,
    read_kafka,
    to_envelope,
)
from .tables import TABLES, events_as_hydroponic, events_wide, lineitem_dense, props_k, table

__all__ = [
    "kafka_options",
    "publish_kafka",
    "read_envelope_files",
    "read_json_lines",
    "read_kafka",
    "to_envelope",
    "TABLES",
    "events_as_hydroponic",
    "events_wide",
    "lineitem_dense",
    "props_k",
    "table",
]
