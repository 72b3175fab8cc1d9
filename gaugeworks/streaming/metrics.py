"""Pipeline metrics from the streaming query listener.

What a stream reads and writes is counted by ``observe`` inside its own plan,
so counting takes no pass of its own; the listener adds up the numbers of
every finished micro-batch.  A micro-batch that fails is not counted until
its replay is through.

* ``observe_readings`` counts records and rejected documents where the source
  is parsed.  Several queries may parse the same source: its records count
  once.
* ``observe_points`` counts the points of a measurement, the rows that give
  none and the fields dropped for not being finite (missing ones are not
  counted).  ``start_streams`` puts it on every output.
"""

from __future__ import annotations

import threading
import time
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.expressions import finite
from ..operators.parse import is_rejected
from ..spec import PipelineSpec

READINGS, POINTS = "readings:", "points:"


def observe_readings(parsed: DataFrame, spec: PipelineSpec, source: str = "source") -> DataFrame:
    """Count what is parsed from ``source``, under that name."""
    rejected = F.count_if(is_rejected(parsed, spec))
    return parsed.observe(READINGS + source, F.count(F.lit(1)).alias("records"), rejected.alias("rejected"))


def observe_points(rows: DataFrame, measurement: str, fields: list[str]) -> DataFrame:
    """Count the points that ``rows`` give with these fields."""
    if not fields:
        return rows
    values = [finite(c) for c in fields]
    dropped = sum((F.when(F.col(c).isNotNull() & v.isNull(), 1).otherwise(0) for c, v in zip(fields, values)), F.lit(0))
    is_point = F.coalesce(*values).isNotNull()
    return rows.observe(
        POINTS + measurement,
        F.count_if(is_point).alias("points"),
        F.count_if(~is_point).alias("dropped_rows"),
        F.coalesce(F.sum(dropped), F.lit(0)).alias("dropped_fields"),
    )


class PipelineMetrics(StreamingQueryListener):
    """Counters per query (input rows, batches, failures, late rows), per
    source (records, rejected documents) and per measurement (points, dropped
    rows and fields, batches written); plus the active-stream gauge and the
    last watermark."""

    def __init__(self, spark: SparkSession | None = None):
        self._spark = spark
        self._lock = threading.Lock()
        self.records_processed = defaultdict(int)
        self.batches = defaultdict(int)
        self.failures = defaultdict(int)
        self.write_failures = defaultdict(int)
        self.rows_per_second = {}
        self.watermark = {}
        self.late_rows = defaultdict(int)
        self.points = defaultdict(int)
        self.dropped_rows = defaultdict(int)
        self.dropped_fields = defaultdict(int)
        self.batches_written = defaultdict(int)
        self._parsed = defaultdict(lambda: defaultdict(lambda: [0, 0]))  # source -> query -> records, rejected
        self._counted = {}  # (run, measurement) -> last batch counted by count_points
        self._names = {}
        self._running = set()

    # listener callbacks -------------------------------------------------
    def onQueryStarted(self, event):
        with self._lock:
            self._names[str(event.id)] = event.name or str(event.id)
            self._running.add(str(event.runId))

    def onQueryProgress(self, event):
        p = event.progress
        name = p.name or str(p.id)
        with self._lock:
            self.records_processed[name] += int(p.numInputRows or 0)
            self.batches[name] += 1
            self.rows_per_second[name] = float(p.processedRowsPerSecond or 0.0)
            wm = (p.eventTime or {}).get("watermark")
            if wm:
                self.watermark[name] = wm
            for op in p.stateOperators or []:
                self.late_rows[name] += int(getattr(op, "numRowsDroppedByWatermark", 0) or 0)
            for key, row in (p.observedMetrics or {}).items():
                self._observed(name, key, row)

    def _observed(self, query: str, key: str, row) -> None:
        if key.startswith(READINGS):
            counts = self._parsed[key[len(READINGS) :]][query]
            counts[0] += int(row["records"] or 0)
            counts[1] += int(row["rejected"] or 0)
        elif key.startswith(POINTS):
            measurement = key[len(POINTS) :]
            self.dropped_rows[measurement] += int(row["dropped_rows"] or 0)
            self.dropped_fields[measurement] += int(row["dropped_fields"] or 0)
            self._add_points(measurement, int(row["points"] or 0))

    def _add_points(self, measurement: str, n: int) -> None:
        self.points[measurement] += n
        self.batches_written[measurement] += n > 0

    def count_points(self, run: str, measurement: str, batch_id: int, n: int) -> None:
        """Count the points of one write of a sink that observes its writes
        itself; a write that is repeated counts once."""
        with self._lock:
            if batch_id > self._counted.get((run, measurement), -1):
                self._counted[run, measurement] = batch_id
                self._add_points(measurement, n)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self._lock:
            self._running.discard(str(event.runId))
            if event.exception:
                name = self._names.get(str(event.id), str(event.id))
                self.failures[name] += 1
                # every sink of this package writes in foreachBatch
                self.write_failures[name] += "FOREACH_BATCH" in f"{event.errorClassOnException} {event.exception}"

    # read side ----------------------------------------------------------
    def active_streams(self) -> int:
        return len(self._spark.streams.active) if self._spark is not None else 0

    def wait_ended(self, timeout: float = 30.0) -> bool:
        """Wait until the ends of all queries that started have been heard
        of (events arrive a little later than what they report)."""
        until = time.monotonic() + timeout
        while time.monotonic() < until:
            with self._lock:
                if not self._running:
                    return True
            time.sleep(0.05)
        return False

    def _of_source(self, which: int) -> dict:
        return {source: max(c[which] for c in queries.values()) for source, queries in self._parsed.items()}

    def snapshot(self) -> dict:
        with self._lock:
            records, rejected = self._of_source(0), self._of_source(1)
            return {
                "records_processed": dict(self.records_processed),
                "records": records,
                "rejected": rejected,
                "batches": dict(self.batches),
                "batches_written": dict(self.batches_written),
                "failures": dict(self.failures),
                "write_failures": dict(self.write_failures),
                "points": dict(self.points),
                "dropped_rows": dict(self.dropped_rows),
                "dropped_fields": dict(self.dropped_fields),
                # --- fixed values: counter names.  Records count once a source;
                # without observed ones, the outputs are taken to read the same
                "records_processed_total": sum(records.values()) if records else max(self.records_processed.values(), default=0),
                "batches_written_total": sum(self.batches_written.values()),
                "write_errors_total": sum(self.write_failures.values()),
                "rows_per_second": dict(self.rows_per_second),
                "watermark": dict(self.watermark),
                "late_rows": dict(self.late_rows),
                "active_streams": self.active_streams(),
            }


def attach(spark: SparkSession) -> PipelineMetrics:
    """Create a metrics listener and register it with the session."""
    m = PipelineMetrics(spark)
    spark.streams.addListener(m)
    return m
