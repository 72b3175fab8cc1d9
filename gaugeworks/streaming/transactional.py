"""A transactional point writer on Spark's Python data source interface.

Tasks hand whole Arrow batches to a ``PointStore``, which keeps them out of
sight; the names of what was staged travel back as commit messages, and the
driver's commit makes the points of a batch visible at once.  A failed job
aborts what its tasks staged.  A micro-batch that is replayed after its
commit is dropped again, so each point is stored once.

    spark.dataSource.register(point_source(FilePointStore("s3://bucket/points")))
    points.write.format("points").option("run", "2024-01").mode("append").save()
    points.writeStream.format("points").option("run", "raw").option("checkpointLocation", ...).start()

``run`` names the writer: with ``overwrite`` a batch write replaces what the
same run wrote (and may be repeated), with ``append`` it adds to it.  A
stream needs a run of its own for every checkpoint.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage


class PointStore:
    """What a store must offer.  It is sent to the executors, so it holds
    settings, never a live client."""

    def stage(self, name: str, batches: Iterator[pa.RecordBatch]) -> int:  # pragma: no cover - interface
        """Keep the points of one task out of sight; returns their number.
        Leaves nothing behind when it fails."""
        raise NotImplementedError

    def commit(self, label: str, names: list[str], *, replace: bool) -> None:  # pragma: no cover - interface
        """Show all staged parts at once.  With ``replace`` they take the
        place of what the label showed; without, a label that was committed
        before stays as it is and these parts go."""
        raise NotImplementedError

    def abort(self, label: str, names: list[str]) -> None:  # pragma: no cover - interface
        """Drop staged parts; unknown names are no error.  Parts that the
        label shows stay: Spark also aborts when the answer to a commit that
        took effect was lost."""
        raise NotImplementedError


class FilePointStore(PointStore):
    """Parquet files under ``path/data``; ``path/_commits`` holds one small
    file per commit, which lists those that count."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _place(self, *parts: str) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri("/".join([self.path, *parts]))

    def _file(self, name: str) -> str:
        return f"{name}.parquet"

    def stage(self, name: str, batches: Iterator[pa.RecordBatch]) -> int:
        first = next(batches, None)
        if first is None:
            return 0
        fs, place = self._place("data", self._file(name))
        fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
        n = 0
        try:
            with fs.open_output_stream(place) as out, pq.ParquetWriter(out, first.schema) as writer:
                while first is not None:
                    writer.write_batch(first)
                    n += first.num_rows
                    first = next(batches, None)
        except BaseException:
            self._drop([name])
            raise
        return n

    def commit(self, label: str, names: list[str], *, replace: bool) -> None:
        fs, place = self._place("_commits", f"{label}.json")
        fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
        before = _listed(fs, place)
        if before is not None and not replace:
            self._drop([n for n in names if n not in before])
            return
        with fs.open_output_stream(f"{place}.new") as out:
            out.write(json.dumps(names).encode())
        fs.move(f"{place}.new", place)
        self._drop([n for n in before or [] if n not in names])

    def abort(self, label: str, names: list[str]) -> None:
        shown = _listed(*self._place("_commits", f"{label}.json")) or []
        self._drop([n for n in names if n not in shown])

    def _drop(self, names: list[str]) -> None:
        for name in names:
            fs, place = self._place("data", self._file(name))
            if fs.get_file_info(place).type != pafs.FileType.NotFound:
                fs.delete_file(place)

    def committed(self) -> list[str]:
        """The names of all parts that count."""
        fs, place = self._place("_commits")
        found = fs.get_file_info(pafs.FileSelector(place, allow_not_found=True))
        commits = sorted(f.path for f in found if f.path.endswith(".json"))
        return [n for c in commits for n in _listed(fs, c) or []]

    def purge(self, older_than: float = 86_400.0) -> int:
        """Delete parts that no commit names and that are older than so many
        seconds (of executors lost while staging); returns their number."""
        fs, place = self._place("data")
        listed = fs.get_file_info(pafs.FileSelector(place, allow_not_found=True))  # before the commits
        kept = {self._file(n) for n in self.committed()}
        lost = [f.path for f in listed if f.base_name not in kept and time.time() - f.mtime.timestamp() > older_than]
        for name in lost:
            fs.delete_file(name)
        return len(lost)

    def read(self, spark: SparkSession) -> DataFrame:
        """The committed points.  The driver holds their file names."""
        names = [f"{self.path}/data/{self._file(n)}" for n in self.committed()]
        if not names:
            raise FileNotFoundError(f"no committed points in {self.path}")
        return spark.read.option("mergeSchema", "true").parquet(*names)


def _listed(fs: pafs.FileSystem, place: str) -> list[str] | None:
    if fs.get_file_info(place).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(place) as f:
        return json.loads(f.read())


@dataclass
class Staged(WriterCommitMessage):
    """A task's part; without a name where the task had no points."""

    name: str | None
    points: int


def _names(messages) -> list[str]:
    return [m.name for m in messages if m is not None and m.name]


class _Staging:
    def __init__(self, store: PointStore, run: str):
        self.store, self.run = store, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        name = f"{self.run}-{uuid.uuid4().hex}"
        n = self.store.stage(name, (b for b in iterator if b.num_rows))
        return Staged(name if n else None, n)


class _BatchWriter(_Staging, DataSourceArrowWriter):
    def __init__(self, store: PointStore, run: str, overwrite: bool):
        super().__init__(store, run)
        # the driver's object commits: one label a write
        self.label, self.overwrite = (run if overwrite else f"{run}-{uuid.uuid4().hex}"), overwrite

    def commit(self, messages) -> None:
        self.store.commit(self.label, _names(messages), replace=self.overwrite)

    def abort(self, messages) -> None:
        self.store.abort(self.label, _names(messages))


class _StreamWriter(_Staging, DataSourceStreamArrowWriter):
    def _label(self, batch_id: int) -> str:
        return f"{self.run}-{batch_id:012d}"

    def commit(self, messages, batchId: int) -> None:  # noqa: N803 - Spark's name
        names = _names(messages)
        if names:
            self.store.commit(self._label(batchId), names, replace=False)

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        self.store.abort(self._label(batchId), _names(messages))


def point_source(store: PointStore, name: str = "points") -> type[DataSource]:
    """A data source, to be registered under ``name``, that writes to ``store``."""

    class PointSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def _run(self) -> str:
            run = self.options.get("run", "")
            if not run or not all(c.isalnum() or c in "-_." for c in run):
                raise ValueError("option 'run' must name the writer (letters, digits, '-', '_', '.')")
            return run

        def writer(self, schema, overwrite: bool):
            return _BatchWriter(store, self._run(), overwrite)

        def streamWriter(self, schema, overwrite: bool):  # noqa: N802 - Spark's name
            return _StreamWriter(store, self._run())

    return PointSource
