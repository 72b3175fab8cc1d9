"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these (ASCII white space).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Partitions of an intermediate of known size: so many a core, or more at so many rows each.
PARTS_A_CORE = 8
ROWS_A_PART = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One provided table, through Spark's reader only (the path may be in
    a store that nothing else can open)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: Column, folds: int = 5) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; NULL ids count as
    the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def held_out(id_col: Column) -> Column:
    return fold(id_col) == F.lit(0)


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """``wanted``, each with underscores behind it as long as a column has
    that name (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the cluster's ``spark.checkpoint.dir``.

    Only where a *local* session names none (tests), a temporary folder
    becomes its checkpoint folder; a cluster without one is an error."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gaugeworks-"))
        base = context.getCheckpointDir()
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + os.path.abspath(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def in_few_parts(df: DataFrame, rows: int | None) -> DataFrame:
    """``df`` in no more partitions than its at most ``rows`` rows are worth
    (as it is, if None).  With many shuffle partitions a small table is
    otherwise mostly the start of Python workers and the commit of tiny
    files."""
    if rows is None:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(PARTS_A_CORE * cores, -(-rows // ROWS_A_PART)))


def written(df: DataFrame, purpose: str, rows: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Cut lineage: write an intermediate to the shared folder as Parquet
    and read it back, so a lost executor costs no recomputation and the
    optimizer knows its size.  ``rows``, a bound on its number of rows,
    limits the files (``in_few_parts``); ``options`` are the writer's."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    in_few_parts(df, rows).write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def wide_row_options(group_bytes: int, plain: tuple[str, ...] = ()) -> dict[str, str]:
    """Writer options for rows of some MB: pages and row groups end by size
    after any row.  Parquet looks at sizes only from the hundredth row on
    otherwise, so a writer, and each reader, holds that many rows at once.
    Columns in ``plain`` (values that never repeat) get no dictionary."""
    return {
        "parquet.block.size": str(group_bytes),
        "parquet.block.size.row.check.min": "1",
        "parquet.block.size.row.check.max": "1",
        "parquet.page.size.row.check.min": "1",
        "parquet.page.size.check.estimate": "false",
    } | {f"parquet.enable.dictionary#{c}": "false" for c in plain}


@contextmanager
def arrow_batches(spark: SparkSession, max_bytes: int) -> Iterator[None]:
    """Python workers get Arrow batches of about ``max_bytes`` at most in
    what is executed inside (64 MB by default, held by both sides)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(max_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def drop_written(df: DataFrame) -> None:
    """Delete the folder of an intermediate made by ``written``."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
