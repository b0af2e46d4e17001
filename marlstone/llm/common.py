"""Helpers of the text operators: tables, shared files, bounded broadcasts."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources.scratch import new_path, written

__all__ = [
    "bound_batches",
    "broadcast_if_small",
    "forget",
    "kept",
    "new_path",
    "open_folder",
    "partitions",
    "row_key",
    "ship",
    "short_batches",
    "table",
    "unique_name",
    "written",
]

#: Rows up to which a side is broadcast; the rows counted here are a few dozen bytes wide.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once for each Spark application."""
    context = spark.sparkContext
    if getattr(context, "_marlstone_shipped", False):
        return
    package, packed = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    path = f"{new_path(spark, 'code')}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(path)
    context._marlstone_shipped = True


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of a batch for Python whose rows hold whole texts or sets.
WIDE_ROWS = 1024


def bound_batches(spark: SparkSession) -> str:
    """Send Python at most ``WIDE_ROWS`` rows at a time from now on; returns what the limit was."""
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) <= WIDE_ROWS:
        spark.conf.set(ARROW_ROWS, WIDE_ROWS)
    return before


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Bound the batches of the jobs run in this block.

    A batch stands in the JVM's buffers and in the worker at once, and neither soon gives its largest size back.
    """
    before = bound_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


#: What the operators remember in a worker process from one task to the next.
_KEPT: list[dict] = []


def kept(memory: dict) -> dict:
    """Declare a memory of worker processes, so that operators that follow can empty it."""
    _KEPT.append(memory)
    return memory


def forget(but: dict | None = None) -> None:
    """Empty the memories of other operators: a worker process serves the tasks of all of them, and theirs add up."""
    for memory in _KEPT:
        if memory is not but:
            memory.clear()
    pa.default_memory_pool().release_unused()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a shared folder, for use inside tasks."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return pyarrow.fs.LocalFileSystem(), os.path.abspath(uri)
    return pyarrow.fs.FileSystem.from_uri(uri)


def unique_name(label: str) -> str:
    """A file name no other task attempt uses: a retried task never meets the files of a lost one."""
    return f"{label}-{uuid.uuid4().hex}"


def row_key(text: str = "text") -> list:
    """Columns that tell documents apart where ``doc_id`` repeats or is null.

    Rows that agree in both are copies of one another and have the same result.
    """
    return [F.coalesce(F.col("doc_id"), F.lit(-1)).alias("key_id"), F.xxhash64("doc_id", text).alias("key_hash")]


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table for broadcast only if it is counted to be small; else joins shuffle it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
