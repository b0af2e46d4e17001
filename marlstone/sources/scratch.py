"""Tables written to the folder all executors share.

A plan that is read more than once is written out rather than cached: a written
table survives the loss of any executor, and later stages read only the columns
they need.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _private_folder()


@cache
def _private_folder() -> str:
    return tempfile.mkdtemp(prefix="marlstone-")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/marlstone/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the table read back."""
    return _stored(df, new_path(df.sparkSession, label))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_table(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like ``written``, for jobs that are done with the table at the end of the block."""
    path = new_path(df.sparkSession, label)
    try:
        yield _stored(df, path)
    finally:
        remove(df.sparkSession, path)


@contextmanager
def scratch_parts(parts: Sequence[DataFrame], label: str) -> Iterator[DataFrame]:
    """Like ``scratch_table``, of the rows of all ``parts``, which are computed one after the other."""
    spark = parts[0].sparkSession
    path = new_path(spark, label)
    try:
        for part in parts:
            part.write.mode("append").parquet(path)
        yield spark.read.schema(parts[0].schema).parquet(path)
    finally:
        remove(spark, path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Each plan run in this block removes its shuffle files when it has ended.

    Else they stay until the driver happens to collect its garbage, so a job of many plans may hold those of all at once.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop(spark, path)
    return files.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if there is no such path."""
    files, target = _hadoop(spark, path)
    found = files.listStatus(target) if files.exists(target) else []
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def fingerprint(spark: SparkSession, path: str) -> str:
    """Number, bytes and latest change of the data files under a path; another one tells that it was written anew."""
    files, target = _hadoop(spark, path)
    found, n, size, latest = files.listFiles(target, True), 0, 0, 0
    while found.hasNext():
        status = found.next()
        if status.getPath().getName().startswith(("_", ".")):
            continue
        n, size, latest = n + 1, size + status.getLen(), max(latest, status.getModificationTime())
    return f"{n}-{size}-{latest}"


def remove(spark: SparkSession, path: str) -> None:
    files, target = _hadoop(spark, path)
    files.delete(target, True)


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as that file system takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target
