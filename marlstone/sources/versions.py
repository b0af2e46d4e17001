"""A dimension stored as immutable versions with a commit log.

A merge never overwrites the files it reads.  Version ``n`` is a folder with the
versions of rows current after batch ``n`` and the rows that batch closed:

    <base>/v=<n>/is_current=true|false/...   data
    <base>/_commits/...                      one small record per finished version

The dimension is the current part of the last committed version plus the closed
part of all versions up to it, so history is written once and never copied.  Only
a batch older than one that is stored rewrites it: its commit says since which
version closed rows hold.  A folder without commit record is left over from a failed run; the next one
replaces it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marlstone.functions.rules import moment
from marlstone.sources.evolution import as_schema, disputed
from marlstone.sources.readers import locate
from marlstone.sources.scratch import exists

LOG = "_commits"
RECORD = "version bigint, batch_id string, committed_at timestamp, columns string, batch_at timestamp, since bigint"
FOLDERS = "`v` bigint, `is_current` boolean"


@dataclass(frozen=True)
class Commit:
    version: int
    batch_id: str
    committed_at: datetime
    columns: str  # every column any version has; spares readers the file footers
    batch_at: datetime | None = None  # time of the batch, if that is not the time of the commit
    since: int | None = None  # closed rows of versions before this one hold no more


@dataclass(frozen=True)
class State:
    last: Commit | None
    seen: bool  # is the batch asked about committed already?


def state(spark: SparkSession, base: str, batch_id: str | None = None) -> State:
    """The last commit, and whether a batch has been committed, from one look at the log."""
    path = locate(base, LOG)
    if not exists(spark, path):
        return State(None, False)
    log = spark.read.schema(RECORD).json(path)
    last = F.max_by(F.struct("version", "batch_id", "committed_at", "columns", "batch_at", "since"), "version")
    found = log.agg(last.alias("last"), F.bool_or(F.col("batch_id") == batch_id).alias("seen")).first()
    return State(Commit(*found.last) if found.last else None, bool(found.seen))


def last_commit(spark: SparkSession, base: str) -> Commit:
    last = state(spark, base).last
    if last is None:
        raise FileNotFoundError(f"no committed version under {base}")
    return last


@dataclass(frozen=True)
class Place:
    """Where a batch time stands among the batches of a history."""

    late: bool  # is a batch of a later time stored?
    next_batch: datetime | None
    latest: datetime


def place(spark: SparkSession, base: str, at) -> Place:
    log, now = spark.read.schema(RECORD).json(locate(base, LOG)), moment(at)
    time = F.coalesce("batch_at", "committed_at")
    found = log.agg(
        F.max(F.when(time == now, F.col("batch_id"))).alias("same"), F.min(F.when(time > now, time)).alias("next"),
        F.greatest(F.max(time), now).alias("latest"),
    ).first()
    if found.same is not None:
        raise ValueError(f"batch {found.same} has the time {at} already")
    return Place(found.next is not None, found.next, found.latest)


def read_versions(spark: SparkSession, base: str, commit: Commit, part: str = "all") -> DataFrame:
    """The dimension as of a commit, or only its ``current`` or ``closed`` rows.

    Rows closed by earlier versions keep the types they were written with; those that differ are cast on reading.
    """
    log = spark.read.schema(RECORD).json(locate(base, LOG)).filter(F.col("version").between(commit.since or 0, commit.version))
    written_as: dict[str, list[int]] = {}
    for row in log.select("version", "columns").distinct().collect():  # one row a version
        written_as.setdefault(row.columns, []).append(row.version)
    wanted = _schema(commit.columns)
    changed = {c for c in written_as if disputed([_schema(c), wanted])}
    kept = [v for c, versions in written_as.items() if c not in changed for v in versions]
    parts = [_chosen(spark, base, commit.columns, commit, part, kept if changed else None)]
    parts += [as_schema(_chosen(spark, base, c, commit, part, written_as[c]), parts[0].schema) for c in sorted(changed)]
    return reduce(DataFrame.unionAll, parts)


def _schema(columns: str) -> StructType:
    return StructType.fromDDL(columns)


def _chosen(spark: SparkSession, base: str, columns: str, commit: Commit, part: str, versions: list[int] | None) -> DataFrame:
    stored = spark.read.schema(f"{columns}, {FOLDERS}").parquet(base)
    if versions is not None:
        stored = stored.filter(F.col("v").isin(versions))
    current = F.col("is_current") & (F.col("v") == commit.version)
    closed = ~F.col("is_current") & F.col("v").between(commit.since or 0, commit.version)
    chosen = {"all": current | closed, "current": current, "closed": closed}[part]
    return stored.filter(chosen).drop("v")


def write_version(
    rows: DataFrame, base: str, version: int, batch_id: str, at: datetime, since: int | None = None, batch_at=None
) -> Commit:
    """Write rows that carry ``is_current`` as a new version and commit it."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").partitionBy("is_current").parquet(locate(base, f"v={version}"))
    columns = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes if name != "is_current")
    commit = Commit(version, batch_id, at, columns, batch_at, since)
    values = {name: value for name, value in vars(commit).items() if value is not None}
    record = spark.range(1).select(*[F.lit(value).alias(name) for name, value in values.items()])
    record.coalesce(1).write.mode("append").json(locate(base, LOG))
    return commit
