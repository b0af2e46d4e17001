"""Silver tables brought up to date by the bronze batches that are new.

Beside a silver table lies its state:

    <silver>/_state/<entity>/recency/   time and batch that each stored row came from, partitioned like the table
    <silver>/_state/<entity>/keys-*     the keys of each partition, one bit a key, in bitmaps of 32,768 neighbouring ones
    <silver>/_state/<entity>/changes/   what each run changed, for the gold refresh: months, or keys that lead to months
    <silver>/_state/<entity>/log/       one record a run: the batches it covers and the bitmaps that hold since

A run reads the new batches only, finds the partitions whose bitmaps have a new
key, looks there for the rows that the new ones replace, and rewrites the
partitions that lose or gain a row.  All others are neither read nor written.
A batch that was replayed or removed since makes the run a full one.  A run that
died is repeated: rows as recent as the stored ones are written again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.entities import BRONZE_COLUMNS, ENTITIES, Entity, choose
from marlstone.functions.rules import orderable
from marlstone.operators.dedup import latest_per_key
from marlstone.operators.history import SILVER_CUSTOMERS
from marlstone.operators.quality import enforce_null_limits
from marlstone.operators.silver import REPAIRS, silver_rows, stamp_silver
from marlstone.plans.outcomes import Outcome, run_each
from marlstone.plans.silver_job import merge_into
from marlstone.sources.readers import locate
from marlstone.sources.scratch import exists, fingerprint, folders, remove, scratch_table
from marlstone.sources.writers import batch_ids, batch_path, read_batches, replace_months, write_table

STATE = "_state"
RECENCY = ("_ingested_at", "_batch_id")
RECORD = "run bigint, batches string, known string, is_full boolean"
#: What a run notes of the rows it changes: the columns that lead to the months of orders.
LEADS = {"orders": ("order_year", "order_month"), "order_items": ("order_id",), "products": ("product_id",)}
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

Month = tuple[int | None, ...]  # values of the partition columns; () for a table without


@dataclass(frozen=True)
class SilverUpdate:
    """What a run did: batches and rows it read, rows it changed, partitions and files of the stored table."""

    batches: tuple[str, ...]
    full: bool
    rows_read: int
    rows_deduplicated: int
    rows_changed: int
    partitions: tuple[Month, ...]
    files_read: int
    files_stored: int


def update_entity(
    spark: SparkSession,
    name: str,
    bronze_base: str,
    silver_base: str,
    null_limit: float | None = None,
    processed_at: datetime | None = None,
) -> SilverUpdate:
    """Bring one silver table up to date; the result equals that of a full run over all batches.

    The null limits are held against the rows that the run reads, deduplicated.  Customers are merged into their
    history, which keeps what the batch does not mention.
    """
    entity, at = ENTITIES[name], processed_at or datetime.now(timezone.utc)
    store = _Store(spark, entity, silver_base)
    found = {b: fingerprint(spark, batch_path(bronze_base, name, b)) for b in batch_ids(spark, bronze_base, name)}
    run, covered, known = store.last()
    full = run == 0 or any(found.get(b) != mark for b, mark in covered.items())
    new = sorted(found) if full else sorted(set(found) - set(covered))
    if not new:
        return SilverUpdate((), False, 0, 0, 0, (), 0, store.n_files())
    bronze = read_batches(spark, bronze_base, name, None if full else new)
    ties = orderable(bronze, skip={entity.key, *BRONZE_COLUMNS})
    with scratch_table(latest_per_key(bronze, entity.key, RECENCY, ties), f"changes-{name}") as latest:
        enforce_null_limits(latest, entity.null_limits, name, null_limit)
        rows_read, rows = bronze.count(), latest.count()
        if full:
            touched, n_read, winners = None, 0, latest
        else:
            near = store.partitions_near(latest, known)
            old = store.recency(near)
            n_read = len(old.inputFiles()) if near else 0
            winners = _newer(latest, old, entity)
        # A full run replaces all rows by those of the stored table as it is; a second copy of them would tell no more.
        with nullcontext(latest) if full else scratch_table(winners, f"winners-{name}") as winners:
            changed = rows if full else winners.count()
            if not full:
                touched = store.partitions_of(winners)
                if name != "customers":
                    n_read += store.n_files(touched)
                store.note_changes(run + 1, winners, touched)
            store.replace(winners, touched, at, full)
            store.commit(run + 1, found, store.new_keys(touched, known), full)
    return SilverUpdate(tuple(new), full, rows_read, rows, changed, tuple(touched or ()), n_read, store.n_files())


def _newer(latest: DataFrame, old: DataFrame, entity: Entity) -> DataFrame:
    """Rows that are at least as recent as the stored ones, with the partition those are in as ``_old``."""
    stored = old.select(
        F.col(entity.key).alias("_key"), F.struct(*RECENCY).alias("_stored"), F.struct(F.lit(0), *entity.partition_by).alias("_old")
    )
    joined = latest.join(stored, F.col(entity.key) == F.col("_key"), "left")
    fresh = F.col("_stored").isNull() | (F.struct(*RECENCY) >= F.col("_stored"))
    return joined.filter(fresh).drop("_key", "_stored")


class _Store:
    """A silver table and its state."""

    def __init__(self, spark: SparkSession, entity: Entity, silver_base: str):
        self.spark, self.entity, self.base = spark, entity, silver_base
        self.by = list(entity.partition_by)
        self.table = locate(silver_base, entity.name)
        self.state = locate(silver_base, STATE, entity.name)
        self.recent = locate(self.state, "recency")

    def last(self) -> tuple[int, dict[str, str], str | None]:
        path = locate(self.state, "log")
        if not exists(self.spark, path):
            return 0, {}, None
        record = self.spark.read.schema(RECORD).json(path).orderBy(F.desc("run")).first()
        return record.run, json.loads(record.batches), record.known

    def commit(self, run: int, batches: dict[str, str], known: str, full: bool) -> None:
        record = self.spark.createDataFrame([(run, json.dumps(batches), known, full)], RECORD)
        record.coalesce(1).write.mode("append").json(locate(self.state, "log"))

    def note_changes(self, run: int, winners: DataFrame, touched: Sequence[Month]) -> None:
        """Store what the rows lead to, as they are and as they were; a repeated run adds to what a dead one noted."""
        leads, key = LEADS.get(self.entity.name), self.entity.key
        if not leads or not touched:
            return
        if self.by:
            noted = self.spark.createDataFrame([*touched], ", ".join(f"`{c}` int" for c in leads))
        else:
            noted = REPAIRS[self.entity.name](winners).select(*leads)
            if leads != (key,):
                kept = self.spark.read.parquet(self.table).join(winners.select(key), key, "left_semi")
                noted = noted.unionByName(kept.select(*leads)).distinct()
        noted.write.mode("append").parquet(locate(self.state, "changes", f"run={run}"))

    def paths(self, base: str, partitions: Sequence[Month]) -> list[str]:
        """Folders of partitions that exist; the partition () is the whole table."""
        out = []
        for values in partitions:
            parts = [f"{c}={NO_VALUE if v is None else v}" for c, v in zip(self.by, values)]
            path = locate(base, *parts)
            if exists(self.spark, path):
                out.append(path)
        return out

    def read(self, base: str, partitions: Sequence[Month], schema) -> DataFrame:
        """The rows of some partitions; no other file is looked at."""
        found = self.paths(base, partitions)
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*found)

    def recency(self, partitions: Sequence[Month]) -> DataFrame:
        kinds = {"_ingested_at": "timestamp", "_batch_id": "string", self.entity.key: self.entity.types[self.entity.key]}
        columns = [self.entity.key, *RECENCY]
        schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), *(f"`{c}` int" for c in self.by)])
        return self.read(self.recent, partitions, schema)

    def n_files(self, partitions: Sequence[Month] | None = None) -> int:
        paths = self.paths(self.table, [()] if partitions is None or not self.by else partitions)
        return sum(int(fingerprint(self.spark, p).split("-")[0]) for p in paths)

    def partitions_near(self, rows: DataFrame, known: str) -> list[Month]:
        """Partitions that hold some of the rows' keys."""
        if not self.by:
            return [()]
        at = [F.bitmap_bucket_number(self.entity.key).alias("bucket"), F.bitmap_bit_position(self.entity.key).alias("bit")]
        byte = "CAST(conv(hex(substr(keys, CAST(bit DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
        held = F.expr(f"shiftright({byte}, CAST(bit % 8 AS INT)) & 1 = 1")
        found = rows.select(*at).join(self.spark.read.parquet(known), "bucket").filter(held)
        return [tuple(r) for r in found.select(*self.by).distinct().collect()]

    def partitions_of(self, winners: DataFrame) -> list[Month]:
        """Partitions that the rows leave or enter."""
        if not self.by:
            return [()] if not winners.isEmpty() else []
        repaired = REPAIRS[self.entity.name](winners)
        left = winners.filter("_old IS NOT NULL").select(*(f"_old.{c}" for c in self.by))
        return sorted((tuple(r) for r in repaired.select(*self.by).unionAll(left).distinct().collect()), key=str)

    def replace(self, winners: DataFrame, touched: Sequence[Month] | None, at: datetime, full: bool) -> None:
        """Write rows in place of those with their keys; ``touched`` is None for the whole table."""
        name, key = self.entity.name, self.entity.key
        # A run that died may have left a key in two partitions; both are rewritten, with one row.
        plain = winners if full else winners.drop("_old").dropDuplicates([key])
        stamps = REPAIRS[name](plain).select(key, *RECENCY, *self.by)
        if name == "customers":
            merge_into(silver_rows(name, plain), self.table, SILVER_CUSTOMERS, f"update-{uuid.uuid4()}", at)
        else:
            self._write(self.table, stamp_silver(silver_rows(name, plain), at), touched, full)
        self._write(self.recent, stamps, touched, full)

    def _write(self, base: str, rows: DataFrame, touched: Sequence[Month] | None, full: bool) -> None:
        if full:
            write_table(rows, base, self.by)
            return
        if not touched:
            return
        kept = self.read(base, touched if self.by else [()], rows.schema)
        kept = kept.join(rows.select(self.entity.key), self.entity.key, "left_anti").select(*rows.columns)
        with scratch_table(kept.unionByName(rows), "rebuilt") as rebuilt:
            if not self.by:
                write_table(rebuilt, base)
                return
            present = {tuple(r) for r in rebuilt.select(*self.by).distinct().collect()}
            replace_months(rebuilt, base, self.by)
            for path in self.paths(base, [p for p in touched if p not in present]):
                remove(self.spark, path)

    def new_keys(self, touched: Sequence[Month] | None, known: str | None) -> str:
        """Store the bitmaps that hold now: those of touched partitions anew, the others as they were."""
        if not self.by:
            return ""
        key = self.entity.key
        rows = self.recency([()] if touched is None else touched)
        found = rows.groupBy(*self.by, F.bitmap_bucket_number(key).alias("bucket"))
        found = found.agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("keys"))
        if touched is not None:
            gone = self.spark.createDataFrame([*touched], ", ".join(f"`_{c}` int" for c in self.by))
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.by]
            others = self.spark.read.parquet(known).join(F.broadcast(gone), same, "left_anti")  # one row a partition
            found = others.unionByName(found)
        path = locate(self.state, f"keys-{uuid.uuid4().hex}")
        found.repartitionByRange("bucket").write.parquet(path)
        for name in folders(self.spark, self.state):
            if name.startswith("keys-") and not path.endswith(name) and not (known or "").endswith(name):
                remove(self.spark, locate(self.state, name))
        return path


@dataclass(frozen=True)
class Changes:
    """What happened to a silver table after one of its runs."""

    run: int  # the last run; 0 if the table is not kept up to date by runs
    whole: bool  # is it unknown which rows changed?
    noted: DataFrame | None  # the columns of LEADS; None if nothing changed


def changes_since(spark: SparkSession, silver_base: str, name: str, run: int | None) -> Changes:
    """What runs after ``run`` changed, from their notes; rows changed by other jobs are not known here."""
    state = locate(silver_base, STATE, name)
    if not exists(spark, locate(state, "log")):
        return Changes(0, True, None)
    log = spark.read.schema(RECORD).json(locate(state, "log"))
    later = F.col("run") > (run or 0)
    last, whole = log.agg(F.max("run"), F.bool_or(later & F.coalesce("is_full", F.lit(True)))).first()
    if run is None or whole:
        return Changes(last, True, None)
    notes = [locate(state, "changes", f"run={n}") for n in range(run + 1, last + 1)]
    notes = [path for path in notes if exists(spark, path)]
    return Changes(last, False, spark.read.parquet(*notes) if notes else None)


def run_updates(
    spark: SparkSession, bronze_base: str, silver_base: str, entities=None, null_limit=None, **options
) -> list[Outcome]:
    """Update the chosen entities; a failing one does not stop the others."""
    return run_each(
        choose(entities, ENTITIES),
        lambda name: update_entity(spark, name, bronze_base, silver_base, null_limit, **options),
    )
