"""Bronze batches to clean silver tables and the customer history."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.entities import BRONZE_COLUMNS, ENTITIES, choose
from marlstone.functions.rules import moment, orderable
from marlstone.operators.dedup import latest_per_key
from marlstone.operators.history import SILVER_CUSTOMERS, HistoryRules, first_load, merge_batch
from marlstone.operators.quality import enforce_null_limits
from marlstone.operators.silver import silver_rows, stamp_silver
from marlstone.operators.splicing import OBSERVED, observed_load, splice_batch
from marlstone.plans.outcomes import Outcome, run_each
from marlstone.sources.evolution import disputed
from marlstone.sources.readers import locate, read_parquet, within_months
from marlstone.sources.scratch import scratch_table
from marlstone.sources.versions import Commit, last_commit, place, read_versions, state, write_version
from marlstone.sources.writers import read_batches, write_table


def deduplicated_bronze(spark: SparkSession, bronze_base: str, name: str) -> DataFrame:
    """Latest record per key over all batches."""
    bronze = read_batches(spark, bronze_base, name)
    key = ENTITIES[name].key
    ties = orderable(bronze, skip={key, *BRONZE_COLUMNS})
    return latest_per_key(bronze, key, ("_ingested_at", "_batch_id"), ties)


def process_entity(
    spark: SparkSession,
    name: str,
    bronze_base: str,
    silver_base: str,
    null_limit: float | None = None,
    processed_at: datetime | None = None,
    run_id: str | None = None,
    rules: HistoryRules = SILVER_CUSTOMERS,
) -> int:
    """Deduplicate, check, repair and store one entity; returns the rows stored.

    The deduplicated rows are written out once, so the quality gate and the
    repair see the same rows and the bronze scan and its shuffle happen once.
    """
    entity = ENTITIES[name]
    at = processed_at or datetime.now(timezone.utc)
    run = run_id or str(uuid.uuid4())
    target = locate(silver_base, name)
    if name == "customers" and run_id and state(spark, target, run).seen:
        return read_silver(spark, silver_base, name).count()
    with scratch_table(deduplicated_bronze(spark, bronze_base, name), f"dedup-{name}") as latest:
        enforce_null_limits(latest, entity.null_limits, name, null_limit)
        rows = silver_rows(name, latest)
        if name == "customers":
            merge_into(rows, target, rules, run, at)
            stored = read_silver(spark, silver_base, name)
        else:
            stored = write_table(stamp_silver(rows, at), target, entity.partition_by)
    return stored.count()


def merge_into(incoming: DataFrame, base: str, rules: HistoryRules, batch_id: str, at: datetime) -> Commit:
    """Merge a batch into a stored history; a batch already merged changes nothing."""
    spark = incoming.sparkSession
    found = state(spark, base, batch_id)
    if found.last is not None and found.seen:
        return found.last
    if rules.any_order:
        return _splice_into(incoming, base, rules, batch_id, at, found.last)
    if found.last is None:
        rows = first_load(incoming, rules, at)
    elif f"`{OBSERVED}`" in found.last.columns:
        raise ValueError(f"the history {base} takes batches in any order; merge with rules that do")
    else:
        current = read_versions(spark, base, found.last, "current")
        if not rules.current_flag:
            current = current.drop("is_current")
        rows = merge_batch(current, _without_empty_text(incoming, current), rules, at)
    rows = rows.withColumn("is_current", rules.is_current())
    return write_version(rows, base, found.last.version + 1 if found.last else 1, batch_id, at)


def _splice_into(incoming: DataFrame, base: str, rules: HistoryRules, batch_id: str, at, last: Commit | None) -> Commit:
    """Merge a batch of any time.

    The newest one reads current versions only and adds to what is stored; a late one rewrites the history as a new version.
    """
    spark = incoming.sparkSession
    if last is None:
        rows = observed_load(incoming, rules, at).withColumn("is_current", rules.is_current())
        return write_version(rows, base, 1, batch_id, at)
    if f"`{OBSERVED}`" not in last.columns:
        raise ValueError(f"the history {base} was begun without observations and takes no late batches")
    stands = place(spark, base, at)
    stored = read_versions(spark, base, last, "all" if stands.late else "current")
    if not rules.current_flag:
        stored = stored.drop("is_current")
    rows = splice_batch(stored, _without_empty_text(incoming, stored), rules, at, stands.next_batch)
    rows = rows.withColumn("is_current", rules.is_current())
    since = last.version + 1 if stands.late else last.since
    # Readers date the state of a history by its newest batch, whichever came last.
    return write_version(rows, base, last.version + 1, batch_id, stands.latest, since, at)


def _without_empty_text(incoming: DataFrame, current: DataFrame) -> DataFrame:
    """``incoming`` with the stored type for text columns that are stored as another type and have no value here."""
    kinds = {f.name: f.dataType for f in current.schema.fields}
    text = [c for c in disputed([incoming.schema, current.schema]) if incoming.schema[c].dataType.simpleString() == "string"]
    if not text:
        return incoming
    counts = incoming.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(text)]).first()
    empty = {c: F.lit(None).cast(kinds[c]) for c, n in zip(text, counts, strict=True) if not n}
    return incoming.withColumns(empty)


def read_history(spark: SparkSession, base: str, rules: HistoryRules) -> DataFrame:
    """All versions of a stored history."""
    rows = read_versions(spark, base, last_commit(spark, base)).drop(OBSERVED)
    return rows if rules.current_flag else rows.drop("is_current")


def read_silver(
    spark: SparkSession, silver_base: str, name: str, months=None, merge_schema: bool = False
) -> DataFrame:
    """A silver table; ``months`` restricts orders to a range of their partitions.

    A run writes a table with one schema, so merging the schemas of its files,
    which reads every footer, is only worth it where partitions were rebuilt.
    """
    path = locate(silver_base, name)
    if name == "customers":
        last = last_commit(spark, path)
        # A run restates the whole dimension, so all rows carry its time.
        return read_versions(spark, path, last).drop(OBSERVED).withColumn(
            "_silver_processed_at", moment(last.committed_at)
        )
    return within_months(read_parquet(spark, path, merge_schema=merge_schema), months)


def run_snapshot(staged_customers: DataFrame, base: str, rules: HistoryRules, batch_id: str, at: datetime):
    """Warehouse snapshot of the staged customers; returns all versions so far."""
    merge_into(staged_customers, base, rules, batch_id, at)
    return read_history(staged_customers.sparkSession, base, rules)


def run_silver(
    spark: SparkSession, bronze_base: str, silver_base: str, entities=None, null_limit=None, **options
) -> list[Outcome]:
    return run_each(
        choose(entities, ENTITIES),
        lambda name: process_entity(spark, name, bronze_base, silver_base, null_limit, **options),
    )
