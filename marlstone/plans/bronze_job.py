"""Raw JSON to validated bronze tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marlstone.entities import ENTITIES, Entity, choose
from marlstone.operators.bronze import (
    coerce,
    flag_late,
    is_complete,
    split_required,
    stamp,
    with_order_month,
)
from marlstone.plans.outcomes import Outcome, run_each
from marlstone.sources.readers import CORRUPT, locate, read_json
from marlstone.sources.scratch import remove
from marlstone.sources.writers import add_batch, batch_path

QUARANTINE = "_quarantine"


@dataclass(frozen=True)
class IngestCounts:
    total: int
    valid: int
    quarantined: int


def ingest_frame(
    raw: DataFrame, entity: Entity, bronze_base: str, batch_id: str, *, as_of=None, ingested_at=None
) -> IngestCounts:
    """Write one batch of raw records; a replay of the batch replaces it.

    The valid rows are written in one pass that also counts the others; the
    input is read again for the quarantine only if there are any.  Reported
    counts are taken from the files written.
    """
    spark, quarantine_base = raw.sparkSession, locate(bronze_base, QUARANTINE)
    # A replay leaves nothing of the earlier run: folders that this run does not write are removed.
    if raw.isEmpty():
        remove(spark, batch_path(bronze_base, entity.name, batch_id))
        remove(spark, batch_path(quarantine_base, entity.name, batch_id))
        return IngestCounts(0, 0, 0)
    coerced = coerce(raw, entity.types)
    accepted, rejected = 0, None
    if set(entity.required) <= set(coerced.columns):
        seen = Observation()
        incomplete = F.count_if(~is_complete(coerced, entity.required))
        valid, _ = split_required(coerced.observe(seen, incomplete.alias("n")), entity.required)
        if entity.date_column:
            valid = flag_late(with_order_month(valid, entity.date_column), entity.date_column, as_of)
        valid = stamp(valid.drop(CORRUPT), entity.file, batch_id, ingested_at)
        accepted = add_batch(valid, bronze_base, entity.name, batch_id, entity.partition_by).count()
        rejected = seen.get["n"]
    else:
        remove(spark, batch_path(bronze_base, entity.name, batch_id))
    if rejected != 0:
        _, quarantine = split_required(coerced, entity.required)
        quarantine = stamp(quarantine, entity.file, batch_id, ingested_at)
        rejected = add_batch(quarantine, quarantine_base, entity.name, batch_id).count()
    else:
        remove(spark, batch_path(quarantine_base, entity.name, batch_id))
    return IngestCounts(accepted + rejected, accepted, rejected)


def ingest_entity(
    spark: SparkSession,
    name: str,
    source_path: str,
    bronze_base: str,
    batch_id: str,
    *,
    layout: str = "lines",
    schema: str | None = None,
    as_of=None,
    ingested_at=None,
) -> IngestCounts:
    raw = read_json(spark, source_path, layout=layout, schema=schema)
    return ingest_frame(
        raw, ENTITIES[name], bronze_base, batch_id, as_of=as_of, ingested_at=ingested_at
    )


def run_bronze(
    spark: SparkSession,
    source_base: str,
    bronze_base: str,
    entities=None,
    batch_id: str | None = None,
    **options,
) -> list[Outcome]:
    """Ingest the chosen entities; a failing one does not stop the others."""
    batch = batch_id or str(uuid.uuid4())

    def ingest(name: str) -> IngestCounts:
        source = locate(source_base, ENTITIES[name].file)
        return ingest_entity(spark, name, source, bronze_base, batch, **options)

    return run_each(choose(entities, ENTITIES), ingest)
