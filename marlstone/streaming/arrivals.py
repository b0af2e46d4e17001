"""Bronze ingestion of files as they arrive.

The stream applies the same coercion, quarantine, late flag and stamps as the
batch job.  Late records are flagged and kept, and a key that arrives again is
settled by the silver deduplication, so no state is held and nothing is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marlstone.entities import ENTITIES
from marlstone.plans.bronze_job import ingest_frame
from marlstone.sources.readers import CORRUPT, without_brackets


def ingest_arrivals(
    spark: SparkSession,
    name: str,
    source_folder: str,
    bronze_base: str,
    checkpoint: str,
    *,
    schema: str,
    stream_id: str = "stream",
    files_per_batch: int = 1000,
    as_of=None,
    ingested_at=None,
) -> StreamingQuery:
    """Ingest all files not seen before, then stop.

    Every micro-batch becomes a bronze batch named after its number, which a
    retry after a failure replaces: each record is stored exactly once.
    """
    arrivals = (
        spark.readStream.schema(f"{schema}, `{CORRUPT}` string")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source_folder)
    )

    def store(batch: DataFrame, number: int) -> None:
        ingest_frame(
            without_brackets(batch),
            ENTITIES[name],
            bronze_base,
            f"{stream_id}-{number}",
            as_of=as_of,
            ingested_at=ingested_at,
        )

    return (
        arrivals.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
