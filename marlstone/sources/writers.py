"""Sinks: partitioned Parquet, batch folders, CSV exports, views."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from marlstone.sources.evolution import union_evolved
from marlstone.sources.readers import locate, month_list
from marlstone.sources.scratch import folders, remove, scratch_table

BATCH_FOLDER = "batch_folder"


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> DataFrame:
    """Replace the Parquet table at ``path`` and return the stored rows.

    A partitioned write is rebalanced on the partition columns first: small
    partitions share a task and get one file each, while a partition that holds
    much of the data is split over many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def replace_months(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Rebuild only the partitions present in ``df``; the others stay."""
    df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def batch_path(base: str, table: str, batch_id: str) -> str:
    # The prefix keeps Spark from reading an id such as 007 as a number.
    return locate(base, table, f"{BATCH_FOLDER}=id-{batch_id}")


def add_batch(
    df: DataFrame, base: str, table: str, batch_id: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Append a batch as a folder of its own, so that a replay replaces it."""
    return write_table(df, batch_path(base, table, batch_id), partition_by)


def batch_ids(spark: SparkSession, base: str, table: str) -> list[str]:
    """The batches of a table that are stored."""
    mark = f"{BATCH_FOLDER}=id-"
    return sorted(name.removeprefix(mark) for name in folders(spark, locate(base, table)) if name.startswith(mark))


def read_batches(
    spark: SparkSession, base: str, table: str, only: Sequence[str] | None = None
) -> DataFrame:
    """All batches of a table, or ``only`` some, with the union of their columns.

    A column whose type changes between batches gets the least common one (``sources.evolution``).
    """
    path = locate(base, table)
    paths = [path] if only is None else [batch_path(base, table, b) for b in only]
    try:
        merged = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*paths)
        return merged.drop(BATCH_FOLDER)
    except (PySparkException, Py4JJavaError) as problem:
        if "CANNOT_MERGE_SCHEMAS" not in str(problem):
            raise
    each = batch_ids(spark, base, table) if only is None else only
    parts = [spark.read.option("basePath", path).parquet(batch_path(base, table, b)) for b in each]
    by_schema: dict[str, list[int]] = {}
    for i, part in enumerate(parts):
        by_schema.setdefault(part.schema.json(), []).append(i)
    alike = [
        spark.read.schema(parts[found[0]].schema)
        .option("basePath", path)
        .parquet(*[batch_path(base, table, each[i]) for i in found])
        for found in by_schema.values()
    ]
    return union_evolved([part.drop(BATCH_FOLDER) for part in alike])


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV written by the executors, one part file per task; quotes within values are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def without_internal(df: DataFrame) -> DataFrame:
    """Drop the columns whose name starts with an underscore."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def export_sample(df: DataFrame, path: str, key: Sequence[str], rows: int | None = None) -> None:
    """CSV export of the public columns, of all rows or of the first ``rows`` by key."""
    df = without_internal(df)
    write_csv(df if rows is None else df.orderBy(*key).limit(rows), path)


def write_gold(
    df: DataFrame,
    name: str,
    gold_base: str,
    csv_dir: str | None,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> int:
    """Write a gold table as Parquet and CSV, computing it once; returns its row count.

    CSV and count are taken from the finished Parquet files.
    """
    table = write_table(df, locate(gold_base, name), partition_by, sort_by)
    if csv_dir is not None:
        write_csv(table, locate(csv_dir, name))
    return table.count()


def refresh_gold(
    df: DataFrame, name: str, gold_base: str, csv_dir: str | None, months, sort_by: Sequence[str] = ()
) -> int:
    """Replace the months of a range or set in a gold table by the rows of ``df``, which are of these months.

    The new rows are stored before anything is replaced.  Months among them that have no rows are removed.
    """
    spark, path, keys = df.sparkSession, locate(gold_base, name), ("order_year", "order_month")
    with scratch_table(df, f"refresh-{name}") as fresh:
        present = {(r.order_year, r.order_month) for r in fresh.select(*keys).distinct().collect()}
        if present:
            replace_months(fresh, path, keys, sort_by)
        for year, month in month_list(months):
            if (year, month) not in present:
                remove(spark, f"{path}/order_year={year}/order_month={month}")
        if csv_dir is not None:
            stored = spark.read.schema(df.schema).parquet(path).select(*df.columns)
            write_csv(stored, locate(csv_dir, name))
        return fresh.count()


def publish(df: DataFrame, view: str, path: str | None = None) -> DataFrame:
    """Make a model available to SQL: as a view, or as a stored table behind one."""
    if path is not None:
        df = write_table(df, path)
    df.createOrReplaceTempView(view)
    return df
