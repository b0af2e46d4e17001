"""Sources: JSON, CSV and Parquet on any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources.scratch import exists

CORRUPT = "_corrupt_record"
ARRAY_BRACKETS = ("[", "]")


def locate(base: str, *segments: str) -> str:
    """Join a local folder or an object-store URI with path segments."""
    return "/".join([base.rstrip("/"), *(s.strip("/") for s in segments if s)])


def read_json(
    spark: SparkSession, path: str, *, layout: str = "lines", schema: str | None = None
) -> DataFrame:
    """Read JSON records; text that is no record lands in ``_corrupt_record``.

    ``lines`` takes one object per line, bare or as the lines of an array, and
    is split over tasks whatever the file size.  ``document`` takes arrays laid
    out in any way, at the price of one task per file.  Without a ``schema`` the
    whole input is scanned first, so that no undeclared column is missed.
    """
    if layout not in ("lines", "document"):
        raise ValueError(f"unknown JSON layout {layout!r}")
    reader = spark.read.option("multiLine", layout == "document")
    if schema is None:
        inferred = reader.option("mode", "DROPMALFORMED").json(path).schema
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inferred if f.name != CORRUPT)
        reader = reader.option("mode", "PERMISSIVE")
    if not schema:
        return _without_records(spark, path, layout)
    fields = f"{schema}, `{CORRUPT}` string"
    records = reader.schema(fields).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return without_brackets(records) if layout == "lines" else records


def _without_records(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Input in which no record was found: whatever else it holds is corrupt text."""
    text = spark.read.option("wholetext", layout == "document").text(path)
    return text.select(F.col("value").alias(CORRUPT)).filter(
        F.regexp_replace(CORRUPT, r"[\[\]\s]", "") != ""
    )


def without_brackets(records: DataFrame) -> DataFrame:
    """Drop the lines that only open or close a JSON array."""
    mark = F.trim(F.col(CORRUPT))
    # Spark refuses scans of the corrupt text alone, so the test names a data column too.
    has_data = F.col(f"`{records.columns[0]}`").isNotNull()
    return records.filter(has_data | F.col(CORRUPT).isNull() | ~mark.isin(*ARRAY_BRACKETS))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read CSV with a header, quotes doubled within values; every column is text until a staging view casts it."""
    return spark.read.option("header", True).option("escape", '"').csv(path)


def read_parquet(spark: SparkSession, path: str, *, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_if_present(spark: SparkSession, path: str, *, merge_schema: bool = False) -> DataFrame | None:
    """Read Parquet, or ``None`` when there is no such path; any other problem is raised."""
    return read_parquet(spark, path, merge_schema=merge_schema) if exists(spark, path) else None


def month_list(months) -> list[tuple[int, int]]:
    """The (year, month) pairs of a range, given by its first and last, or of a frozenset of months."""
    if isinstance(months, frozenset):
        return sorted(months)
    (year, month), (last_year, last_month) = months
    numbers = range(year * 12 + month - 1, last_year * 12 + last_month)
    return [(n // 12, n % 12 + 1) for n in numbers]


def within_months(df: DataFrame, months) -> DataFrame:
    """Keep an inclusive range of (year, month) partitions, or those of a frozenset; prunes the scan."""
    if months is None:
        return df
    number = F.col("order_year") * 12 + F.col("order_month")
    if isinstance(months, frozenset):
        return df.filter(number.isin([y * 12 + m for y, m in sorted(months)]))
    (y0, m0), (y1, m1) = months
    return df.filter(number.between(y0 * 12 + m0, y1 * 12 + m1))
