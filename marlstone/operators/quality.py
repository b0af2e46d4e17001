"""Data-quality operators: null limits, and checks that return their violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.sources.scratch import written


class DataQualityError(Exception):
    """A table breaks its null limits."""


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: (column_name, total_rows, null_rows, null_pct), from one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"null_{i}").alias("null_rows"))
            for i, c in enumerate(columns)
        ]
    )
    return counts.select("total_rows", F.inline(rows)).select(
        "column_name",
        "total_rows",
        "null_rows",
        (F.try_divide("null_rows", "total_rows") * 100).alias("null_pct"),
    )


def enforce_null_limits(
    df: DataFrame, limits: Mapping[str, float], table: str, override: float | None = None
) -> None:
    """Raise ``DataQualityError`` naming every column above its limit, or an empty table.

    Columns the table does not have are not checked.  ``override`` replaces all limits.
    """
    checked = [c for c in limits if c in df.columns]
    if not checked:
        if df.isEmpty():
            raise DataQualityError(f"{table}: no rows")
        return
    profile = null_profile(df, checked).collect()  # one row per checked column
    if profile[0].total_rows == 0:
        raise DataQualityError(f"{table}: no rows")
    broken = []
    for row in profile:
        limit = limits[row.column_name] if override is None else override
        if row.null_pct > limit:
            broken.append(
                f"{row.column_name} is NULL in {row.null_rows} of {row.total_rows} rows"
                f" ({row.null_pct:.2f}%, allowed {limit}%)"
            )
    if broken:
        raise DataQualityError(f"{table}: " + "; ".join(broken))


# Checks: each returns the violations, so an empty result means the check holds.


def repeated(df: DataFrame, *columns: str) -> DataFrame:
    """Key values that occur more than once; a missing single key is not a duplicate."""
    if len(columns) == 1:
        df = df.filter(F.col(columns[0]).isNotNull())
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def outside(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values not in the accepted list, with their number of rows."""
    return (
        df.filter(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows that refer to a parent that does not exist."""
    known = parent.select(F.col(parent_column).alias("_known"))
    return child.filter(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_known"), "left_anti")


def not_one_current(dimension: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keys without exactly one current version, those with none included."""
    return (
        dimension.groupBy(key)
        .agg(F.count_if("is_current").alias("current_count"))
        .filter("current_count <> 1")
    )


def nonpositive_totals(orders: DataFrame) -> DataFrame:
    return orders.filter("total <= 0").select("order_id", "total")


def unbalanced_days(daily: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Days whose revenue shares do not add up to 100 percent."""
    return (
        daily.groupBy("order_date")
        .agg(F.round(F.sum("revenue_share_pct"), 4).alias("total_share"))
        .filter(F.abs(F.col("total_share") - 100) > tolerance)
    )


def run_suite(
    df: DataFrame,
    suite,
    parents: Mapping[str, tuple[DataFrame, str]] | None = None,
    *,
    store: bool = False,
) -> DataFrame:
    """Violation count of every check of a suite: (check_name, column_name, failures).

    Row-level checks share one scan; each uniqueness or reference check is a
    distributed aggregate or anti join of its own.  With ``store``, the checked
    columns are written out first, so that a costly model is computed once.
    """
    parents = parents or {}
    checked = {*suite.not_null, *suite.unique, *suite.accepted_values, *parents}
    checked.update(c for columns in suite.unique_combinations for c in columns)
    df = df.select(*[c for c in df.columns if c in checked])
    if store:
        df = written(df, "suite")

    tests = [("not_null", c, F.col(c).isNull()) for c in suite.not_null]
    tests += [
        ("accepted_values", c, ~F.col(c).isin(*values)) for c, values in suite.accepted_values.items()
    ]
    counts = df.agg(*[F.count_if(test).alias(f"n{i}") for i, (_, _, test) in enumerate(tests)])
    rows = [_result(kind, column, F.col(f"n{i}")) for i, (kind, column, _) in enumerate(tests)]
    report = counts.select(F.inline(F.array(*rows)))

    violations = [("unique", c, repeated(df, c)) for c in suite.unique]
    violations += [("unique_combination", ",".join(cs), repeated(df, *cs)) for cs in suite.unique_combinations]
    violations += [("relationships", c, orphans(df, c, *parent)) for c, parent in parents.items()]
    for kind, column, failing in violations:
        total = failing.agg(F.count(F.lit(1)).alias("n"))
        report = report.unionAll(total.select(_result(kind, column, F.col("n")).alias("r")).select("r.*"))
    return report


def check_models(models: Mapping[str, DataFrame], suites: Mapping[str, object]) -> DataFrame:
    """Violation counts of the checks of many models: (model, check_name, column_name, failures), as one plan.

    All row checks of a model share one scan.  A key that models refer to is counted once for all of them: its values
    in the model that owns it and in those that refer to it are shuffled together, so the count tells repeated and
    missing ones alike.
    """
    reports = []
    users: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for name, suite in suites.items():
        tests = [("not_null", c, F.col(c).isNull()) for c in suite.not_null]
        tests += [("accepted_values", c, ~F.col(c).isin(*values)) for c, values in suite.accepted_values.items()]
        counts = models[name].agg(*[F.count_if(test).alias(f"n{i}") for i, (_, _, test) in enumerate(tests)])
        rows = [_result(kind, c, F.col(f"n{i}")) for i, (kind, c, _) in enumerate(tests)]
        reports.append(counts.select(F.inline(F.array(*rows))).withColumn("model", F.lit(name)))
        for columns in suite.unique_combinations:
            n = repeated(models[name], *columns).agg(F.count(F.lit(1)).alias("n"))
            row = _result("unique_combination", ",".join(columns), F.col("n"))
            reports.append(n.select(row.alias("r")).select("r.*", F.lit(name).alias("model")))
        for column in suite.unique:
            users.setdefault((name, column), [])
        for column, owner in suite.references.items():
            users.setdefault(owner, []).append((name, column))
    for (owner, key), children in users.items():
        sides = [(owner, key), *children]
        values = [
            models[m].filter(F.col(c).isNotNull()).select(F.col(c).alias("value"), F.lit(i).alias("side"))
            for i, (m, c) in enumerate(sides)
        ]
        per_value = reduce(DataFrame.unionAll, values).groupBy("value")
        per_value = per_value.agg(*[F.count_if(F.col("side") == i).alias(f"s{i}") for i in range(len(sides))])
        failing = [F.count_if(F.col("s0") > 1).alias("f0")]
        failing += [F.coalesce(F.sum(F.when(F.col("s0") == 0, F.col(f"s{i}"))), F.lit(0)).alias(f"f{i}") for i in range(1, len(sides))]
        rows = [("unique", owner, key)] if key in suites[owner].unique else []
        rows = [(*row, "f0") for row in rows] + [("relationships", m, c, f"f{i}") for i, (m, c) in enumerate(children, 1)]
        made = [F.struct(F.lit(m).alias("model"), F.lit(k).alias("check_name"), F.lit(c).alias("column_name"), F.col(f).alias("failures")) for k, m, c, f in rows]
        reports.append(per_value.agg(*failing).select(F.inline(F.array(*made))))
    return reduce(DataFrame.unionAll, [r.select("model", "check_name", "column_name", "failures") for r in reports])


def check_rows(model: str, name: str, violations: DataFrame, column: str) -> DataFrame:
    """A check of its own, in the form of ``check_models``."""
    n = violations.agg(F.count(F.lit(1)).alias("failures"))
    return n.select(F.lit(model).alias("model"), F.lit(name).alias("check_name"), F.lit(column).alias("column_name"), "failures")


def _result(kind: str, column: str, failures):
    return F.struct(
        F.lit(kind).alias("check_name"), F.lit(column).alias("column_name"), failures.alias("failures")
    )


def all_hold(report: DataFrame) -> bool:
    return report.filter("failures > 0").isEmpty()
