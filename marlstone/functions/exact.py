"""Order-independent money arithmetic.

Adding doubles gives a result that depends on the order in which partitions
arrive, so two runs of one job can disagree in the last cent.  Amounts are
therefore summed as whole ten-thousandths in a ``bigint``: exact, repeatable
after a task is retried, and cheaper than both ``double`` and ``decimal`` sums.
One group may total about 9.2e14 before the sum leaves the bigint range, where
Spark's ANSI mode raises instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS_PER_ONE = 10_000


def parts(amount: Column) -> Column:
    """A double amount as whole ten-thousandths."""
    return F.rint(amount * F.lit(PARTS_PER_ONE)).cast("bigint")


def sum_parts(amount: Column) -> Column:
    return F.sum(parts(amount))


def amount(total_parts: Column) -> Column:
    """Ten-thousandths back to a double amount."""
    return total_parts / F.lit(PARTS_PER_ONE)


def to_cent(total_parts: Column) -> Column:
    """Ten-thousandths rounded half away from zero to a full cent, in parts."""
    half = F.when(total_parts < 0, F.lit(-50)).otherwise(F.lit(50))
    shifted = total_parts + half
    return shifted - shifted % 100


def mean(total_parts: Column, n: Column, places: int) -> Column:
    # One division of whole numbers: a tie then stays a tie and rounds up.
    return F.round(F.try_divide(total_parts, n * F.lit(PARTS_PER_ONE)), places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is zero."""
    return F.round(F.try_divide(part, whole) * F.lit(100), places)
