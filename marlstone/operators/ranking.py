"""``ntile`` without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.sources.scratch import written

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def tile_starts(total: int, tiles: int) -> list[int]:
    """Row index at which tiles 2..n begin; the first tiles take the remainder."""
    size, larger = divmod(total, tiles)
    starts = [t * size + min(t, larger) for t in range(1, tiles)]
    return [s for s in starts if s < total]


def with_tile(df: DataFrame, tiles: int, order: Sequence[str], name: str) -> DataFrame:
    """``ntile(tiles) over (order by order)``; ``order`` must be a total order.

    Only the sort columns are range partitioned and numbered.  That yields the
    exact first row of each tile, and the table itself is then labelled by
    comparing against those few rows, without being moved.  ``df`` is read
    twice: pass a stored table.
    """
    ranked = (
        df.select(F.struct(*order).alias("sort_key"))
        .repartitionByRange("sort_key")
        .sortWithinPartitions("sort_key")
        .withColumn("position", F.monotonically_increasing_id())
        .select(
            "sort_key",
            F.shiftright("position", ROW_BITS).alias("part"),
            F.col("position").bitwiseAND((1 << ROW_BITS) - 1).alias("row"),
        )
    )
    # Stored once, because range bounds are sampled anew when a plan is run again.
    ranked = written(ranked, "tile-order")
    sizes = ranked.groupBy("part").count().orderBy("part").collect()  # one row per partition
    ends = list(accumulate(r["count"] for r in sizes))
    starts = tile_starts(ends[-1] if ends else 0, tiles)
    firsts = []
    for start in starts:
        i = next(i for i, end in enumerate(ends) if start < end)
        firsts.append((sizes[i].part, start - (ends[i - 1] if i else 0)))
    tile = F.lit(1)
    if firsts:
        wanted = reduce(or_, [(F.col("part") == part) & (F.col("row") == row) for part, row in firsts])
        fields = {f.name: f.dataType for f in df.select(*order).schema}
        for found in ranked.filter(wanted).collect():  # one row per tile
            bound = F.struct(*[F.lit(found.sort_key[c]).cast(t).alias(c) for c, t in fields.items()])
            tile = tile + (F.struct(*order) >= bound).cast("int")
    return df.withColumn(name, tile)
